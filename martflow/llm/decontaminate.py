"""Benchmark decontamination with DataFrame functions only.

Words are runs of ASCII letters and digits and of all other non-ASCII code
points, A-Z lower-cased.  A window is 13 consecutive words of a benchmark
item (a shorter item is one window).  The 64-bit hashes of the windows form
the hash set; the hash of the words from each position of a document on is
looked up in it, one probe for each position and window length.  Documents with a found hash are
read again, and the words at the found places are compared with the window's.

The set and the windows are written first, so their size is known when the
joins are planned: Spark broadcasts them (and the found places) below its
threshold and shuffles hashes beyond it.  Texts are read again only where the
hash of a text with found places has the same remainder: these remainders are
a bounded table that is always broadcast, so a join that exceeds the threshold
shuffles the texts that may be hit and not all of them.

Edge cases: null, empty or word-less texts have no words, no hits and are not
contaminated; word-less items have no window; equal items all count as hit;
repeated rows give repeated results; an empty benchmark hits nothing; extra
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martflow.llm.common import drop_rows, stored

WINDOW = 13
MARKS = 1 << 20  # remainders of text hashes: the most rows that are broadcast without a threshold
MIN_SHARE = 20  # contaminated: hit words are at least one in MIN_SHARE
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(column):
    """Normalised words of a text; null has none."""
    return F.regexp_extract_all(F.translate(F.coalesce(column, F.lit("")), _UPPER, _LOWER), F.lit(WORD), F.lit(0))


def windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """(h, win, items): distinct windows, their hash and the items that have them."""
    w = benchmark.select(F.col("item_id").cast("string").alias("item"), words_of(F.col("text")).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - F.lit(size - 1)))
    w = w.withColumn("start", F.explode(starts)).select("item", F.slice("w", F.col("start"), F.lit(size)).alias("win"))
    return (w.groupBy("win").agg(F.array_sort(F.collect_set("item")).alias("items"))
            .withColumn("h", F.xxhash64(F.transform("win", lambda x: F.xxhash64(x)))))


def _found_places(docs: DataFrame, known: DataFrame, sizes: list[int]) -> DataFrame:
    """Every row of ``docs`` (row, doc_id, text_hash, n_words) with its places (at, n, h) whose hash is ``known`` (h, n)."""
    ids = ["row", "doc_id", "text_hash", "n_words"]
    d = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.xxhash64("text").alias("text_hash"),
                    F.transform(words_of(F.col("text")), lambda x: F.xxhash64(x)).alias("codes"))
    d = d.withColumn("n_words", F.size("codes").cast("long"))

    def of_size(n: int):
        return F.transform("codes", lambda _, i: F.when(
            i + n <= F.size("codes"), F.xxhash64(F.slice("codes", i + 1, F.lit(n)))))

    # a first element without a hash keeps documents without a place
    hashes = F.concat(F.array(F.lit(None).cast("long")), *(of_size(n) for n in sizes))
    places = d.select(*ids, F.posexplode(hashes).alias("pos", "h"))
    found = places.join(known, "h", "left").where((F.col("pos") == 0) | F.col("n").isNotNull())
    place = F.when(F.col("n").isNotNull(), F.struct(F.pmod(F.col("pos") - 1, F.col("n_words")).cast("int").alias("at"), "n", "h"))
    return found.groupBy(*ids).agg(F.collect_set(place).alias("places"))


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """One row per document: n_words, n_hit, n_items, items_sha256, contaminated, and its hit spans.

    ``spans`` are (first word, number of words) of verified window occurrences.
    """
    found = stored(windows(benchmark, size), "benchmark-windows")
    known = stored(found.select("h", F.size("win").alias("n")).distinct(), "benchmark-hashes")
    sizes = sorted(r.n for r in known.select("n").distinct().collect())  # ``size`` numbers at most
    scanned = stored(_found_places(docs, known, sizes), "found-places")
    asked = stored(scanned.where(F.size("places") > 0).select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), "places")
                   .dropDuplicates(["__id", "__hash"]), "places-of-texts")
    marks = asked.select(F.pmod("__hash", F.lit(MARKS)).alias("mark")).distinct()
    text = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    text = text.join(F.broadcast(marks), F.pmod("text_hash", F.lit(MARKS)) == F.col("mark"), "left_semi")
    text = text.join(asked, text.doc_id.eqNullSafe(asked["__id"]) & (text.text_hash == asked["__hash"]))
    text = text.select("__id", "__hash", "places", words_of(F.col("text")).alias("w"))
    place = F.explode(F.transform("places", lambda p: F.struct(
        p.at.alias("start"), p.n.alias("length"), p.h.alias("h"), F.slice("w", p.at + 1, p.n).alias("win"))))
    place = text.select("__id", "__hash", place.alias("p")).select("__id", "__hash", "p.*")
    hit = place.join(found, ["h", "win"]).groupBy("__id", "__hash").agg(
        F.array_sort(F.collect_set(F.struct("start", "length"))).alias("spans"),
        F.flatten(F.collect_set("items")).alias("all_items"))
    per = scanned.drop("places").join(hit, scanned.doc_id.eqNullSafe(hit["__id"]) & (scanned.text_hash == hit["__hash"]), "left")
    per = per.withColumn("spans", F.coalesce("spans", F.array().cast(hit.schema["spans"].dataType))).withColumn(
        "all_items", F.coalesce("all_items", F.array().cast("array<string>")))
    covered = F.aggregate(
        "spans", F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda a, s: F.struct(
            (a.n + F.greatest(F.lit(0), s.start + s.length - F.greatest(a.end, s.start))).alias("n"),
            F.greatest(a.end, s.start + s.length).alias("end")),
        lambda a: a.n).cast("long")
    items = F.array_sort(F.array_distinct("all_items"))
    return per.select(
        "doc_id", "text_hash", "n_words", covered.alias("n_hit"), F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), "spans").withColumn(
        "contaminated", (F.col("n_hit") > 0) & (F.lit(MIN_SHARE) * F.col("n_hit") >= F.col("n_words")))


def decontaminate(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """The documents that are not contaminated, unchanged."""
    found = contamination(docs, benchmark, size).where("contaminated").select("doc_id", "text_hash").distinct()
    return drop_rows(docs, stored(found, "contaminated"))


def remove_spans(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """Every document, with hit words (and the separators before them) cut out of its text."""
    found = stored(contamination(docs, benchmark, size).where("n_hit > 0")
                   .groupBy(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hit")).agg(F.first("spans").alias("__spans")), "hit-spans")
    # each piece is a word with what stands before it; a tail without a word is the last piece
    pieces = F.regexp_extract_all("text", F.lit(r"[^0-9A-Za-z\x80-\x{10FFFF}]*[0-9A-Za-z\x80-\x{10FFFF}]+|[^0-9A-Za-z\x80-\x{10FFFF}]+$"), F.lit(0))
    hit = F.flatten(F.transform("__spans", lambda s: F.sequence(s.start, s.start + s.length - 1)))
    # hit words in order between two ends: what stands between neighbours is kept
    ends = F.concat(F.array(F.lit(-1)), F.array_sort(F.array_distinct("__places")), F.array(F.size("__pieces")))
    runs = F.transform(F.slice("__ends", F.lit(2), F.size("__ends") - 1), lambda end, i: F.slice(
        "__pieces", F.get("__ends", i) + 2, end - F.get("__ends", i) - 1))
    kept = F.array_join(F.flatten(runs), "")
    d = docs.withColumn("__hash", F.xxhash64("text"))
    d = d.join(found, d.doc_id.eqNullSafe(found["__id"]) & (d["__hash"] == found["__hit"]), "left")
    d = d.withColumn("__pieces", pieces).withColumn("__places", hit).withColumn("__ends", ends)
    return d.withColumn("text", F.when(F.col("__spans").isNull(), F.col("text")).otherwise(kept)).select(*docs.columns)


ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item, least(len(w), 13) AS n, array_to_string(w[s:s + 12], ' ') AS t
        FROM (SELECT item, w, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS s FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
grams AS (SELECT doc_id, n, s, array_to_string(w[s:s + n - 1], ' ') AS t
          FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, sizes WHERE len(w) >= n)),
hits AS (SELECT g.doc_id, g.s, g.n, win.item FROM grams g JOIN win ON g.n = win.n AND g.t = win.t),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list
          FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(list, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""
