"""Landing-zone CSV files -> typed staging rows (+ quarantine).

Files are positional CSV with a header row (skipped, names ignored), optional
double quotes, empty field = NULL.  Every field is first read as text together
with Spark's corrupt-record column, then converted with ``try_cast``:

* a row with too few or too many fields is flagged by the CSV parser;
* a non-empty field that does not convert (not a number, more digits than the
  decimal type holds, not a timestamp) is flagged by the failed cast.

Flagged rows go to quarantine with a reason instead of silently becoming NULL
(which the silver clamps would turn into 0).  The same conversion serves the
batch reader and the file stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"
INTEGER_DIGITS = 6  # fixed value of the landing contract
FILE_ROWS = 1_000_000  # a compressed file is read by one task
LOAD_COL = "ingestion_ts"
SOURCE_FILE = "_source_file"

CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": CORRUPT,
    "enforceSchema": "true",
    # a prefix may hold one folder per upload
    "recursiveFileLookup": "true",
    # Check every row's field count: with column pruning in the parser a
    # consumer that needs few columns (a count, the quarantine branch) would
    # let short and long rows through as good rows.
    "columnPruning": "false",
}


def csv_options(multiline: bool = False) -> dict[str, str]:
    """Reader options; ``multiline`` allows line breaks inside quoted fields.

    A multi-line file cannot be split, so it is read by one task: use it for
    prefixes whose files are bounded in size.
    """
    return CSV_OPTIONS | {"multiLine": str(multiline).lower()}


def with_source_file(raw: DataFrame) -> DataFrame:
    """Keep the file each row came from (read at scan time; also in streams)."""
    return raw.select("*", F.col("_metadata.file_path").alias(SOURCE_FILE))


def raw_schema(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields]
                        + [T.StructField(CORRUPT, T.StringType())])


def _typed(c: str, dtype: T.DataType):
    if isinstance(dtype, T.StringType):
        return F.col(c)
    if isinstance(dtype, T.IntegerType):  # a whole number of at most six digits; "3.0" is one
        return F.expr(f"CAST(try_cast(`{c}` AS DECIMAL({INTEGER_DIGITS},0)) AS INT)")
    return F.expr(f"try_cast(`{c}` AS {dtype.simpleString()})")


# Every row needs its version time: without it a row can be neither ranked nor
# compared with a high-water mark (a first build would keep it, an incremental
# one silently drop it), so it is quarantined in both.
REQUIRED = ("created_at",)


def type_rows(raw: DataFrame, schema: T.StructType, load_stamp=None,
              required=REQUIRED) -> DataFrame:
    """Typed columns + ``_reason`` (NULL for good rows)."""
    reasons = [F.when(F.col(CORRUPT).isNotNull(), F.lit("malformed row"))]
    reasons += [F.when(F.col(c).isNull(), F.lit(f"missing {c}"))
                for c in required if c in schema.fieldNames()]
    typed = []
    for f in schema.fields:
        t = _typed(f.name, f.dataType)
        typed.append(t.alias(f.name))
        if not isinstance(f.dataType, T.StringType):
            reasons.append(F.when(F.col(f.name).isNotNull() & t.isNull(),
                                  F.lit(f"bad {f.name}")))
    stamp = load_stamp if load_stamp is not None else F.current_timestamp().cast(T.TimestampNTZType())
    # The quarantined record keeps every field (or the unparsable line).
    raw_text = F.coalesce(F.col(CORRUPT),
                          F.concat_ws(",", *[F.coalesce(F.col(f.name), F.lit("")) for f in schema.fields]))
    return raw.select(*typed, stamp.alias(LOAD_COL),
                      F.coalesce(*reasons).alias("_reason"),
                      raw_text.alias(CORRUPT), F.col(SOURCE_FILE))


def split_good_bad(typed: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    good = typed.where(F.col("_reason").isNull()).select(*[f.name for f in schema.fields], LOAD_COL)
    bad = typed.where(F.col("_reason").isNotNull()).select(
        F.col("_reason").alias("reason"), F.col(CORRUPT).alias("raw_record"),
        F.col(SOURCE_FILE).alias("source_file"), LOAD_COL,
        *[f.name for f in schema.fields])  # typed fields (NULL where the cast failed)
    return good, bad


def has_files(spark: SparkSession, path: str) -> bool:
    """Whether anything was landed under a prefix yet."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def read_landing(spark: SparkSession, path: str | list[str], schema: T.StructType,
                 load_stamp=None, multiline: bool = False) -> tuple[DataFrame, DataFrame]:
    """Batch scan of a landing prefix, or of some of its files: (good typed rows with load stamp, quarantine)."""
    raw = with_source_file(spark.read.schema(raw_schema(schema)).options(**csv_options(multiline)).csv(path))
    return split_good_bad(type_rows(raw, schema, load_stamp), schema)


def write_landing(df: DataFrame, path: str, schema: T.StructType, files: int | None = None,
                  mode: str = "errorifexists") -> None:
    """Write entity rows as landing CSV, gzipped (header, a file per partition and ``FILE_ROWS`` rows).

    Text is the widest form the rows ever have; readers tell the compression by the file name.
    """
    out = df.select(*[F.col(f.name) for f in schema.fields])
    if files:
        out = out.repartition(files)
    (out.write.mode(mode).option("header", "true").option("quote", '"')
     .option("escape", '"').option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
     .option("compression", "gzip").option("maxRecordsPerFile", str(FILE_ROWS))
     .csv(path))
