"""Token ids as length-delimited binary records with a separate offset index.

File format (little-endian).  ``part-N.rec`` is a run of records, each

    uint64 length | uint32 masked crc of the length bytes | payload | uint32 masked crc of the payload

with payload ``int64 doc_id, uint8 id is present, uint8 bytes per token id,
uint32 number of ids, ids``.  ``part-N.idx`` has one 32-byte entry per record
(``uint64 offset, uint64 length, int64 doc_id, uint64 ids before it in the
file``), so a shuffled read seeks any record without reading the others.  The
checksum is CRC-32, masked as ``rotate right 15, add 0xA282EAD8``.

Files are range partitions of ``doc_id`` in ascending order (null ids first),
rows of one id in the order of the table.
A task writes under a name of its own attempt and renames when complete, so a
repeated or speculative task leaves the same files.  Only one row per file
(its name and totals) is gathered.

Encoding uses the ``tokenizers`` library.  White space never crosses a token
of this vocabulary, so each distinct word is encoded once per worker and
cached in a table of bounded size; words outside Latin letters, or with a
special token's opening, go through the unchanged tokenizer.

Edge cases: null or empty text is the end id alone; repeated rows are separate
records; an empty table writes no record; extra columns are ignored; a file
whose checksum or length is wrong raises ``CorruptRecord``.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from martflow.llm import words as W
from martflow.llm.common import stored
from martflow.session import scratch_dir

END_ID = 1
MASK_DELTA = 0xA282EAD8  # fixed value of the masking rule
FRAME, CRC, HEAD = struct.Struct("<Q"), struct.Struct("<I"), struct.Struct("<qBBI")
INDEX = np.dtype([("offset", "<u8"), ("length", "<u8"), ("doc_id", "<i8"), ("start", "<u8")])
CACHE_WORDS = 400_000


class CorruptRecord(Exception):
    pass


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    size = FRAME.pack(len(payload))
    return b"".join((size, CRC.pack(masked(size)), payload, CRC.pack(masked(payload))))


# encoding -------------------------------------------------------------------

# Pieces of a lower-cased word of Latin letters, as the tokenizer's own split makes them.
_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\w\s]|_)+")
_LATIN = re.compile("[\x00-\x1b\x20-\x7fÀ-ſ]*")  # U+001C to U+001F are white space here, but symbols for the tokenizer


class WordEncoder:
    """Token ids of whole texts, each distinct word encoded once while cached."""

    def __init__(self, tokenizer_path: str, cache_words: int = CACHE_WORDS):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # one core per Spark task
        self.whole = Tokenizer.from_file(tokenizer_path)
        self.plain = Tokenizer.from_file(tokenizer_path)
        self.plain.normalizer = normalizers.Sequence([])
        self.plain.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary = self.whole.get_vocab(with_added_tokens=True)
        self.id_bytes = 2 if max(vocabulary.values()) < 1 << 16 else 4
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closes[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.cache = W.WordCache(cache_words)
        self.pieces: dict[str, list[int]] = {}

    def _encode_pieces(self, new: list[str]) -> None:
        step = 64
        batches = self.plain.encode_batch_fast([" ".join(new[i:i + step]) for i in range(0, len(new), step)],
                                               add_special_tokens=False)
        for i, encoded in enumerate(batches):
            part, ids = new[i * step:(i + 1) * step], encoded.ids
            ends = (np.flatnonzero(self.closes[ids]) + 1).tolist()
            if len(ends) == len(part):
                self.pieces.update(zip(part, [ids[a:z] for a, z in zip([0, *ends], ends)]))
            else:  # a piece without a closing token: one by one
                for p in part:
                    self.pieces[p] = self.plain.encode(p, add_special_tokens=False).ids

    def _encode_words(self, words: list[str]) -> list[list[int]]:
        split = [_PIECES.findall(w.lower()) if _LATIN.fullmatch(w) and "<|" not in w else None for w in words]
        new = list({p for s in split if s for p in s if p not in self.pieces})
        if new:
            self._encode_pieces(new)
        return [self.whole.encode(w, add_special_tokens=False).ids if s is None else [i for p in s for i in self.pieces[p]]
                for w, s in zip(words, split)]

    def encode(self, raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in one array, and the offsets of each text in it."""
        w = W.words(raw, at, W.NON_SPACE, lower=False)
        view = memoryview(raw)

        def encode_new(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            if len(self.pieces) > self.cache.limit:
                self.pieces.clear()
            ids = self._encode_words([str(view[a:b], "utf-8") for a, b in zip(w.start[places].tolist(), w.end[places].tolist())])
            sizes = np.fromiter(map(len, ids), np.int64, len(ids))
            return np.fromiter((i for x in ids for i in x), np.uint32, int(sizes.sum())), sizes

        flat, ends = self.cache.encode(w.hash, encode_new)
        return flat, np.concatenate([[0], ends])[np.searchsorted(w.start, at)]


_encoders: dict[str, WordEncoder] = {}


def encoder(tokenizer_path: str) -> WordEncoder:
    if tokenizer_path not in _encoders:
        _encoders[tokenizer_path] = WordEncoder(tokenizer_path)
    return _encoders[tokenizer_path]


# writing --------------------------------------------------------------------

def _write_part(it: Iterator[pa.RecordBatch], folder: str, tokenizer_path: str, end_id: int) -> Iterator[pa.RecordBatch]:
    where, root = fs.FileSystem.from_uri(folder)
    task = TaskContext.get()
    name = f"part-{task.partitionId():06d}"
    attempt = f"{root}/.{name}-{uuid.uuid4().hex}"
    enc = encoder(tokenizer_path)
    width, kind = enc.id_bytes, f"<u{enc.id_bytes}"
    end = np.array([end_id], kind).tobytes()
    offset = start = rows = 0
    where.create_dir(root, recursive=True)
    with where.open_output_stream(f"{attempt}.rec") as out, where.open_output_stream(f"{attempt}.idx") as index:
        for b in it:
            text, doc = b.column("text"), b.column("doc_id").to_pylist()
            for low, high in W.slices(text):
                flat, upto = enc.encode(*W.buffer_of(text.slice(low, high - low)))
                flat = flat.astype(kind)
                frames, entries = [], []
                for i, a, z in zip(doc[low:high], upto[:-1].tolist(), upto[1:].tolist()):
                    n = z - a + 1
                    record = frame(b"".join((HEAD.pack(i or 0, i is not None, width, n), flat[a:z].tobytes(), end)))
                    entries.append((offset, len(record), i or 0, start))
                    frames.append(record)
                    offset, start, rows = offset + len(record), start + n, rows + 1
                out.write(b"".join(frames))
                index.write(np.array(entries, INDEX).tobytes())
    if not rows:
        for kind in ("rec", "idx"):
            where.delete_file(f"{attempt}.{kind}")
        return
    for kind in ("idx", "rec"):
        where.move(f"{attempt}.{kind}", f"{root}/{name}.{kind}")
    yield pa.RecordBatch.from_pydict({"part": [task.partitionId()], "name": [name], "records": [rows],
                                      "ids": [start], "bytes": [offset]}, MANIFEST)


MANIFEST = pa.schema([("part", pa.int32()), ("name", pa.string()), ("records", pa.int64()), ("ids", pa.int64()),
                      ("bytes", pa.int64())])


def write(docs: DataFrame, tokenizer_path: str, folder: str | None = None, end_id: int = END_ID) -> tuple[str, DataFrame]:
    """Write all documents in ascending doc_id order; the folder and its manifest (one row per file)."""
    folder = folder or scratch_dir(docs.sparkSession, "token-records")
    # Rows of one id stay in the order of the table; their numbers also split an id that has very many.
    dealt = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row"))
    dealt = dealt.repartitionByRange("doc_id", "row").sortWithinPartitions("doc_id", "row").select("doc_id", "text")
    done = dealt.mapInArrow(lambda it: _write_part(it, folder, tokenizer_path, end_id),
                            "part int, name string, records long, ids long, bytes long")
    return folder, stored(done, "token-manifest")


# reading --------------------------------------------------------------------

def _checked(read) -> bytes | None:
    """Next payload from ``read(n)``; None at the end of the file."""
    size = read(FRAME.size)
    if not size:
        return None
    crc = read(CRC.size)
    if len(crc) < CRC.size or CRC.unpack(crc)[0] != masked(size):
        raise CorruptRecord("length checksum")
    payload = read(FRAME.unpack(size)[0])
    crc = read(CRC.size)
    if len(payload) != FRAME.unpack(size)[0] or len(crc) < CRC.size or CRC.unpack(crc)[0] != masked(payload):
        raise CorruptRecord("payload checksum")
    return payload


def parse(payload: bytes) -> tuple[int | None, np.ndarray]:
    doc, present, width, n = HEAD.unpack_from(payload)
    if len(payload) != HEAD.size + n * width:
        raise CorruptRecord("number of ids")
    return doc if present else None, np.frombuffer(payload, f"<u{width}", n, HEAD.size)


class RecordFile:
    """Random access to the records of one part through its index."""

    def __init__(self, folder: str, name: str):
        where, root = fs.FileSystem.from_uri(folder)
        with where.open_input_stream(f"{root}/{name}.idx") as f:
            self.index = np.frombuffer(f.read(), INDEX)
        self.file = where.open_input_file(f"{root}/{name}.rec")

    def __len__(self) -> int:
        return len(self.index)

    def __getitem__(self, i: int) -> tuple[int | None, np.ndarray]:
        self.file.seek(int(self.index["offset"][i]))
        return parse(_checked(lambda n: self.file.read(n)))


def _records_of(folder: str, part: int, name: str, base: int, seed: int | None) -> Iterator[tuple[int | None, int, np.ndarray]]:
    if seed is not None:  # seek the records in an order of their own
        file = RecordFile(folder, name)
        for i in np.random.default_rng([seed, part]).permutation(len(file)):
            doc, ids = file[i]
            yield doc, base + int(file.index["start"][i]), ids
        return
    where, root = fs.FileSystem.from_uri(folder)
    with where.open_input_stream(f"{root}/{name}.rec", buffer_size=1 << 20) as f:
        while (payload := _checked(f.read)) is not None:
            doc, ids = parse(payload)
            yield doc, base, ids
            base += len(ids)


def _read_parts(it: Iterator[pa.RecordBatch], folder: str, seed: int | None) -> Iterator[pa.RecordBatch]:
    for r in (r for b in it for r in b.to_pylist()):
        out, held = [], 0
        for doc, start, ids in _records_of(folder, r["part"], r["name"], r["start"], seed):
            out.append({"doc_id": doc, "start": start, "ids": ids.astype(np.int32)})
            held += len(ids)
            if held > 1 << 20:
                yield pa.RecordBatch.from_pylist(out, RECORDS)
                out, held = [], 0
        yield pa.RecordBatch.from_pylist(out, RECORDS)


def _digest_parts(it: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    for r in (r for b in it for r in b.to_pylist()):
        out = [(doc, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()))
               for doc, start, ids in _records_of(folder, r["part"], r["name"], r["start"], None)]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["doc_id", "start", "n_tokens", "ids_crc32"])


RECORDS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("ids", pa.list_(pa.int32()))])


def _files(manifest: DataFrame) -> DataFrame:
    """One row per file with the number of ids before it, a file per task."""
    files = manifest.count()
    before = (F.sum("ids").over(Window.orderBy("part")) - F.col("ids")).alias("start")
    return manifest.select("part", "name", before).repartition(max(1, files))


def read(spark: SparkSession, folder: str, manifest: DataFrame, shuffle_seed: int | None = None) -> DataFrame:
    """doc_id, start, ids of every record, checksums verified; with a seed each file in shuffled order."""
    return _files(manifest).mapInArrow(lambda it: _read_parts(it, folder, shuffle_seed), "doc_id long, start long, ids array<int>")


def digests(folder: str, manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every record, read back from the files."""
    return _files(manifest).mapInArrow(lambda it: _digest_parts(it, folder), "doc_id long, start long, n_tokens long, ids_crc32 long")
