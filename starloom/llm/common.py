"""Shared helpers of the text operators: reading, word hashing in numpy, small plan utilities.

Words are runs of anything but the six ASCII white space bytes, found on the UTF-8 bytes of an
Arrow batch.  Tasks work on slices of a few megabytes, so memory follows the slice, not the
partition; a single longer text makes a slice of its own.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

WORD = r"[^\x20\x09-\x0D]+"
SLICE_BYTES = 1 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_U = np.uint64


BATCH_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the input; texts go to Python in batches of at most BATCH_BYTES, whatever their rows' length."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_text(docs: DataFrame) -> DataFrame:
    """(doc_id, text) of a documents table, whatever else it carries; a null text counts as empty."""
    # a needless alias would keep Spark from seeing that two joins read the same exchange
    doc_id = F.col("doc_id") if docs.schema["doc_id"].dataType == LongType() else F.col("doc_id").cast("long").alias("doc_id")
    return docs.select(doc_id, F.coalesce(F.col("text"), F.lit("")).alias("text"))


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Row slices of the batches whose texts come to about ``limit`` bytes each."""
    for batch in batches:
        if not batch.num_rows:
            continue
        texts = batch.column(column)
        if texts.null_count:
            texts = texts.fill_null("")
        ends = offsets_of(texts)[1:]
        at = 0
        while at < batch.num_rows:
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(at, to - at)
            at = to


def offsets_of(column: pa.Array) -> np.ndarray:
    """Byte offsets of a string array, from 0."""
    wide = pa.types.is_large_string(column.type)
    raw = np.frombuffer(column.buffers()[1], dtype=np.int64 if wide else np.int32)
    own = raw[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return own - own[0]


def bytes_of(column: pa.Array) -> np.ndarray:
    wide = pa.types.is_large_string(column.type)
    raw = np.frombuffer(column.buffers()[1], dtype=np.int64 if wide else np.int32)
    first, last = int(raw[column.offset]), int(raw[column.offset + len(column)])
    if first == last:
        return np.zeros(0, dtype=np.uint8)
    return np.frombuffer(column.buffers()[2], dtype=np.uint8)[first:last]


@dataclass
class Spans:
    """Pieces of a text column: byte spans, the row of each, a 64-bit hash, and rows' bounds in them."""

    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    hash: np.ndarray
    bounds: np.ndarray
    data: np.ndarray

    def other_hash(self) -> np.ndarray:
        """A second, independent hash of each."""
        return _hashed(self.data, self.start, self.end, 1)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    h = h ^ (h >> _U(31))
    h = h * _U(0xD6E8FEB86659FD93)
    h = h ^ (h >> _U(29))
    h = h * _U(0xA0761D6478BD642F)
    return h ^ (h >> _U(32))


#: Of a word's last chunk of 8 bytes, so many belong to it.
_KEEP = np.array([(1 << (8 * n)) - 1 for n in range(9)], dtype=np.uint64)
_LANES = ((_U(0x9E3779B97F4A7C15), _U(0xE7037ED1A0B428DB)), (_U(0x8EBC6AF09C88C6E3), _U(0x589965CC75374CC3)))
#: Words of more bytes are hashed one by one.
_LONG = 512


def _hashed(data: np.ndarray, start: np.ndarray, end: np.ndarray, lane: int = 0) -> np.ndarray:
    """64-bit hashes of byte spans; lane 1 is independent of lane 0.

    Each 8 bytes are scrambled into the state before the next ones come, and the length is part of the
    first state; so, unlike sums over powers, no pattern of equal bytes in two words cancels.
    """
    step, salt = _LANES[lane]
    size = end - start
    chunk = np.ndarray(len(data) + 1, dtype="<u8", buffer=np.concatenate([data, np.zeros(8, np.uint8)]), strides=(1,))
    state = mix((chunk[start] & _KEEP[np.minimum(size, 8)]) ^ mix(size.astype(np.uint64) * step + salt))
    left = np.flatnonzero((size > 8) & (size <= _LONG))
    at = 8
    while len(left):
        more = chunk[start[left] + at] & _KEEP[np.minimum(size[left] - at, 8)]
        state[left] = mix((state[left] * step + salt) ^ more)
        at += 8
        left = left[size[left] > at]
    for i in np.flatnonzero(size > _LONG):
        state[i] = int.from_bytes(hashlib.blake2b(data[start[i] : end[i]], digest_size=8, salt=bytes([lane])).digest(), "little")
    return state


def hashes_of(column: pa.Array) -> np.ndarray:
    """64-bit hashes of the strings of a column without nulls, made in parts of a slice's size."""
    out = [np.zeros(0, np.uint64)]
    for part in slices(iter([pa.record_batch([column], names=["text"])])):
        off = offsets_of(part.column(0))
        out.append(_hashed(bytes_of(part.column(0)), off[:-1], off[1:]))
    return np.concatenate(out)


_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[[*b".,!?;:\"'()[]"]] = 32


def fold(data: np.ndarray) -> np.ndarray:
    """UTF-8 bytes with ASCII punctuation as spaces, and ASCII and Latin-1 letters in lower case."""
    out = _FOLD[data]
    upper = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)) + 1
    out[upper] += 32
    return out


def split_words(column: pa.Array, folded: bool = False) -> Spans:
    """The words of every row of a string column without nulls, as they are or in lower case without punctuation."""
    data, off = bytes_of(column), offsets_of(column)
    data = fold(data) if folded else data
    n = len(data)
    if not n:
        empty = np.zeros(0, dtype=np.int64)
        return Spans(empty, empty, empty, empty.astype(np.uint64), np.zeros(len(column) + 1, dtype=np.int64), data)
    inside = ~_SPACE[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    full = np.flatnonzero(off[1:] > off[:-1])
    first[off[full]] = inside[off[full]]
    last[off[full + 1] - 1] = inside[off[full + 1] - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    bounds = np.searchsorted(start, off, side="left")
    row = np.repeat(np.arange(len(column)), np.diff(bounds))
    return Spans(start, end, row, _hashed(data, start, end), bounds, data)


def windows(words: Spans, k: int, salt: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """For each run of k words of one row: the index of its first word, and a 64-bit hash; salt 1 builds on the words' other hash."""
    n, each = len(words.hash), words.other_hash() if salt else words.hash
    if n < k:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    base = _U((0x9E3779B97F4A7C15 * (2 * salt + 3)) & (2**64 - 1) | 1)
    h = each[: n - k + 1].copy()
    for i in range(1, k):
        h *= base
        h += each[i : n - k + 1 + i]
    at = np.flatnonzero(words.row[: n - k + 1] == words.row[k - 1 :])
    return at, mix(h[at])


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def as_list(values: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column: row i holds values[bounds[i]:bounds[i + 1]]."""
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, kind))


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage with a copy in the folder that all executors share."""
    sc = df.sparkSession.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """Cut the lineage with a Parquet table in that folder, for rows that are read more than once and in part."""
    folder = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; only a session on one machine, as in tests, may do without it."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    import tempfile

    return tempfile.mkdtemp(prefix="starloom-")


def crc_fold(column: str, n: int) -> F.Column:
    return F.crc32(F.col(column).cast("string")) % n


def labelled(labels: DataFrame, label: str) -> DataFrame:
    """(doc_id, y): the labels that say 0 or 1."""
    return labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")).where("doc_id is not null and y in (0, 1)")


def first_of_each(known: DataFrame, per_class: int) -> DataFrame:
    """Of each value of a label, the ``per_class`` rows first in hash order."""
    parts = [known.where(F.col("y") == v).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for v in (0, 1)]
    return parts[0].unionByName(parts[1])


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int) -> DataFrame:
    """(doc_id, text, y): of each value of a label, the ``per_class`` rows first in hash order.

    Both halves are cut by the same documented bound, so what is broadcast, and what a fit later
    gathers, has at most 2 x per_class rows at any input size.
    """
    return id_text(docs).join(F.broadcast(first_of_each(labelled(labels, label), per_class)), "doc_id")
