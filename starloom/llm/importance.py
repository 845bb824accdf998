"""Resampling of documents towards a target: hashed n-gram importance weights and a Gumbel top-k draw.

Pass 1 counts hashed features of both corpora: each task adds ``np.bincount`` vectors of its slices
and hands on one vector, and ``treeReduce`` merges those, so what moves is one vector a partition.
The gains of the 10,000 buckets follow from the two sums and are broadcast (80 kB).  Pass 2 gathers
the gains of each document's features and sums them with weights in ``np.bincount``.

Words are runs of digits, ASCII letters (A-Z as a-z) and bytes above 0x7F.  A feature's bucket is
the CRC-32 of its bytes modulo the number of buckets; the CRC of a pair of words comes from those of
its words, as CRC-32 is linear over GF(2).

Null and empty texts have no features and weight 0.  Each row gives a row, so repeated rows repeat;
other columns are not read.  A null doc_id draws with an empty id, and comes last among ties.  Rows
that tie in score and doc_id rank by their number of features and weight.  Long texts make slices of
their own.  Without documents nothing is drawn; without a target all gains come from the smoothing.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import bytes_of, id_text, offsets_of, slices, stored

BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 25
#: Words of up to so many bytes are hashed together, longer ones one by one.
LONG = 64

_INSIDE = np.zeros(256, dtype=bool)
_INSIDE[48:58] = _INSIDE[65:91] = _INSIDE[97:123] = _INSIDE[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _byte_steps() -> np.ndarray:
    """What a byte of the CRC's state becomes, by the reflected polynomial of CRC-32."""
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0xEDB88320), t >> 1)
    return t


_STEP = _byte_steps()
_ONES = np.uint32(0xFFFFFFFF)


def _over_zeros() -> np.ndarray:
    """[n, k, v]: the state whose byte k is v, after n zero bytes."""
    state = (np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]).astype(np.uint32)
    out = np.empty((LONG + 1, 4, 256), dtype=np.uint32)
    for n in range(LONG + 1):
        out[n] = state
        state = _STEP[state & 255] ^ (state >> 8)
    return out


_ZEROS = _over_zeros()


@dataclass
class Features:
    """Buckets of all features of a slice, the row of each, and the words of each row."""

    bucket: np.ndarray
    row: np.ndarray
    n_words: np.ndarray


def _word_states(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The CRC's state after each word."""
    state = np.full(len(start), _ONES, dtype=np.uint32)
    order = np.argsort(-size, kind="stable")
    by_size = size[order]
    long = int(np.searchsorted(-by_size, -LONG, side="left"))
    for i in order[:long]:
        state[i] = np.uint32(zlib.crc32(data[start[i] : start[i] + size[i]])) ^ _ONES
    at, run = start[order[long:]], np.full(len(start) - long, _ONES, dtype=np.uint32)
    by_size = by_size[long:]
    for j in range(int(by_size[0]) if len(by_size) else 0):
        k = int(np.searchsorted(-by_size, -j, side="left"))
        run[:k] = _STEP[(run[:k] ^ data[at[:k] + j]) & 255] ^ (run[:k] >> 8)
    state[order[long:]] = run
    return state


def features(column: pa.Array, buckets: int = BUCKETS) -> Features:
    """Single words and pairs of neighbours of a string column without nulls."""
    data, off = _LOWER[bytes_of(column)], offsets_of(column)
    inside = np.concatenate([[False], _INSIDE[data], [False]])
    edge = inside[1:] != inside[:-1]  # edge[i]: a word begins or ends before byte i
    cut = off[(off > 0) & (off < len(data))]
    joined = np.unique(cut[inside[cut] & inside[cut + 1]])  # a word may not reach over a text's end
    start = np.sort(np.concatenate([np.flatnonzero(edge & inside[1:]), joined]))
    end = np.sort(np.concatenate([np.flatnonzero(edge & inside[:-1]), joined]))
    size = end - start
    bounds = np.searchsorted(start, off, side="left")
    row = np.repeat(np.arange(len(column)), np.diff(bounds))
    state = _word_states(data, start, size)
    first = np.flatnonzero(row[1:] == row[:-1])
    spaced = _STEP[(state[first] ^ np.uint32(32)) & 255] ^ (state[first] >> 8)
    follows, n = first + 1, size[first + 1]
    change, short = spaced ^ _ONES, np.minimum(n, LONG)
    pair = state[follows]
    for k in range(4):
        pair = pair ^ _ZEROS[short, k, (change >> np.uint32(8 * k)) & 255]
    for i in np.flatnonzero(n > LONG):
        word = data[start[follows[i]] : end[follows[i]]]
        pair[i] = np.uint32(zlib.crc32(word, int(spaced[i] ^ _ONES))) ^ _ONES
    crc = np.concatenate([state, pair]) ^ _ONES
    return Features((crc % np.uint32(buckets)).astype(np.int64), np.concatenate([row, row[first]]), np.diff(bounds))


def feature_counts(texts: DataFrame, buckets: int = BUCKETS, least_words: int = LEAST_WORDS) -> tuple[np.ndarray, int]:
    """(features in each bucket, rows with at least ``least_words`` words) of a table with a column text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets + 1, dtype=np.int64)
        for batch in slices(batches):
            f = features(batch.column("text"), buckets)
            total[:buckets] += np.bincount(f.bucket, minlength=buckets)
            total[buckets] += int((f.n_words >= least_words).sum())
        yield pa.record_batch([pa.array([total.tobytes()], pa.binary())], names=["counts"])

    vectors = texts.select(F.coalesce(F.col("text"), F.lit("")).alias("text")).mapInArrow(run, "counts binary").rdd.map(lambda r: np.frombuffer(r[0], dtype=np.int64))
    empty = texts.sparkSession.sparkContext.parallelize([np.zeros(buckets + 1, dtype=np.int64)], 1)
    total = vectors.union(empty).treeReduce(np.add, depth=3)
    return total[:buckets], int(total[buckets])


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln(target share / raw share)) of each bucket, one added to every count."""
    buckets, of_raw, of_target = len(raw), int(raw.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1) * (of_raw + buckets) / ((s + 1) * (of_target + buckets)))) for s, t in zip(raw.tolist(), target.tolist(), strict=True)], dtype=np.float64)


def noise(doc_id: int | None, seed: int) -> int:
    """A Gumbel deviate of a seed and an id, in thousandths."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weigh(docs: DataFrame, gain: np.ndarray, seed: int = 7) -> DataFrame:
    """doc_id, n_words, n_features, weight, score: a document's mean gain, and that plus its noise."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_bucket = shared.value
        for batch in slices(batches):
            f = features(batch.column("text"), len(by_bucket))
            n = np.bincount(f.row, minlength=batch.num_rows)
            total = np.bincount(f.row, weights=by_bucket[f.bucket], minlength=batch.num_rows).astype(np.int64)
            weight = total // np.maximum(n, 1)
            score = weight + np.array([noise(i, seed) for i in batch.column("doc_id").to_pylist()], dtype=np.int64)
            yield pa.record_batch([batch.column("doc_id"), pa.array(f.n_words, pa.int64()), pa.array(n, pa.int64()), pa.array(weight), pa.array(score)], names=["doc_id", "n_words", "n_features", "weight", "score"])

    return id_text(docs).mapInArrow(run, "doc_id long, n_words long, n_features long, weight long, score long")


def draw(weighed: DataFrame, eligible: int, least_words: int = LEAST_WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_features, weight, score, rank: ranks of the highest ``percent`` of the eligible documents.

    Rows are ranked inside each score and moved on by the rows above it.  Scores are whole thousandths of
    logarithms of 64-bit counts and of 32-bit noise, so there are at most some 115,000 of them, and the
    table of what stands above each is small whatever the number of documents.
    """
    spark, take = weighed.sparkSession, percent * eligible // 100
    long_enough = F.col("n_words") >= least_words
    above, at = 0, []
    for score, n in sorted(((r.score, r.n) for r in weighed.where(long_enough).groupBy("score").agg(F.count("*").alias("n")).collect()), reverse=True) if take else []:
        if above >= take:
            break
        at.append((score, above))
        above += n
    out = ["doc_id", "n_features", "weight", "score"]
    lowest = at[-1][0] if at else None
    drawn = long_enough & (F.col("score") >= lowest) if at else F.lit(False)
    rest = weighed.where(~drawn).select(*out, F.lit(None).cast("long").alias("rank"))
    if not at:
        return rest
    place = F.row_number().over(Window.partitionBy("score").orderBy(F.col("doc_id").asc_nulls_last(), "n_features", "weight")) + F.col("above")
    ranked = weighed.where(drawn).join(F.broadcast(spark.createDataFrame(at, "score long, above long")), "score").withColumn("place", place)
    return ranked.select(*out, F.when(F.col("place") <= take, F.col("place")).cast("long").alias("rank")).unionByName(rest)


def resample(docs: DataFrame, target: DataFrame, seed: int = 7, buckets: int = BUCKETS, least_words: int = LEAST_WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_features, weight, score, rank of every document; undrawn ones have no rank."""
    raw, eligible = feature_counts(docs, buckets, least_words)
    gain = gains(raw, feature_counts(target, buckets, least_words)[0])
    return draw(stored(weigh(docs, gain, seed)), eligible, least_words, percent)
