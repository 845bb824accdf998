"""Repeated passages by seed and extend.

Seeds are winnowed: of the 5-word hashes in each window of 13 words the least is taken (the last of
equals), so equal windows have equal seeds.  Documents are joined on their seeds; round each seed that
another document has as well, the match is extended both ways, window by window, as far as the windows
that own the seed reach, and equal windows are joined with the least document that has them.  The
windows found this way, run together, are the maximal repeats of at least 13 words.

Before each shuffle the copies inside one task are settled: a seed or window that several documents of a slice
hold leaves once, and the task remembers it, so a passage that stands in a third of all documents costs some
rows a task and not one for each of its places.  What a task remembers is bounded; what it forgets is sent again.

Windows are told apart by 128 bits: the hash of their seed, and that of their words, built on another hash of each word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import Spans, as_list, id_text, mix, signed, slices, split_words, windows
from starloom.llm.text_stats import words_in

LENGTH, SEED = 13, 5
JOIN_SLICE = 2 << 20
#: So many seeds and windows does a task remember as shared.
REMEMBERED = 1 << 18


def seeds_of(words: Spans, length: int = LENGTH, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """For each window of ``length`` words: the index of its first word, and its seed's hash."""
    at, h = windows(words, seed)
    span = length - seed + 1
    n = len(words.hash)
    if n < length:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    full = np.zeros(n, dtype=np.uint64)
    full[at] = h
    first = np.flatnonzero(words.row[: n - length + 1] == words.row[length - 1 :])
    least = full[: n - span + 1].copy()
    for i in range(1, span):
        np.minimum(least, full[i : n - span + 1 + i], out=least)
    return first, least[first]


def _seed_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(seed, doc_id, th) for seeds of one row; for seeds of more rows of the slice one row without a
    document, and to each of these rows what it now knows to be shared."""
    seen = np.zeros(0, dtype=np.uint64)
    for batch in slices(batches, limit=JOIN_SLICE):
        words = split_words(batch.column("text"))
        at, h = seeds_of(words)
        if not len(at):
            continue
        row = words.row[at]
        keep = np.concatenate([[True], (h[1:] != h[:-1]) | (row[1:] != row[:-1])])  # neighbours mostly agree
        h, row = h[keep], row[keep]
        order = np.lexsort((row, h))
        h, row = h[order], row[order]
        keep = np.concatenate([[True], (h[1:] != h[:-1]) | (row[1:] != row[:-1])])
        h, row = h[keep], row[keep]
        start = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        size = np.diff(np.append(start, len(h)))
        again = _within(h[start], seen)
        alone, many = start[(size == 1) & ~again], start[(size > 1) & ~again]
        ids, ths = batch.column("doc_id").to_numpy(), batch.column("th").to_numpy()
        known = np.repeat((size > 1) | again, size)
        if len(seen) < REMEMBERED:
            seen = np.union1d(seen, h[many])
        back = np.argsort(row[known], kind="stable")
        who, what = row[known][back], h[known][back]
        has = np.unique(who)
        bounds = np.searchsorted(who, np.append(has, len(ids)))
        n, m, k = len(alone), len(many), len(has)
        yield pa.record_batch(
            [
                pa.array(np.concatenate([signed(h[alone]), signed(h[many]), signed(mix(has.astype(np.uint64) ^ ids[has].view(np.uint64)))])),
                pa.array(np.concatenate([ids[row[alone]], np.zeros(m), ids[has]]).astype(np.int64), mask=np.concatenate([np.zeros(n, bool), np.ones(m, bool), np.zeros(k, bool)])),
                pa.array(np.concatenate([ths[row[alone]], np.zeros(m, np.int64), ths[has]])),
                _told(signed(what), n + m, bounds, pa.int64()),
            ],
            names=["seed", "doc_id", "th", "known"],
        )


def _window_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(seed, doc_id, th, at, wins): hashes of the windows in a row that own a shared seed, for windows of which
    the row's document is the least of the slice; and (doc_id, th, known): starts of windows that a smaller
    document of the slice, or of the task before it, has as well."""
    seen = np.zeros((3, 0), dtype=np.uint64)  # windows in order, their seeds, and the least documents that have been sent
    for batch in slices(batches, limit=JOIN_SLICE):
        words = split_words(batch.column("text"))
        at, h = seeds_of(words)
        if not len(at):
            continue
        win = windows(words, LENGTH, salt=1)[1]
        shared = batch.column("seeds")
        lens = np.diff(np.asarray(shared.offsets))
        values = np.asarray(shared.flatten()).view(np.uint64)
        row = words.row[at]
        # a seed of one row may be shared only there: pair it with its row
        own, theirs = _pair(h, row), _pair(values, np.repeat(np.arange(len(lens)), lens))
        hit = np.isin(own, theirs)
        at, row, h, win = at[hit], row[hit], h[hit], win[hit]
        if not len(at):
            continue
        ids, ths = batch.column("doc_id").to_numpy(), batch.column("th").to_numpy()
        doc, place = ids[row], at - words.bounds[row]
        order = np.lexsort((doc, win, h))
        a, b, d = h[order], win[order], doc[order]
        fresh = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
        group, lead = np.cumsum(fresh) - 1, np.flatnonzero(fresh)
        place_of = np.minimum(np.searchsorted(seen[0], b[lead]), max(0, seen.shape[1] - 1))
        told = (seen[0][place_of] == b[lead]) & (seen[1][place_of] == a[lead]) if seen.shape[1] else np.zeros(len(lead), dtype=bool)
        least = d[lead].copy()
        if told.any():
            least[told] = np.minimum(least[told], seen[2][place_of[told]].view(np.int64))
            seen[2][place_of[told]] = least[told].view(np.uint64)
        more = np.flatnonzero(~told & (np.diff(np.append(lead, len(d))) > 1))
        if len(more) and seen.shape[1] < REMEMBERED:
            seen = np.concatenate([seen, np.stack([b[lead[more]], a[lead[more]], d[lead[more]].view(np.uint64)])], axis=1)
            seen = seen[:, np.argsort(seen[0], kind="stable")]
        sure = np.zeros(len(order), dtype=bool)
        sure[order] = d > least[group]
        who, what = row[sure], place[sure]
        has = np.unique(who)
        ask = ~sure
        seed, r, p, w = h[ask], row[ask], place[ask], win[ask]
        first = np.flatnonzero(np.concatenate([[True], (r[1:] != r[:-1]) | (seed[1:] != seed[:-1]) | (p[1:] != p[:-1] + 1)])) if len(r) else np.zeros(0, np.int64)
        n, k = len(first), len(has)
        yield pa.record_batch(
            [
                pa.array(np.concatenate([signed(seed[first]), signed(mix(has.astype(np.uint64) ^ ids[has].view(np.uint64)))])), pa.array(np.concatenate([ids[r[first]], ids[has]])), pa.array(np.concatenate([ths[r[first]], ths[has]])),
                pa.array(np.concatenate([p[first], np.zeros(k, np.int64)]), pa.int32()), as_list(signed(w), np.concatenate([first, np.full(k + 1, len(w))]), pa.int64()), _told(what, n, np.searchsorted(who, np.append(has, len(ids))), pa.int32()),
            ],
            names=["seed", "doc_id", "th", "at", "wins", "known"],
        )


def _told(values: np.ndarray, nulls: int, bounds: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column: null for the first rows, then values[bounds[i]:bounds[i + 1]]."""
    offsets = pa.array(np.concatenate([np.zeros(nulls, np.int64), bounds]), pa.int32(), mask=np.concatenate([np.ones(nulls, bool), np.zeros(len(bounds), bool)]))
    return pa.ListArray.from_arrays(offsets, pa.array(values, kind))


def _within(h: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are in a sorted array."""
    if not len(known):
        return np.zeros(len(h), dtype=bool)
    return known[np.minimum(np.searchsorted(known, h), len(known) - 1)] == h


def _pair(h: np.ndarray, row: np.ndarray) -> np.ndarray:
    return h ^ (row.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))


def repeat_starts(docs: DataFrame) -> DataFrame:
    """doc_id, th, starts array<int>: word indexes at which a window starts that also starts in a
    smaller document.  th is a hash of the text, so rows that share a doc_id stay apart."""
    texts = _texts(docs)
    # rows that tell what a slice has settled ride along under a key of their own
    rows = texts.mapInArrow(_seed_rows, "seed long, doc_id long, th long, known array<long>")
    met = F.count(F.when(F.col("known").isNull(), 1)).over(Window.partitionBy("seed"))
    shared = _gathered(rows.withColumn("n", met).where("known is not null or (n > 1 and doc_id is not null)"), "seed").withColumnRenamed("all", "seeds")
    found = texts.join(shared, ["doc_id", "th"]).select("doc_id", "th", "text", "seeds").mapInArrow(_window_rows, "seed long, doc_id long, th long, at int, wins array<long>, known array<int>")
    # windows travel with their seed, some five to a row, and are taken apart where they meet
    each = found.repartition("seed").select("seed", "doc_id", "th", "known", "at", F.posexplode_outer("wins").alias("i", "win")).withColumn("at", F.col("at") + F.col("i"))
    least = F.min("doc_id").over(Window.partitionBy("seed", "win"))
    return _gathered(each.withColumn("least", least).where("known is not null or (win is not null and least < doc_id)"), "at").select("doc_id", "th", F.array_sort("all").alias("starts"))


def _gathered(rows: DataFrame, column: str) -> DataFrame:
    """doc_id, th, all: the distinct values of a column and of the arrays in known, for each text."""
    one = F.collect_list(F.when(F.col("known").isNull(), F.col(column)))
    return rows.groupBy("doc_id", "th").agg(F.array_distinct(F.concat(one, F.flatten(F.collect_list("known")))).alias("all"))


def _texts(docs: DataFrame) -> DataFrame:
    """The rows that have a place in the order of documents, the same frame for both joins, which then share
    one exchange of the texts (th is made not nullable, else the inner join would filter it apart)."""
    return id_text(docs).select("doc_id", F.coalesce(F.xxhash64("text"), F.lit(0)).alias("th"), "text").where("doc_id is not null")


def spans_of(starts: np.ndarray, length: int = LENGTH) -> list[tuple[int, int]]:
    """Maximal repeats: the runs of words that the windows at these starts cover."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > length)
    return list(zip(starts[np.append(0, cut + 1)].tolist(), (starts[np.append(cut, len(starts) - 1)] + length).tolist(), strict=True))


def without_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_text, spans: texts without their repeated passages.

    spans are word ranges [from, to) taken out; kept_text is the kept words joined by one space.
    Null and empty texts, and texts under 13 words, lose nothing.  Repeated rows are treated alike:
    rows of one doc_id are no repeats of each other.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            n_words, removed, kept, spans = [], [], [], []
            for text, starts in zip(batch.column("text").to_pylist(), batch.column("starts").to_pylist(), strict=True):
                words = words_in(text)
                runs = spans_of(np.array(starts)) if starts else []
                left, upto = [], 0
                for a, b in runs:
                    left += words[upto:a]
                    upto = b
                left += words[upto:]
                n_words.append(len(words))
                removed.append(len(words) - len(left))
                kept.append(" ".join(left))
                spans.append([x for r in runs for x in r])
            yield pa.record_batch([batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string()), pa.array(spans, pa.list_(pa.int32()))], names=["doc_id", "n_words", "n_removed", "kept_text", "spans"])

    # a null doc_id is smaller than nothing, and nothing is smaller than it: such rows keep all words
    apart = id_text(docs).where("doc_id is null").select("doc_id", "text", F.lit(None).cast("array<int>").alias("starts"))
    placed = _texts(docs).join(repeat_starts(docs), ["doc_id", "th"], "left").select("doc_id", "text", "starts")
    return placed.unionByName(apart).mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_text string, spans array<int>")


def digests(kept: DataFrame) -> DataFrame:
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text"), 256).alias("kept_sha256"), (F.size("spans") / 2).cast("long").alias("n_spans"))
