"""All pairs of texts whose sets of five-word shingles have a Jaccard similarity of at least 0.8.

1. Texts with the same shingle set form one node, named by its least doc_id.
2. Banded MinHash gathers what may be similar: with BANDS bands of ROWS values, two sets at 0.8 fail
   to share a band with probability (1 - 0.8**ROWS)**BANDS, 2e-10.  Nodes of a band value are tied to
   the least of them, and the components of these ties hold every candidate pair.
3. A component is cut into blocks of at most BLOCK nodes by hash, and each pair of blocks is one group:
   its MinHash values are compared a few at a time, and a pair is dropped as soon as the
   posterior probability that its similarity reaches the threshold, under a flat prior, is below TOLERANCE.
   Pairs that stay are verified exactly on the shingle sets.
4. Groups return counts of links and a spanning forest, never the pairs, so a group of n similar texts
   costs rows in proportion to n times its number of blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import as_list, checkpoint, id_text, mix, signed, slices, split_words, windows
from starloom.llm.components import components

SHINGLE, THRESHOLD = 5, 0.8
BANDS, ROWS = 56, 5
BLOCK = 256
STEP, TOLERANCE = 28, 1e-9
_U = np.uint64


def multipliers(n: int = BANDS * ROWS) -> np.ndarray:
    return np.random.default_rng(20240501).integers(1, 1 << 63, n, dtype=np.uint64) | _U(1)


def shingle_sets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every row, end to end, and the rows' bounds in them.

    A text of fewer than five words has one shingle, all its words; a text without words has none.
    """
    words = split_words(column)
    at, h = windows(words, SHINGLE)
    row = words.row[at]
    sizes = np.diff(words.bounds)
    short = np.flatnonzero((sizes > 0) & (sizes < SHINGLE))
    if len(short):
        extra = mix(np.array([_fold(words.hash[words.bounds[r] : words.bounds[r + 1]]) for r in short], dtype=np.uint64))
        h, row = np.concatenate([h, extra]), np.concatenate([row, short])
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    fresh = np.concatenate([[True], (h[1:] != h[:-1]) | (row[1:] != row[:-1])]) if len(h) else np.zeros(0, bool)
    h, row = h[fresh], row[fresh]
    return h, np.searchsorted(row, np.arange(len(column) + 1))


def _fold(words: np.ndarray) -> int:
    out = len(words)
    for w in words.tolist():
        out = (out * 0x9FB21C651E98DF25 + w) & (2**64 - 1)
    return out


def signatures(h: np.ndarray, bounds: np.ndarray, n: int = BANDS * ROWS) -> np.ndarray:
    """MinHash values, one row of n for each set that is not empty."""
    full = np.flatnonzero(np.diff(bounds))
    out = np.empty((len(full), n), dtype=np.uint64)
    if len(full):
        starts = bounds[:-1][full]
        for k, a in enumerate(multipliers(n)):
            out[:, k] = np.minimum.reduceat(h * a, starts)
    return out


def _sign_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        h, bounds = shingle_sets(batch.column("text"))
        sizes = np.diff(bounds)
        full = np.flatnonzero(sizes)
        if not len(full):
            continue
        starts = bounds[:-1][full]
        s1, s2 = np.add.reduceat(h, starts), np.add.reduceat(mix(h), starts)
        sig = signatures(h, bounds)
        keys = np.zeros((len(full), BANDS), dtype=np.uint64)
        for r in range(ROWS):
            keys = keys * _U(0x9FB21C651E98DF25) + sig[:, r::ROWS]
        keys = mix(keys ^ (np.arange(BANDS, dtype=np.uint64) * _U(0xC2B2AE3D27D4EB4F)))
        yield pa.record_batch(
            [batch.column("doc_id").take(pa.array(full)), batch.column("th").take(pa.array(full)), pa.array(signed(s1)), pa.array(signed(s2)), pa.array(sizes[full], pa.int64()), as_list(signed(keys.ravel()), np.arange(len(full) + 1) * BANDS, pa.int64())],
            names=["doc_id", "th", "s1", "s2", "n", "bands"],
        )


@lru_cache(maxsize=8)
def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE, step: int = STEP, total: int = BANDS * ROWS) -> tuple[int, ...]:
    """For 1, 2, ... steps of compared values: the matches from which a pair stays.

    After m matches in n values the similarity has the Beta(m + 1, n - m + 1) posterior; its mass above
    the threshold is summed on a fine grid.
    """
    x = (np.arange(20000) + 0.5) / 20000
    lx, ly = np.log(x), np.log1p(-x)
    out = []
    for n in range(step, total + 1, step):
        m = 0
        while m < n:
            w = m * lx + (n - m) * ly
            w = np.exp(w - w.max())
            if w[x >= threshold].sum() / w.sum() >= tolerance:
                break
            m += 1
        out.append(m)
    return tuple(out)


def links_between(a: list[np.ndarray], b: list[np.ndarray] | None, threshold: float = THRESHOLD) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of similar sets between two lists, or within one (b is None, first index less)."""
    within = b is None
    pool = a if within else a + b
    sizes = np.array([len(s) for s in pool])
    flat, bounds = np.concatenate(pool), np.append(0, np.cumsum(sizes))
    sig = signatures(flat, bounds)
    m = len(a)
    left, right = sig[:m], sig if within else sig[m:]
    i, j = np.triu_indices(m, 1) if within else (x.ravel() for x in np.indices((m, len(pool) - m)))
    sa, sb = sizes[:m], sizes if within else sizes[m:]
    near = np.minimum(sa[i], sb[j]) >= threshold * np.maximum(sa[i], sb[j])
    i, j = i[near], j[near]
    count = np.zeros(len(i), dtype=np.int32)
    for k, least in enumerate(least_matches(threshold)):
        part = slice(k * STEP, (k + 1) * STEP)
        for at in range(0, len(i), 1 << 15):
            s = slice(at, at + (1 << 15))
            count[s] += (left[i[s], part] == right[j[s], part]).sum(1)
        stay = count >= least
        i, j, count = i[stay], j[stay], count[stay]
        if not len(i):
            return i, j
    # exact sizes of the intersections: shingles found in one set only play no part
    uniq, inverse, times = np.unique(flat, return_inverse=True, return_counts=True)
    shared = times > 1
    number = np.cumsum(shared) - 1
    owner = np.repeat(np.arange(len(pool)), sizes)
    use = shared[inverse]
    col, own = number[inverse[use]], owner[use]
    width = int(shared.sum())
    ga, gb = np.unique(i), np.unique(j)
    inter = np.zeros((len(ga), len(gb)), dtype=np.float32)
    place_a, place_b = np.full(len(pool), -1), np.full(len(pool), -1)
    place_a[ga] = np.arange(len(ga))
    place_b[gb if within else gb + m] = np.arange(len(gb))
    order = np.argsort(col, kind="stable")
    col, own = col[order], own[order]
    for at in range(0, width, 4096):
        lo, hi = np.searchsorted(col, (at, at + 4096))
        c, o = col[lo:hi] - at, own[lo:hi]
        x, y = np.zeros((len(ga), 4096), dtype=np.float32), np.zeros((len(gb), 4096), dtype=np.float32)
        pa_, pb_ = place_a[o], place_b[o]
        x[pa_[pa_ >= 0], c[pa_ >= 0]] = 1
        y[pb_[pb_ >= 0], c[pb_ >= 0]] = 1
        inter += x @ y.T
    both = inter[place_a[i], place_b[j if within else j + m]].astype(np.int64)
    good = both >= threshold * (sa[i] + sb[j] - both) - 1e-9
    return i[good], j[good]


def _verify(key: tuple[pa.Scalar, ...], part: pa.Table) -> pa.Table:
    """Links of one pair of blocks: (id, links, root) for every node that has any."""
    ids = part.column("id").to_numpy()
    block = part.column("block").to_numpy()
    sets = [np.frombuffer(s, dtype=np.uint64) for s in part.column("shingles").to_pylist()]
    order = np.lexsort((ids, block))
    ids, block, sets = ids[order], block[order], [sets[o] for o in order]
    cut = int((block == block[0]).sum()) if len(block) else 0
    if key[1].as_py() == key[2].as_py():
        i, j = links_between(sets, None) if len(sets) > 1 else (np.zeros(0, int), np.zeros(0, int))
    elif cut == len(sets):
        i = j = np.zeros(0, int)
    else:
        i, j = links_between(sets[:cut], sets[cut:])
        j = j + cut
    links = np.bincount(np.concatenate([i, j]).astype(int), minlength=len(ids))
    up = list(range(len(ids)))

    def root(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for x, y in zip(i.tolist(), j.tolist(), strict=True):
        rx, ry = root(x), root(y)
        if rx != ry:
            up[max(rx, ry)] = min(rx, ry)
    some = np.flatnonzero(links)
    return pa.table({"id": ids[some], "links": links[some].astype(np.int64), "root": ids[np.array([root(x) for x in some.tolist()], dtype=np.int64)] if len(some) else np.zeros(0, np.int64)}).cast(_LINKS)


_LINKS = pa.schema([("id", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])


def _set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        h, bounds = shingle_sets(batch.column("text"))
        sets = [h[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        yield pa.record_batch([batch.column(c) for c in ("id", "component", "blocks")] + [pa.array(sets, pa.binary())], names=["id", "component", "blocks", "shingles"])


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, class_id, n_links: the class of each document, and how many other texts it is similar to.

    class_id is the least doc_id that links lead to, through texts alike or similar; n_links counts the
    different shingle sets with similarity of at least 0.8, so copies of one text add no links.  Texts without
    words (null, empty) are alike to nothing: own class, no links.  Repeated rows repeat; rows of one doc_id
    are one document.  Rows without doc_id have class null and no links.
    """
    texts = id_text(docs).select("doc_id", F.xxhash64("text").alias("th"), "text")
    signs = checkpoint(texts.where("doc_id is not null").mapInArrow(_sign_rows, "doc_id long, th long, s1 long, s2 long, n long, bands array<long>"))
    nodes = checkpoint(signs.groupBy("s1", "s2", "n").agg(F.min(F.struct("doc_id", "th")).alias("first"), F.first("bands").alias("bands")).select("s1", "s2", "n", F.col("first.doc_id").alias("id"), F.col("first.th").alias("th"), "bands"))
    banded = nodes.select("id", F.explode("bands").alias("band"))
    leaders = banded.groupBy("band").agg(F.min("id").alias("lead"), F.count("*").alias("m")).where("m > 1").select("band", "lead")
    ties = banded.join(leaders, "band").where("id <> lead").select("id", "lead").distinct()
    groups = components(ties, "id", "lead")
    counts = groups.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    members = groups.join(counts, "component").join(nodes.select("id", "th"), "id")
    payload = texts.join(members, (texts.doc_id == members.id) & (texts.th == members.th)).select("id", "component", "blocks", "text").dropDuplicates(["id"]).mapInArrow(_set_rows, "id long, component long, blocks int, shingles binary")
    placed = payload.withColumn("block", F.pmod(F.xxhash64("id", F.lit(11)), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    paired = placed.select("id", "component", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "shingles")
    found = checkpoint(paired.groupBy("component", "low", "high").applyInArrow(_verify, "id long, links long, root long"))
    degree = found.groupBy("id").agg(F.sum("links").alias("links"))
    same = components(found.select("id", "root"), "id", "root")
    named = nodes.select("id", "s1", "s2", "n").join(degree, "id", "left").join(same, "id", "left")
    own = signs.select("doc_id", "th", "s1", "s2", "n").distinct().join(named, ["s1", "s2", "n"]).select("doc_id", "th", F.coalesce("component", "id").alias("class_id"), F.coalesce("links", F.lit(0)).alias("n_links"))
    keys = id_text(docs).select("doc_id", F.xxhash64("text").alias("th"))
    return keys.join(own, ["doc_id", "th"], "left").select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of docs that stand for their class: the least doc_id of each; rows without id stay."""
    kept = classes(docs).where("doc_id = class_id").select("doc_id").distinct()
    return docs.where("doc_id is null").unionByName(docs.join(kept, "doc_id", "left_semi").select(docs.columns))
