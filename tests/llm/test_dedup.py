import hashlib
import random
from collections import Counter

import numpy as np
import plain
import pyarrow as pa
import pytest

from starloom.llm import common, line_dedup, repeats

SCHEMA = "doc_id long, text string, lang string, kept string"


def texts_for(seed: int, n: int = 60) -> dict[int, str | None]:
    """Random texts with shared passages, edited and copied lines, nulls and empty texts."""
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(40)]
    line = lambda k: " ".join(rnd.choice(vocab) for _ in range(k))
    pool = [line(rnd.choice([3, 8, 9, 20, 40])) for _ in range(25)]
    out: dict[int, str | None] = {}
    for i in range(n):
        parts = []
        for _ in range(rnd.randint(0, 6)):
            ws = rnd.choice(pool).split() if rnd.random() < 0.7 else line(rnd.randint(1, 30)).split()
            if rnd.random() < 0.5 and ws:
                at = rnd.randrange(len(ws))
                ws = rnd.choice([ws[:at] + ws[at + 1 :], ws[:at] + ["new"] + ws[at:], ws[:at] + ["sub"] + ws[at + 1 :]])
            parts.append(rnd.choice(["", "  "]) + rnd.choice([" ", "  ", "\t"]).join(ws))
        out[i * 3] = "\n".join(parts)
    out[1], out[2], out[4] = None, "", " \n \n"
    out[500] = " ".join(vocab * 300)
    out[501] = out[500] + " tail " + (out[3] or "")
    return out


def frame(spark, texts, parts: int = 3):
    return spark.createDataFrame([(i, t, "en", "x") for i, t in texts.items()], SCHEMA).repartition(parts)


@pytest.mark.parametrize("seed", [1, 2])
def test_repeats_match_the_plain_rule(spark, seed):
    texts = texts_for(seed)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in repeats.digests(repeats.without_repeats(frame(spark, texts))).collect()}
    assert got == plain.repeats(texts)


def test_repeats_of_repeated_rows_and_empty_table(spark):
    words = " ".join(f"a{i}" for i in range(30))
    rows = [(1, words, "en", "x")] * 2 + [(2, words + " z", "en", "x"), (None, words, "en", "x")]
    got = repeats.without_repeats(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.doc_id or 0, r.n_removed) for r in got) == [(0, 0), (1, 0), (1, 0), (2, 30)]
    assert repeats.without_repeats(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("size", [300, 3000])
def test_repeats_over_many_slices_of_a_task(monkeypatch, size):
    monkeypatch.setattr(repeats, "JOIN_SLICE", size)
    texts = {i: t or "" for i, t in texts_for(5).items()}
    ids = list(texts)
    random.Random(5).shuffle(ids)
    batch = lambda extra: pa.record_batch([pa.array(ids, pa.int64()), pa.array([0] * len(ids), pa.int32()), *extra, pa.array([texts[i] for i in ids])], names=["doc_id", "th", *["seeds"] * len(extra), "text"])
    seeds, shared = [r for b in repeats._seed_rows(iter([batch([])])) for r in b.to_pylist()], {i: set() for i in ids}
    times = Counter(r["seed"] for r in seeds if r["known"] is None)
    for r in seeds:
        if r["known"] is not None:
            shared[r["doc_id"]] |= set(r["known"])
        elif times[r["seed"]] > 1 and r["doc_id"] is not None:
            shared[r["doc_id"]].add(r["seed"])
    rows = [r for b in repeats._window_rows(iter([batch([pa.array([list(shared[i]) for i in ids], pa.list_(pa.int64()))])])) for r in b.to_pylist()]
    each = [(r["seed"], w, r["doc_id"], r["at"] + k) for r in rows if r["known"] is None for k, w in enumerate(r["wins"])]
    least: dict[tuple[int, int], int] = {}
    for s, w, d, _ in each:
        least[s, w] = min(d, least.get((s, w), d))
    starts = {i: set() for i in ids}
    for s, w, d, a in each:
        if least[s, w] < d:
            starts[d].add(a)
    for r in rows:
        starts[r["doc_id"]] |= set(r["known"] or [])
    got = {i: sum(b - a for a, b in repeats.spans_of(np.array(sorted(x)))) for i, x in starts.items()}
    assert got == {i: n for i, (_, n, _) in plain.repeats(texts).items()}


@pytest.mark.parametrize("seed", [3, 4])
def test_line_dedup_matches_the_plain_rule(spark, seed):
    texts = texts_for(seed)
    got = {r.doc_id: (r.text or "", r.lang, r.kept) for r in line_dedup.without_repeated_lines(frame(spark, texts)).collect()}
    want = plain.line_dedup(texts)
    assert got == {i: (t, "en", "x") for i, t in want.items()}


def test_line_dedup_edges(spark):
    assert line_dedup.without_repeated_lines(spark.createDataFrame([], SCHEMA)).count() == 0
    long = " ".join(f"a{i}" for i in range(12))
    rows = [(5, long, "en", "x"), (5, long, "en", "x"), (6, long + " b", "en", "x"), (None, long, "en", "x"), (7, None, "en", "x")]
    got = sorted(((r.doc_id or 0, r.text, r.n_removed) for r in line_dedup.without_repeated_lines(spark.createDataFrame(rows, SCHEMA)).collect()), key=str)
    assert got == [(0, long, 0), (5, long, 0), (5, long, 0), (6, "", 1), (7, None, 0)]
    d = line_dedup.digests(line_dedup.without_repeated_lines(spark.createDataFrame(rows[2:3], SCHEMA))).first()
    assert d.kept_sha256 == hashlib.sha256((long + " b").encode()).hexdigest()


def thue_morse(n: int) -> tuple[str, str]:
    """Two different strings of n letters whose sums over powers agree modulo 2^64, whatever the odd base."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


@pytest.mark.parametrize("size", [512, 1024, 4096])
def test_words_of_cancelling_patterns_stay_apart(spark, size):
    x, y = thue_morse(size)
    start = " ".join(f"p{i}" for i in range(12))
    texts = {1: f"{start} {x}", 2: f"{start} {y}", 3: f"{start} {x}", 4: f"{x}\n{y}", 5: y}
    df = frame(spark, texts)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in repeats.digests(repeats.without_repeats(df)).collect()}
    assert got == plain.repeats(texts) and [got[i][1] for i in (1, 2, 3)] == [0, 0, 13]
    assert {r.doc_id: r.text for r in line_dedup.cleaned_texts(df).collect()} == plain.line_dedup(texts)


def test_lines_of_cancelling_patterns_of_words_stay_apart(spark):
    x, y = (" ".join("left" if c == "a" else "right" for c in w) for w in thue_morse(2048))
    texts = {1: x, 2: y, 3: x + " more", 4: y.replace("left", "other", 1)}
    df = frame(spark, texts)
    assert {r.doc_id: r.text for r in line_dedup.cleaned_texts(df).collect()} == plain.line_dedup(texts) == {1: x, 2: y, 3: "", 4: ""}
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in repeats.digests(repeats.without_repeats(df)).collect()}
    assert got == plain.repeats(texts)


def test_word_hashes_see_every_byte_and_the_length():
    rnd = random.Random(4)
    words = {"".join(rnd.choice("aé\x00") for _ in range(rnd.choice([1, 2, 7, 8, 9, 16, 17, 40, 600]))) for _ in range(4000)}
    words = [w for w in words if w]
    found = common.split_words(pa.array(words))
    assert len(found.hash) == len(words) == len(set(found.hash.tolist())) == len(set(found.other_hash().tolist()))
    assert not set(found.hash.tolist()) & set(found.other_hash().tolist())
    again = common.split_words(pa.array([" ".join(words)]))
    assert np.array_equal(again.hash, found.hash) and np.array_equal(again.other_hash(), found.other_hash())


def test_texts_of_one_doc_id_and_clashing_columns(spark):
    line = " ".join(f"w{i}" for i in range(9))
    rows = [(1, line, 5, "x", 90), (1, "head\nother " + line, 6, "y", 91), (2, f"{line}\nnew", 7, "z", 92), (3, line, 8, "z", 93), (None, line, 9, None, 94), (4, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_removed long, rest string, n_chars long")
    got = sorted(map(tuple, line_dedup.with_repeats_gone(docs).collect()), key=repr)
    assert line_dedup.with_repeats_gone(docs).columns == docs.columns
    assert got == sorted([(1, line, 5, "x", 90), (1, "head", 6, "y", 4), (2, "new", 7, "z", 3), (None, line, 9, None, 94), (4, None, None, None, None)], key=repr)
