import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from starloom.llm import importance

SCHEMA = "doc_id long, text string, score string, rank long"
FIND = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+").findall


def words_of(text: str | None) -> list[str]:
    return FIND("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def buckets_of(text: str | None) -> list[int]:
    ws = words_of(text)
    return [zlib.crc32(f.encode()) % 10_000 for f in ws + [f"{a} {b}" for a, b in zip(ws, ws[1:])]]


def plain_resample(docs: list[tuple], target: list[str | None]) -> list[tuple]:
    s, t = [0] * 10_000, [0] * 10_000
    for _, text, *_ in docs:
        for b in buckets_of(text):
            s[b] += 1
    for text in target:
        for b in buckets_of(text):
            t[b] += 1
    gain = [math.floor(1000 * math.log((y + 1) * (sum(s) + 10_000) / ((x + 1) * (sum(t) + 10_000)))) for x, y in zip(s, t)]
    rows, n = [], 0
    for i, text, *_ in docs:
        f = buckets_of(text)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([i, len(f), weight, score, len(words_of(text)) >= 20])
        n += rows[-1][4]
    order = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    rank = {id(r): k for k, r in enumerate(order[: 25 * n // 100], 1)}
    return sorted(((*r[:4], rank.get(id(r))) for r in rows), key=repr)


def texts_for(seed: int) -> list[tuple]:
    rnd = random.Random(seed)
    vocab = ["Über", "naïve", "the", "THE", "a1", "x" * 70, "日本語", "ÀB", "z\x7fz", "q_r", "é" * 40]
    rows = [(i, rnd.choice(["", " ", "\n"]).join(rnd.choice(vocab) + rnd.choice([" ", ".", "-", "\t", ""]) for _ in range(rnd.randint(0, 60))), "s", 1) for i in range(150)]
    rows += [(1000 + i % 3, "same words again and again " * 6, "s", 1) for i in range(40)]
    return rows + [(None, "no id " * 20, "s", 1), (2000, None, "s", 1), (2001, "", "s", 1), (2002, "...", "s", 1), (2003, "wörd " * 30_000, "s", 1)]


@pytest.mark.parametrize("seed", [1, 2])
def test_resampling_matches_the_plain_rule(spark, monkeypatch, seed):
    monkeypatch.setattr(importance, "slices", lambda b, f=importance.slices: f(b, limit=500))
    rows, target = texts_for(seed), ["the naïve THE a1 über", None, "x" * 70 + " " + "é" * 40]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = importance.resample(docs, spark.createDataFrame([(t,) for t in target], "text string"))
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, got.collect()), key=repr) == plain_resample(rows, target)


def test_buckets_of_long_and_touching_words():
    texts = ["ab", "cd ef", "", "y" * 64 + " " + "z" * 65 + " " + "w" * 1000, "end", "Start " * 3, "é", "1é2"]
    f = importance.features(pa.array(texts))
    for i, text in enumerate(texts):
        assert sorted(f.bucket[f.row == i]) == sorted(buckets_of(text))
    assert list(f.n_words) == [len(words_of(t)) for t in texts]
    some = importance.features(pa.array(["skipped", *texts]).slice(1))
    assert np.array_equal(some.bucket, f.bucket) and np.array_equal(some.row, f.row)


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert importance.resample(none, none).count() == 0
    assert importance.resample(spark.createDataFrame([(1, "a b", "s", 1)], SCHEMA), none).collect()[0].rank is None
