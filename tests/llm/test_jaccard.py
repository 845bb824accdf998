import random

import numpy as np
import plain
import pytest

from starloom.llm import jaccard_join
from starloom.llm.common import mix
from starloom.llm.components import components

SCHEMA = "doc_id long, text string, class_id string"


def near_copies(seed: int) -> dict[int, str | None]:
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(3000)]
    out: dict[int, str | None] = {1: None, 2: "", 3: "a b", 4: "a b", 5: "a b c", 6: " \n"}
    i = 10
    for _ in range(8):
        base = [rnd.choice(vocab) for _ in range(rnd.choice([6, 40, 120]))]
        for _ in range(rnd.choice([1, 2, 12])):
            ws = list(base)
            for _ in range(rnd.choice([0, 0, 1, 1, 2, 3])):
                ws[rnd.randrange(len(ws))] = rnd.choice(vocab)
            out[i] = " ".join(ws)
            i += 7
    return out


@pytest.mark.parametrize("block", [256, 3])
def test_classes_match_all_pairs(spark, block, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    texts = near_copies(block)
    df = spark.createDataFrame([(i, t, "x") for i, t in texts.items()], SCHEMA).repartition(3)
    got = {r.doc_id: (r.class_id, r.n_links) for r in jaccard_join.classes(df).collect()}
    assert got == plain.jaccard_classes(texts)


def test_edges(spark):
    assert jaccard_join.classes(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(1, "a b c d e f", "x")] * 2 + [(None, "a b c d e f", "x"), (2, "a b c d e f", "x")]
    df = spark.createDataFrame(rows, SCHEMA)
    assert sorted((r.doc_id or 0, r.class_id or 0, r.n_links) for r in jaccard_join.classes(df).collect()) == [(0, 0, 0), (1, 1, 0), (1, 1, 0), (2, 1, 0)]
    assert sorted(r.doc_id or 0 for r in jaccard_join.one_of_each(df).collect()) == [0, 1, 1]


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)]
    got = {r.id: r.component for r in components(spark.createDataFrame(path, "a long, b long"), "a", "b").collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 140)}}


def test_stars_take_no_round(spark, monkeypatch):
    from starloom.llm import components as module

    rounds = []
    real = module._star
    monkeypatch.setattr(module, "_star", lambda edges, large: rounds.append(large) or real(edges, large))
    frame = lambda pairs: spark.createDataFrame(pairs, "a long, b long")
    got = {r.id: r.component for r in components(frame([(1, 5), (6, 1), (6, 1), (7, 7), (9, 2)]), "a", "b").collect()}
    assert got == {1: 1, 5: 1, 6: 1, 2: 2, 9: 2} and not rounds
    assert components(frame([]), "a", "b").count() == 0 and not rounds
    for pairs in ([(1, 2), (2, 3)], [(1, 3), (2, 3)]):  # a vertex that is both ends, and one with two lesser neighbours
        assert {r.id: r.component for r in components(frame(pairs), "a", "b").collect()} == {1: 1, 2: 1, 3: 1}
    assert rounds == [True, False] * 2
    with pytest.raises(RuntimeError):
        components(frame([(i, i + 1) for i in range(40)]), "a", "b", rounds=1)


def test_pruning_keeps_what_may_reach_the_threshold():
    least = jaccard_join.least_matches()
    assert list(least) == sorted(least) and least[-1] < 0.8 * 280
    rng = np.random.default_rng(1)
    sets = [np.unique(mix(rng.integers(1, 400, 300, dtype=np.uint64))) for _ in range(30)]  # hashes, as shingles are
    i, j = jaccard_join.links_between(sets, None, 0.3)
    want = {(a, b) for a in range(30) for b in range(a + 1, 30) if len(np.intersect1d(sets[a], sets[b])) >= 0.3 * len(np.union1d(sets[a], sets[b]))}
    assert set(zip(i.tolist(), j.tolist(), strict=True)) == want
