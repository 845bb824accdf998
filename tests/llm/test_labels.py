import itertools
import random
import re
from collections import Counter

import numpy as np
import plain
import pytest

from starloom.llm import line_crf, pu_quality, toxic_grammar
from starloom.llm.text_stats import DOC_FEATURES, LINE_FEATURES, base_counts, doc_features, line_features

SCHEMA = "doc_id long, text string, score string, kept string"
LABELS = "doc_id long, quality int, toxic int, text string"


def plain_counts(text):
    ws = plain.WORDS(text)
    grams = Counter(tuple(ws[i : i + 5]) for i in range(len(ws) - 4))
    inside = {i + k for i in range(len(ws) - 4) if grams[tuple(ws[i : i + 5])] > 1 for k in range(5)}
    lines = text.split("\n")
    dup = sum(1 for i, x in enumerate(lines) if plain.WORDS(x) and x in lines[:i])
    return ws, sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(inside)


@pytest.mark.parametrize("seed", range(6))
def test_base_counts_match_the_plain_rule(seed):
    rnd = random.Random(seed)
    for _ in range(60):
        vocab = [rnd.choice(["a", "bb", "ccc", "é", "#x", "|", "<b>", " ", " z"]) + str(rnd.randrange(3)) for _ in range(rnd.randint(1, 9))]
        text = "".join(rnd.choice(vocab) + rnd.choice([" ", " ", "\n", "\t", "\n\n", "\v"]) for _ in range(rnd.randint(0, 120)))
        assert base_counts(text) == plain_counts(text)
    many = " ".join(f"w{i % 7000}" for i in range(15000))
    assert base_counts(many)[4] == 15000


def test_features_stay_in_range():
    for text in ("", " ", "a", "A!! B!!", "###", "x | y | z", "1 2 3", "a " * 1000, "\n" * 50, "é" * 5000):
        assert len(doc_features(text)) == len(DOC_FEATURES) and all(0 <= v <= 1 for v in doc_features(text))
        assert len(line_features(text, False)) == len(LINE_FEATURES) and all(0 <= v <= 1 for v in line_features(text, True))


def test_viterbi_finds_the_best_path_of_all():
    rng = np.random.default_rng(1)
    for n in (1, 2, 5, 8):
        field = line_crf.LineField(rng.normal(size=(3, 2)), rng.normal(size=(2, 2)), rng.normal(size=2))
        emit = rng.normal(size=(n, 2))
        score = lambda p: field.start[p[0]] + sum(emit[i, v] for i, v in enumerate(p)) + sum(field.moves[a, b] for a, b in itertools.pairwise(p))  # noqa: E731, B023
        assert tuple(line_crf.viterbi(field, emit)) == max(itertools.product((0, 1), repeat=n), key=score)
    assert len(line_crf.viterbi(field, np.zeros((0, 2)))) == 0


def corpus(n=600):
    rnd = random.Random(4)
    texts, labels = {}, []
    for i in range(n):
        ws = [f"w{int(3000 * rnd.random() ** 2)}" for _ in range(rnd.randint(20, 120))]
        lines = [" ".join(ws[k : k + 12]) + "." for k in range(0, len(ws), 12)]
        bad, toxic = rnd.random() < 0.25, rnd.random() < 0.2
        if bad:
            lines = [" ".join(w.upper() + "!!" for w in x.split()) if i % 2 else " ".join(w + "$$$" for w in x.split()) for x in lines]
        if toxic:
            lines[0] += " you absolute " + rnd.choice(["blorbish", "blorbian", "snarfed"]) + " one"
        texts[i] = "\n".join(lines)
        labels.append((i, int(not bad), int(toxic), "clash"))
    return texts, labels


@pytest.fixture(scope="module")
def frames(spark):
    texts, labels = corpus()
    rows = [(i, t, "s", "k") for i, t in texts.items()] + [(9000, None, "s", "k"), (9001, "", "s", "k"), (None, "a b", "s", "k"), (0, texts[0], "s", "k")]
    return spark.createDataFrame(rows, SCHEMA).repartition(3), spark.createDataFrame(labels + labels[:5], LABELS), labels


def test_line_verdicts_follow_the_labels(spark, frames):
    docs, labels, known = frames
    out = line_crf.verdicts(line_crf.label_lines(docs, line_crf.train(docs, labels, 200))).collect()
    assert len(out) == docs.count()
    got = {r.doc_id: r for r in out}
    assert not got[9000].kept and got[9000].base_failed and got[9001].n_words == 0
    assert np.mean([got[i].kept == bool(q) for i, q, _, _ in known]) > 0.97
    assert all(not (r.kept and r.base_failed) for r in out)
    empty = spark.createDataFrame([], SCHEMA)
    assert line_crf.label_lines(empty, line_crf.train(empty, spark.createDataFrame([], LABELS))).count() == 0


def test_boilerplate_lines_inside_good_texts_are_found(spark):
    rnd = random.Random(8)
    content = lambda: " ".join(f"w{rnd.randrange(3000)}" for _ in range(rnd.randint(9, 14))).capitalize() + "."
    junk = lambda: rnd.choice([lambda: " | ".join(f"M{rnd.randrange(40)}" for _ in range(6)), lambda: " ".join(f"BUY{rnd.randrange(40)}!!" for _ in range(7))])()
    rows, labels, truth = [], [], {}
    for i in range(400):
        good = rnd.random() < 0.6
        n = rnd.randint(4, 12)
        kinds = [1 if good else 0] * n
        for k in rnd.sample(range(n), n // 4):  # a quarter of the lines is of the other kind
            kinds[k] = 1 - kinds[k]
        rows.append((i, "\n".join(content() if k else junk() for k in kinds), "s", "k"))
        labels.append((i, int(good), 0, "clash"))
        truth[i] = kinds
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    out = line_crf.label_lines(docs, line_crf.train(docs, spark.createDataFrame(labels, LABELS), 200)).collect()
    agree = [a == b for r in out for a, b in zip(r.labels, truth[r.doc_id], strict=True)]
    assert np.mean(agree) > 0.97 and sum(len(set(r.labels)) == 2 for r in out) > 350
    assert np.mean([(r.content_share >= 0.5) == bool(labels[r.doc_id][1]) for r in out]) > 0.97


def test_hidden_labels_keep_to_the_text():
    odds, sizes = np.array([2.0, -1.0, -3.0, -0.5]), np.array([5.0, 5.0, 5.0, 5.0])
    assert line_crf.hidden_labels(odds, sizes, 1).tolist() == [1, 0, 0, 1]
    assert line_crf.hidden_labels(-odds, sizes, 0).tolist() == [0, 1, 1, 0]
    assert line_crf.hidden_labels(np.array([1.0, 1.0, -1.0]), np.array([5.0, 5.0, 1.0]), 1).tolist() == [1, 1, 0]


def test_the_prior_is_estimated_without_negatives():
    rng = np.random.default_rng(2)
    k = len(DOC_FEATURES)
    make = lambda n, level: np.hstack([np.ones((n, 1)), np.clip(level + 0.05 * rng.standard_normal((n, k - 1)), 0, 1)])
    for share in (0.3, 0.6, 0.9):
        n = 4000
        unlabelled = np.concatenate([make(int(share * n), 0.3), make(n - int(share * n), 0.7)])
        assert abs(pu_quality.estimate_prior(make(2000, 0.3), unlabelled) - share) < 0.05
    assert pu_quality.estimate_prior(np.zeros((0, k)), unlabelled) == 0.5


def test_quality_on_the_held_out_fold(spark, frames):
    docs, labels, known = frames
    model = pu_quality.train(docs, labels, 300, 600)
    got = {r.doc_id: r for r in pu_quality.score(docs, model).collect()}
    held = [(i, q) for i, q, _, _ in known if got[i].held_out]
    assert 60 < len(held) < 250
    assert np.mean([got[i].predicted == q for i, q in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got.values()) and got[9001].score == got[9000].score
    swapped = labels.withColumn("quality", pu_quality.F.when(pu_quality.crc_fold("doc_id", 4) == 2, 0).otherwise(pu_quality.F.col("quality")))
    assert np.array_equal(pu_quality.train(docs, swapped, 300, 600).weights, model.weights)  # held-out labels are not read
    empty = spark.createDataFrame([], SCHEMA)
    assert pu_quality.score(empty, pu_quality.train(empty, spark.createDataFrame([], LABELS))).count() == 0


def test_toxicity_on_the_held_out_fold(spark, frames):
    docs, labels, known = frames
    model = toxic_grammar.train(docs, labels, 300)
    got = {r.doc_id: r for r in toxic_grammar.score(docs, model).collect()}
    held = [(i, t) for i, _, t, _ in known if got[i].held_out]
    assert np.mean([got[i].predicted == t for i, t in held]) > 0.97
    assert got[9000].score == got[9001].score and got[9000].predicted == 0
    assert toxic_grammar.without_toxic(docs, model).count() == sum(1 - got[r.doc_id].predicted for r in docs.collect() if r.doc_id is not None) + 1
    empty = spark.createDataFrame([], SCHEMA)
    assert toxic_grammar.score(empty, toxic_grammar.train(empty, spark.createDataFrame([], LABELS))).count() == 0


def test_grammar_weighs_clauses():
    lex = toxic_grammar.Lexicon({"idiot": 4.0}, {"blor": 4.0})
    score = lambda t: toxic_grammar.clause_score(t.split(), lex)
    assert score("you idiot") > score("an idiot") > score("he said idiot") > score("not an idiot") > 0
    assert score("nothing here") == 0 and score("i will kill you") > 0 and score("time to kill") == 0
    own = toxic_grammar.Finder(lex)
    assert own.scores("Fine words. A BLORBISH thing; midiot. \n idiot! idiots") == [score("a blorbish thing"), score("idiot")]
    assert score("you i will kill") >= score("i will kill you") > score("not kill you") > 0 and len(toxic_grammar.GRAMMAR.arcs) == 3 * 4 * 7 * 5
    both = toxic_grammar.compose(toxic_grammar.context(4, 2, 0.5, 0.0), toxic_grammar.context(3, 1, 1.0, 2.0))
    assert len(both.arcs) == 6


def test_composed_grammar_is_the_five_machines_side_by_side():
    rnd = random.Random(11)
    machines = [toxic_grammar.insults(), toxic_grammar.threats(), toxic_grammar.context(toxic_grammar.NEGATION, 3, 0.3, 0.0), toxic_grammar.context(toxic_grammar.REPORT, 6, 0.6, 0.0), toxic_grammar.context(toxic_grammar.TARGET, 4, 1.0, 0.5)]
    assert len(toxic_grammar.GRAMMAR.arcs) == 1 * 3 * 4 * 7 * 5
    for _ in range(300):
        at, whole = [0] * 5, 0
        for c in [rnd.randrange(6) for _ in range(rnd.randint(1, 25))]:
            hits, factor, bonus = 0, 1.0, 0.0
            for k, m in enumerate(machines):
                at[k], h, f, b = m.arcs[at[k]][c]
                hits, factor, bonus = hits + h, factor * f, bonus + b
            whole, *got = toxic_grammar.GRAMMAR.arcs[whole][c]
            assert got == pytest.approx([hits, factor, bonus])


def test_what_copies_share_is_no_insult(spark):
    rnd = random.Random(2)
    line = lambda: " ".join(f"w{rnd.randrange(4000)}" for _ in range(12))
    copied = line() + " oddword"
    rows = [(i, f"{line()}. you {rnd.choice(['blorbish', 'blorbface'])} {line()}. {copied}.", 1) for i in range(60)] + [(i, line() + ". " + line(), 0) for i in range(60, 300)]
    sample = spark.createDataFrame([(i, t, y) for i, t, y in rows], "doc_id long, text string, y int")
    lexicon = toxic_grammar.lexicon_from(sample)
    assert "blorb" in lexicon.stems and "blorbish" in lexicon.whole
    assert "oddword" not in lexicon.whole and not any(w in lexicon.whole for w in copied.split())


def test_every_labelled_text_is_learned_from(spark):
    rnd = random.Random(6)
    words = lambda n: " ".join(f"w{rnd.randrange(900)}" for _ in range(n))
    order = [r.id for r in spark.range(8800).orderBy(toxic_grammar.F.xxhash64("id"), "id").collect()]
    toxic = [i for i in order if i % 2]
    late = set(toxic[4000:])  # beyond any first 4,000 of the kind
    assert len(late) == 400 and len(order) - len(toxic) == 4400
    docs = spark.createDataFrame([(i, f"{words(3)}. you {'blorbish' if i in late else 'snarfed'} {words(2)}." if i % 2 else words(5)) for i in order], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in order], "doc_id long, toxic int")
    model = toxic_grammar.train(docs, labels, folds=None)
    assert {"blorbish", "snarfed"} <= model.lexicon.whole.keys()
    got = {r.doc_id: r.predicted for r in toxic_grammar.score(docs, model).collect()}
    assert got == {i: i % 2 for i in order}


def test_the_fit_over_rows_is_that_of_plain_newton_steps(spark):
    rng = np.random.default_rng(5)
    y, best, total = rng.integers(0, 2, 500), rng.random(500), rng.random(500) * 3
    total += y
    frame = spark.createDataFrame([(int(a), float(b), float(c), 1.0 + i % 3) for i, (a, b, c) in enumerate(zip(y, best, total, strict=True))], "y int, best double, total double, n double")
    n, x, w = 1.0 + np.arange(500) % 3, np.stack([np.ones(500), best, total], axis=1), np.array([-2.0, 1.0, 1.0])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (n * p * (1 - p))[:, None]).T @ x / n.sum() + 1e-3 * np.eye(3)
        w = w - np.linalg.solve(h, x.T @ (n * (p - y)) / n.sum() + 1e-3 * (w - np.array([-2.0, 1.0, 1.0])))
    got = toxic_grammar.fit(frame.repartition(3))
    assert got == pytest.approx(w, abs=1e-9) and np.array_equal(got, toxic_grammar.fit(frame.repartition(7)))
    assert toxic_grammar.fit(frame.where("y = 1")) is None
