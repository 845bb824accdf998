"""Toxicity by a weighted finite-state grammar over clauses.

A lexicon turns the words of a clause into classes (insult, threat, target, negation,
report, other), which five transducers read: one lets insults out as hits, one threats that have a target before
or after them in the clause, and three rewrite the weights of hits: a negation close before
takes most of it, a reporting verb some of it, and a target near it adds to
it.  The five are composed into one machine before use, and a clause's score is the weight of its
path.  A text's score is a logistic function of its best clause and of the sum over its clauses.

Insult stems are learned from all labelled texts: word beginnings and whole words that stand in
toxic texts far more often than chance allows.  Texts are not dealt to their labels: the distinct words of
each, the clauses of what may be an entry and the scores are, by doc_id.  The logistic is fitted by Newton steps
whose sums are made on Spark.  Threats, targets, negations and reporting verbs are short fixed lists.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import WORD, checkpoint, crc_fold, first_of_each, id_text, labelled, slices

#: A task counts features together until it holds so many, and then passes them on.
COUNTED = 200_000
FOLDS, HELD = 5, 0
MIN_STEM, MAX_STEM = 4, 7
#: An entry's toxic texts must be that unlikely at the base rate, and hold it in so many different clauses.
CHANCE, MIN_CLAUSES = 1e-4, 4
OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)
#: Closed word classes.
THREATS = "kill hurt beat shoot stab strangle destroy töten schlagen umbringen tuer frapper matar golpear".split()
TARGETS = "you your you're yourself he she him her they them du dich dir ihr euch tu toi te vous usted tú".split()
NEGATIONS = "not never no isn't aren't wasn't don't doesn't nobody nicht kein keine nie pas jamais aucun nunca ningún".split()
REPORTS = "said says say called calls wrote writes quoted quotes claimed reported alleged sagte schrieb nannte dit écrit disait dijo escribió llamó".split()

_clause = re.compile(r"[^.!?;:\n]+")
_word = re.compile(WORD)
_strip = ".,!?;:\"'()[]“”„«»¿¡*#$%&|"


@dataclass(frozen=True)
class Transducer:
    """States 0..n-1, all final; arcs[state][class] = (state after, hits let out, factor and bonus of hits)."""

    arcs: tuple[tuple[tuple[int, int, float, float], ...], ...]


def _machine(states: int, arc: Callable[[int, int], tuple[int, int, float, float]]) -> Transducer:
    return Transducer(tuple(tuple(arc(s, c) for c in range(6)) for s in range(states)))


def insults() -> Transducer:
    """An insult is a hit wherever it stands."""
    return _machine(1, lambda s, c: (0, int(c == INSULT), 1.0, 0.0))


def threats() -> Transducer:
    """States: nothing yet, a threat without a target, a target.  A threat is a hit once it has a target."""
    step = {(0, THREAT): (1, 0), (0, TARGET): (2, 0), (1, TARGET): (2, 1), (2, THREAT): (2, 1)}
    return _machine(3, lambda s, c: (*step.get((s, c), (s, 0)), 1.0, 0.0))


def context(opener: int, reach: int, factor: float, bonus: float) -> Transducer:
    """After an opener, hits at the next ``reach`` words are scaled by factor and raised by bonus."""
    return _machine(reach + 1, lambda left, c: (reach if c == opener else max(0, left - 1), 0, factor if left else 1.0, bonus if left else 0.0))


def compose(a: Transducer, b: Transducer) -> Transducer:
    """The machine that runs both over the same classes, with the hits and effects of both."""
    m = len(b.arcs)
    return Transducer(tuple(tuple((x * m + y, h + k, f * g, p + q) for (x, h, f, p), (y, k, g, q) in zip(ra, rb, strict=True)) for ra in a.arcs for rb in b.arcs))


GRAMMAR = reduce(compose, (insults(), threats(), context(NEGATION, 3, 0.3, 0.0), context(REPORT, 6, 0.6, 0.0), context(TARGET, 4, 1.0, 0.5)))


@dataclass(frozen=True)
class Lexicon:
    """Weights of whole words and of word beginnings."""

    whole: dict[str, float]
    stems: dict[str, float]


@dataclass(frozen=True)
class ToxicModel:
    lexicon: Lexicon
    bias: float
    best: float
    total: float


_FIXED = {w: c for c, ws in ((THREAT, THREATS), (TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS)) for w in ws}


def classify(word: str, lexicon: Lexicon) -> tuple[int, float]:
    """The lexicon transducer: class and weight of one lower-case word."""
    w = word.strip(_strip)
    weight = lexicon.whole.get(w, 0.0)
    for k in range(MIN_STEM, min(MAX_STEM, len(w)) + 1):
        weight = max(weight, lexicon.stems.get(w[:k], 0.0))
    if weight:
        return INSULT, weight
    c = _FIXED.get(w, OTHER)
    return c, (1.0 if c == THREAT else 0.0)


def clause_score(words: list[str], lexicon: Lexicon) -> float:
    """Weight of a clause's path: its hits add up, an insult with its word's weight and a threat with 1."""
    state, total = 0, 0.0
    for word in words:
        c, weight = classify(word, lexicon)
        state, hits, factor, bonus = GRAMMAR.arcs[state][c]
        if hits:
            weight = weight if c == INSULT else 1.0
            total += max(0.0, factor * weight + min(bonus, weight / 4))
    return total


def _automaton(words: set[str]):
    """Finds any of the words in a text, and their lengths."""
    import ahocorasick

    machine = ahocorasick.Automaton()
    for w in words:
        machine.add_word(w, len(w))
    if len(machine):
        machine.make_automaton()
    return machine


class Finder:
    """Finds the clauses that can score at all, in one pass of a multi-pattern automaton."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon = lexicon
        self.machine = _automaton({*lexicon.whole, *lexicon.stems, *THREATS})

    def scores(self, text: str) -> list[float]:
        low = text.lower()
        out, upto = [], 0
        if not len(self.machine):
            return out
        for end, size in self.machine.iter(low):
            at = end - size + 1
            if at < upto or at and low[at - 1].isalnum():
                continue
            start = max((low.rfind(c, upto, at) for c in ".!?;:\n"), default=-1) + 1
            start = max(start, upto)
            m = _clause.match(low, at)
            upto = m.end() if m else end + 1
            s = clause_score(_word.findall(low[start:upto]), self.lexicon)
            if s > 0:
                out.append(s)
        return out


def _words_of(text: str) -> set[str]:
    return {w.strip(_strip) for w in _word.findall(text.lower())}


def _features(words: set[str]) -> tuple[set[str], set[str]]:
    return {w for w in words if len(w) > 2}, {w[:k] for w in words for k in range(MIN_STEM, min(MAX_STEM, len(w)) + 1)}


def features_of(text: str) -> set[tuple[int, str]]:
    """(0, word) and (1, word beginning) for the words of a text, in lower case without punctuation."""
    return {(kind, f) for kind, found in enumerate(_features(_words_of(text))) for f in found}


def _told(rows: DataFrame, known: DataFrame | None) -> DataFrame:
    """Rows of texts with y: their own, or that of each label of their doc_id (neither side is broadcast, as both grow with the tables)."""
    return rows if known is None else rows.join(known.hint("merge"), "doc_id")


def lexicon_from(texts: DataFrame, known: DataFrame | None = None) -> Lexicon:
    """Words and word beginnings far commoner in toxic texts than chance allows, all of them, weighed by their log odds.

    ``texts`` are (doc_id, text) if ``known`` holds the labels (doc_id, y), else (doc_id, text, y).
    A feature in a toxic and b clean texts is taken if its toxic share is at least 0.9, if a toxic texts hold it by
    chance with a probability under CHANCE at the base rate, and if it stands in MIN_CLAUSES different clauses of toxic texts at least,
    so that copies of one text do not make an insult of what they share.  Every labelled text is counted; only features that pass come to the driver.
    """
    keys, kinds = (["doc_id", "y"], "doc_id long, y int") if known is None else (["doc_id"], "doc_id long")
    tot = {r.y: r.n for r in _told(texts.select(*keys), known).groupBy("y").agg(F.count("*").alias("n")).collect()}
    toxic, clean = tot.get(1, 0), tot.get(0, 0)
    if not toxic or not clean:
        return Lexicon({}, {})

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = ["\n".join(sorted(_words_of(t))) for t in batch.column("text").to_pylist()]  # no word holds a line break
            yield pa.record_batch([*(batch.column(k) for k in keys), pa.array(found, pa.string())], names=[*keys, "words"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = {(kind, y): Counter() for kind in (0, 1) for y in (0, 1)}

        def counted() -> Iterator[pa.RecordBatch]:
            for (kind, y), own in seen.items():
                n, none = pa.array(own.values(), pa.int64()), pa.array(np.zeros(len(own), np.int64))
                yield from pa.table({"kind": pa.array(np.full(len(own), kind, np.int32)), "word": pa.array(own.keys(), pa.string()), "a": n if y else none, "b": none if y else n}).to_batches(50_000)
                own.clear()

        for batch in slices(batches, "words"):
            for y, text in zip(batch.column("y").to_pylist(), batch.column("words").to_pylist(), strict=True):
                for kind, found in enumerate(_features(set(text.split("\n")))):
                    seen[kind, y].update(found)
            if sum(map(len, seen.values())) > COUNTED:
                yield from counted()
        yield from counted()

    least = max(MIN_CLAUSES, math.ceil(math.log(CHANCE) / math.log(toxic / (toxic + clean))))
    each = _told(texts.select(*keys, "text").mapInArrow(words, f"{kinds}, words string"), known).select("y", "words").mapInArrow(count, "kind int, word string, a long, b long")
    rows = each.groupBy("kind", "word").agg(F.sum("a").alias("a"), F.sum("b").alias("b")).where((F.col("a") >= least) & (F.col("a") >= 9 * F.col("b"))).collect()
    if not rows:
        return Lexicon({}, {})
    number = {(r.kind, r.word): i for i, r in enumerate(sorted(rows))}

    def clauses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _automaton({w for _, w in number})
        met = lambda t: next(machine.iter(t), None) is not None
        for batch in slices(batches):
            lows = ((i, t.lower()) for i, t in enumerate(batch.column("text").to_pylist()))
            parts = ((i, c) for i, low in lows if met(low) for c in _clause.findall(low) if met(c))
            seen = sorted({(i, number[f], hashlib.blake2b(c.strip().encode(), digest_size=16).digest()) for i, c in parts for f in features_of(c) if f in number})
            at = pa.array([i for i, _, _ in seen], pa.int64())
            yield pa.record_batch([*(batch.column(k).take(at) for k in keys), pa.array([e for _, e, _ in seen], pa.int32()), pa.array([c for _, _, c in seen], pa.binary())], names=[*keys, "entry", "clause"])

    met = _told(texts.select(*keys, "text").mapInArrow(clauses, f"{kinds}, entry int, clause binary"), known)
    found = met.where("y = 1").groupBy("entry").agg(F.countDistinct("clause").alias("n")).where(F.col("n") >= MIN_CLAUSES).collect()
    kept = {r.entry for r in found}
    whole, stems = {}, {}
    for r in rows:
        if number[r.kind, r.word] in kept:
            (stems if r.kind else whole)[r.word] = math.log((r.a + 0.5) / (toxic + 1)) - math.log((r.b + 0.5) / (clean + 1))
    return Lexicon(whole, stems)


def train(docs: DataFrame, labels: DataFrame, per_class: int | None = None, folds: int | None = FOLDS, held: int = HELD) -> ToxicModel:
    """Learn stems and the final logistic from all labelled texts, or, if ``per_class`` is given, from at most so many of each kind."""
    known, texts = labelled(labels, "toxic"), id_text(docs)
    if folds is not None:
        known, texts = (rows.where(crc_fold("doc_id", folds) != held) for rows in (known, texts))
    if per_class is not None:
        known = first_of_each(known, per_class)
    lexicon = lexicon_from(texts, known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Finder(lexicon)
        for batch in slices(batches):
            got = [own.scores(t) for t in batch.column("text").to_pylist()]
            yield pa.record_batch([batch.column("doc_id"), pa.array([max(s, default=0.0) for s in got], pa.float64()), pa.array([math.log1p(sum(s)) for s in got], pa.float64())], names=["doc_id", "best", "total"])

    scored = _told(texts.mapInArrow(run, "doc_id long, best double, total double"), known)
    w = fit(checkpoint(scored.groupBy("y", F.expr("best / 5").alias("best"), "total").agg(F.count("*").cast("double").alias("n"))))
    return ToxicModel(lexicon, -3.0, 1.0, 1.0) if w is None else ToxicModel(lexicon, float(w[0]), float(w[1]) / 5, float(w[2]))


def fit(rows: DataFrame, ridge: float = 1e-3) -> np.ndarray | None:
    """Weights of 1, best and total for rows (y, best, total, n times): Newton steps with a ridge; None without rows of both kinds.

    Sums are of decimals, so that they do not hang on the order of adding.
    """
    total = {r.y: r.n for r in rows.groupBy("y").agg(F.sum("n").alias("n")).collect()}
    if len(total) < 2:
        return None
    start = w = np.array([-2.0, 1.0, 1.0])
    x = (F.lit(1.0), F.col("best"), F.col("total"))
    upper = [(i, j) for i in range(3) for j in range(i, 3)]
    for _ in range(30):
        z = F.greatest(F.lit(-30.0), F.least(F.lit(30.0), sum(c * float(v) for c, v in zip(x, w, strict=True))))
        p = rows.select("*", (1 / (1 + F.exp(-z))).alias("p"))
        terms = [c * (F.col("p") - F.col("y")) for c in x] + [x[i] * x[j] * F.col("p") * (1 - F.col("p")) for i, j in upper]
        got = p.agg(*(F.sum((F.col("n") * t).cast("decimal(38,15)")).alias(f"s{k}") for k, t in enumerate(terms))).first()
        g, h = np.array(got[:3], dtype=float) / sum(total.values()) + ridge * (w - start), ridge * np.eye(3)
        for (i, j), v in zip(upper, got[3:], strict=True):
            h[i, j] += float(v) / sum(total.values())
            h[j, i] = h[i, j]
        step = np.linalg.solve(h, g)
        w = w - step
        if np.abs(step).max() < 1e-9:  # the next would be under its square
            break
    return w


def score(docs: DataFrame, model: ToxicModel, threshold: float = 0.5, folds: int = FOLDS, held: int = HELD) -> DataFrame:
    """doc_id, held_out, score, predicted, n_clauses for every text; null and empty texts score as empty.

    Texts are read whole whatever their length; a score of exactly the threshold counts as toxic; repeated rows repeat.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Finder(model.lexicon)
        for batch in slices(batches):
            got = [own.scores(t) for t in batch.column("text").to_pylist()]
            z = np.array([model.bias + model.best * max(s, default=0.0) + model.total * math.log1p(sum(s)) for s in got])
            p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            yield pa.record_batch([batch.column("doc_id"), pa.array(p), pa.array((p >= threshold).astype(np.int32)), pa.array([len(s) for s in got], pa.int64())], names=["doc_id", "score", "predicted", "n_clauses"])

    scored = id_text(docs).mapInArrow(run, "doc_id long, score double, predicted int, n_clauses long")
    return scored.select("doc_id", F.coalesce(crc_fold("doc_id", folds) == held, F.lit(False)).alias("held_out"), "score", "predicted", "n_clauses")


def without_toxic(docs: DataFrame, model: ToxicModel, threshold: float = 0.5) -> DataFrame:
    """The rows of docs whose text scores below the threshold, all columns as they are; null texts stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Finder(model.lexicon)
        for batch in batches:
            got = [own.scores(t) if t else [] for t in batch.column(batch.schema.get_field_index("text")).to_pylist()]
            z = np.array([model.bias + model.best * max(s, default=0.0) + model.total * math.log1p(sum(s)) for s in got])
            yield batch.filter(pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))) < threshold))

    return docs.mapInArrow(run, docs.schema)
