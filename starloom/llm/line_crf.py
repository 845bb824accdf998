"""Line labels from a linear-chain conditional random field, decoded by Viterbi.

Each line of a text that has a word is content or boilerplate.  Emission weights act on the features
of text_stats.line_features, a 2 x 2 table scores neighbouring labels, and a pair of start weights the
first line.  The share of words on content lines decides whether a text is kept.

The field is fitted on a bounded sample of labelled texts.  No line labels exist, so they are hidden: a fit without
moves, in which lines start with their text's label, gives each line odds of its own; lines then take the likelier
label, as far as most words of a good text stay content and most of a bad one boilerplate, and after some turns of
this the whole field is fitted to the line labels, so that its moves are learned from texts of both kinds of lines.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import id_text, labelled_sample, slices
from starloom.llm.text_stats import LINE_FEATURES, base_counts, line_features, words_in

SAMPLE_PER_CLASS = 1500
#: A labelled text gives the fit a stretch of at most so many lines, from a place that its doc_id settles.
LINES_PER_TEXT = 400
TURNS = 3
CONTENT, BOILERPLATE = 1, 0


@dataclass(frozen=True)
class LineField:
    weights: np.ndarray  # (features, 2)
    moves: np.ndarray  # (2, 2): from, to
    start: np.ndarray  # (2,)


def lines_of(text: str) -> tuple[list[list[float]], list[int]]:
    """Features and word counts of the lines that have a word."""
    rows, sizes, seen = [], [], set()
    for line in text.split("\n"):
        n = len(words_in(line))
        if n:
            rows.append(line_features(line, line in seen))
            sizes.append(n)
            seen.add(line)
    return rows, sizes


def viterbi(field: LineField, emit: np.ndarray) -> np.ndarray:
    """Best label sequence for (lines, 2) emission scores; ties go to boilerplate (label 0)."""
    n = len(emit)
    if not n:
        return np.zeros(0, dtype=np.int8)
    (m00, m01), (m10, m11) = field.moves.tolist()
    a, b = (field.start + emit[0]).tolist()
    back = []
    for x, y in emit[1:].tolist():
        fa, fb = a + m00 < b + m10, a + m01 < b + m11
        back.append((fa, fb))
        a, b = (b + m10 if fa else a + m00) + x, (b + m11 if fb else a + m01) + y
    at = int(b > a)
    out = [at]
    for step in reversed(back):
        at = int(step[at])
        out.append(at)
    return np.array(out[::-1], dtype=np.int8)


def hidden_labels(odds: np.ndarray, sizes: np.ndarray, good: int) -> np.ndarray:
    """The likelier label of each line; where most words would be of the other kind than the text, the lines nearest to it give way."""
    labels = (odds > 0).astype(np.int64)
    order = np.argsort(-odds if good else odds, kind="stable")  # lines by how well they suit the text's label
    least = np.searchsorted(np.cumsum(sizes[order]), sizes.sum() / 2) + 1
    labels[order[:least]] = good
    return labels


def fit_hidden(sequences: list[np.ndarray], sizes: list[np.ndarray], texts: list[int], turns: int = TURNS) -> LineField:
    """The field of texts whose own labels are known and whose lines' are not; sizes are the lines' words."""
    labels = [np.full(len(s), y) for s, y in zip(sequences, texts, strict=True)]
    for _ in range(turns):
        field = fit_lines(sequences, labels)
        odds = [s @ (field.weights[:, CONTENT] - field.weights[:, BOILERPLATE]) for s in sequences]
        labels = [hidden_labels(o, n, y) for o, n, y in zip(odds, sizes, texts, strict=True)]
    return fit(sequences, labels)


ROUNDS, RATE, DECAY = 120, 0.3, 1e-3


def _climb(params: list[np.ndarray], slope: Callable[[], list[np.ndarray]]) -> None:
    """ROUNDS steps up, with momentum, scaled by the slopes' size so far; params change in place."""
    vel, sq = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for it in range(1, ROUNDS + 1):
        for p, d, v, s in zip(params, slope(), vel, sq, strict=True):
            v *= 0.9
            v += 0.1 * d
            s *= 0.99
            s += 0.01 * d * d
            p += RATE * (v / (1 - 0.9**it)) / (np.sqrt(s / (1 - 0.99**it)) + 1e-6)


def _shares(labels: list[np.ndarray]) -> np.ndarray:
    """The weight of a line of each text: a text counts once, classes alike."""
    kind = np.array([s.mean() >= 0.5 for s in labels]).astype(int)
    return np.array([0.5 / max(1, (kind == v).sum()) for v in (0, 1)])[kind] / np.maximum([len(s) for s in labels], 1)


def fit_lines(sequences: list[np.ndarray], labels: list[np.ndarray]) -> LineField:
    """The field without its chain: a logistic model of single lines."""
    w = np.zeros((len(LINE_FEATURES), 2))
    if not sequences:
        w[0, CONTENT] = 1.0
        return LineField(w, np.zeros((2, 2)), np.zeros(2))
    x, y, share = np.concatenate(sequences), np.concatenate(labels), np.repeat(_shares(labels), [len(s) for s in labels])
    want = np.zeros((len(x), 2))
    want[np.arange(len(x)), y] = 1

    def slope() -> list[np.ndarray]:
        z = x @ w
        post = np.exp(z - np.logaddexp(z[:, 0], z[:, 1])[:, None])
        return [x.T @ ((want - post) * share[:, None]) - DECAY * w]

    _climb([w], slope)
    return LineField(w, np.zeros((2, 2)), np.zeros(2))


def fit(sequences: list[np.ndarray], labels: list[np.ndarray]) -> LineField:
    """Gradient ascent on the conditional likelihood of line labels, by forward-backward over all sequences at once."""
    k = len(LINE_FEATURES)
    if not sequences:
        weights = np.zeros((k, 2))
        weights[0, CONTENT] = 1.0
        return LineField(weights, np.zeros((2, 2)), np.zeros(2))
    longest = max(map(len, sequences))
    order = sorted(range(len(sequences)), key=lambda i: -len(sequences[i]))
    sequences, labels = [sequences[i] for i in order], [labels[i] for i in order]
    sizes = np.array([len(s) for s in sequences])
    alive = [int((sizes > t).sum()) for t in range(longest)]
    x = [np.stack([s[t] for s in sequences[: alive[t]]]) for t in range(longest)]
    y = [np.array([s[t] for s in labels[: alive[t]]]) for t in range(longest)]
    share = _shares(labels)
    w, moves, start = np.zeros((k, 2)), np.zeros((2, 2)), np.zeros(2)

    def slope() -> list[np.ndarray]:
        emit = [r @ w for r in x]
        fwd = [start + emit[0]]
        for t in range(1, longest):
            p = fwd[-1][: alive[t], :, None] + moves
            fwd.append(np.logaddexp(p[:, 0], p[:, 1]) + emit[t])
        bwd = [np.zeros((alive[-1], 2))]
        for t in range(longest - 1, 0, -1):
            nxt = moves + (emit[t] + bwd[-1])[:, None, :]
            b = np.zeros((alive[t - 1], 2))
            b[: alive[t]] = np.logaddexp(nxt[:, :, 0], nxt[:, :, 1])
            bwd.append(b)
        bwd.reverse()
        logz = np.logaddexp(*(fwd[0] + bwd[0]).T)
        g = [-DECAY * p for p in (w, moves, start)]
        for t in range(longest):
            n = alive[t]
            post = np.exp(fwd[t] + bwd[t] - logz[:n, None])
            want = np.zeros((n, 2))
            want[np.arange(n), y[t]] = 1
            diff = (want - post) * share[:n, None]
            g[0] += x[t].T @ diff
            if t == 0:
                g[2] += diff.sum(0)
            else:
                pair = np.exp(fwd[t - 1][:n, :, None] + moves + (emit[t] + bwd[t])[:, None, :] - logz[:n, None, None])
                both = np.zeros((n, 2, 2))
                both[np.arange(n), y[t - 1][:n], y[t]] = 1
                g[1] += ((both - pair) * share[:n, None, None]).sum(0)
        return g

    _climb([w, moves, start], slope)
    return LineField(w, moves, start)


def train(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> LineField:
    """Fit the field on at most ``per_class`` labelled texts of each kind.

    What comes to the driver is the features of those texts' lines, at most 2 x per_class texts of
    at most LINES_PER_TEXT lines each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for doc, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                x, sizes = lines_of(t)
                at = doc * 2654435761 % max(1, len(x) - LINES_PER_TEXT + 1)
                rows.append(np.array([[*f, n] for f, n in zip(x, sizes, strict=True)][at : at + LINES_PER_TEXT], dtype=np.float32).tobytes())
            yield pa.record_batch([batch.column("y"), batch.column("doc_id"), pa.array(rows, pa.binary())], names=["y", "doc_id", "lines"])

    got = labelled_sample(docs, labels, "quality", per_class).select("y", "doc_id", "text").mapInArrow(run, "y int, doc_id long, lines binary").collect()
    got = sorted((r for r in got if r.lines), key=lambda r: (r.doc_id, r.y, r.lines))
    rows = [np.frombuffer(r.lines, dtype=np.float32).reshape(-1, len(LINE_FEATURES) + 1).astype(float) for r in got]
    return fit_hidden([x[:, :-1] for x in rows], [x[:, -1] for x in rows], [r.y for r in got])


def label_lines(docs: DataFrame, field: LineField, min_share: float = 0.5) -> DataFrame:
    """Base counts, line labels and the verdict for each text.

    doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept,
    content_share, labels (array<tinyint>, one for each line with a word: 1 content, 0 boilerplate).
    Null and empty texts have no words: base_failed, not kept, share 0.  Repeated rows repeat.  Very long texts are
    labelled whole; ties of paths go to boilerplate, and a content share of exactly min_share is kept.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out: list[list] = [[] for _ in range(9)]
            for text in batch.column("text").to_pylist():
                words, chars, symbols, dup, repeat = base_counts(text)
                n = len(words)
                failed = n < 10 or 100 * repeat > 20 * n
                rows, sizes = lines_of(text)
                labels = viterbi(field, np.array(rows) @ field.weights) if rows else np.zeros(0, dtype=np.int8)
                share = float(np.dot(labels, sizes)) / n if n else 0.0
                for column, v in zip(out, (n, chars, symbols, dup, repeat, failed, not failed and share >= min_share, share, labels.tolist()), strict=True):
                    column.append(v)
            kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64(), pa.list_(pa.int8())]
            names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "content_share", "labels"]
            yield pa.record_batch([batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(out, kinds, strict=True))], names=["doc_id", *names])

    return id_text(docs).mapInArrow(run, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, content_share double, labels array<tinyint>")


def verdicts(labelled: DataFrame) -> DataFrame:
    """The counts and the verdict, with the labels as their number of content lines."""
    return labelled.withColumn("n_content_lines", F.expr("size(filter(labels, x -> x = 1))").cast("long")).withColumn("n_lines", F.size("labels").cast("long")).drop("labels")
