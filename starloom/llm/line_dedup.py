"""Line dedup by a deletion neighbourhood over words.

Two lines are the same if their words are, or if both have at least MIN_WORDS words and one word edit (a
word put in, left out or exchanged) turns one into the other.  A line goes if any line before it, in
order of (doc_id, line number), is the same; lines are judged on the input.  Lines without a word stay.

Every distinct line emits its own hash and that of the line less each one of its words; equal hashes
meet in one group.  The edit is then verified: a variant at word i of one line must meet the whole of the
other, or the variant at the same word i.  Before that, guards leave out lines that cannot meet
any: two lines one edit apart share their first or their last half, so lines of which no half is
found in another line emit no variants.  Whole lines have hashes of 128 bits, variants of 96,
from two independent hashes of each word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.common import as_list, bytes_of, checkpoint, id_text, mix, offsets_of, signed, slices, split_words
from starloom.llm.text_stats import has_word

MIN_WORDS = 8
_U = np.uint64
_PLACE = (_U(0x9FB21C651E98DF25), _U(0xD1342543DE82EF95))


@dataclass
class Lines:
    """The lines with a word of a text column: row, number in its text, word range, two hashes of each word."""

    row: np.ndarray
    number: np.ndarray
    first: np.ndarray
    last: np.ndarray
    words: tuple[np.ndarray, np.ndarray]

    def sums(self, which: int) -> Sums:
        n = self.last - self.first
        at = np.arange(len(self.words[which])) - np.repeat(self.first, n)
        total = lambda place: np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(self.words[which] ^ mix(place.astype(np.uint64) * _PLACE[which])))])
        return Sums(total(at), total(at - 1), total(at - np.repeat(n, n)))


@dataclass
class Sums:
    """Running sums of hashes of (word, place): its place from the line's start, one less, and from its end.

    A sequence's hash is the sum over its words, each scrambled with its place, so that patterns of
    words do not cancel.
    """

    fore: np.ndarray
    moved: np.ndarray
    back: np.ndarray

    def head(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Of the words [a, b), a being where the line starts."""
        return self.fore[b] - self.fore[a]

    def tail(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Of the words [a, b), b being where the line ends."""
        return self.back[b] - self.back[a]

    def less(self, a: np.ndarray, at: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Of the line [a, b) without its word a + at, as head() gives it for a line that never had it."""
        return self.fore[a + at] - self.fore[a] + self.moved[b] - self.moved[a + at + 1]


def lines_of(column: pa.Array) -> Lines:
    words = split_words(column)
    off = offsets_of(column)
    breaks = np.flatnonzero(bytes_of(column) == 10)
    line = np.searchsorted(breaks, words.start)
    number = line - np.searchsorted(breaks, off[:-1])[words.row]
    n = len(line)
    if not n:
        e = np.zeros(0, dtype=np.int64)
        return Lines(e, e, e, e, (words.hash, words.hash))
    first = np.flatnonzero(np.concatenate([[True], (line[1:] != line[:-1]) | (words.row[1:] != words.row[:-1])]))
    return Lines(words.row[first], number[first], first, np.append(first[1:], n), (words.hash, words.other_hash()))


def _sized(h: np.ndarray, n: np.ndarray) -> np.ndarray:
    return mix(h ^ (n.astype(np.uint64) * _U(0xC2B2AE3D27D4EB4F)))


def _line_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each distinct line of a slice, at its first place there, with its guards."""
    for batch in slices(batches):
        lines = lines_of(batch.column("text"))
        if not len(lines.row):
            continue
        s0, s1 = lines.sums(0), lines.sums(1)
        n = lines.last - lines.first
        h1, h2 = _sized(s0.head(lines.first, lines.last), n), _sized(s1.head(lines.first, lines.last), n)
        ids, ths = batch.column("doc_id").to_numpy(), batch.column("th").to_numpy()
        order = np.lexsort((lines.number, ids[lines.row], h2, h1))
        a, b = h1[order], h2[order]
        pick = order[np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])]
        first, last, size = lines.first[pick], lines.last[pick], n[pick]
        guards = []
        for long in (size, size + 1):  # the longer line of a pair halves at its own middle
            q = long // 2
            guards.append(_sized(s0.head(first, np.minimum(first + q, last)), 4 * q))
            guards.append(_sized(s0.tail(np.maximum(last - (long - q), first), last), 4 * (long - q) + 1))
        some = np.where(size >= MIN_WORDS, 4, 0)
        table = np.stack(guards, axis=1)[size >= MIN_WORDS].ravel()
        yield pa.record_batch(
            [pa.array(signed(h1[pick])), pa.array(signed(h2[pick])), pa.array(ids[lines.row[pick]]), pa.array(ths[lines.row[pick]]), pa.array(lines.number[pick].astype(np.int32)), as_list(signed(table), np.append(0, np.cumsum(some)), pa.int64())],
            names=["h1", "h2", "doc_id", "th", "line", "guards"],
        )


def _variant_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(v1, v2, at, doc_id, th, line, told): the whole line (at -1) and the line less its word ``at``; told rows
    name lines that the slice itself has shown to be repeats."""
    for batch in slices(batches):
        lines = lines_of(batch.column("text"))
        wanted = batch.column("lines")
        lens = np.diff(np.asarray(wanted.offsets))
        key = lambda row, number: row.astype(np.int64) << 32 | number.astype(np.int64)
        hit = np.isin(key(lines.row, lines.number), key(np.repeat(np.arange(len(lens)), lens), np.asarray(wanted.flatten())))
        row, number, first, last = lines.row[hit], lines.number[hit], lines.first[hit], lines.last[hit]
        if not len(row):
            continue
        n = last - first
        owner = np.repeat(np.arange(len(row)), n)
        at = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
        a, b = first[owner], last[owner]
        out = []
        for which in (0, 1):
            s = lines.sums(which)
            out.append(np.concatenate([_sized(s.head(first, last), n), _sized(s.less(a, at, b), n[owner] - 1)]))
        who = np.concatenate([np.arange(len(row)), owner])
        spot = np.concatenate([np.full(len(row), -1), at])
        v1, v2 = signed(out[0]), signed(out[1]) >> 32
        ids, ths = batch.column("doc_id").to_numpy(), batch.column("th").to_numpy()
        # of the lines of a slice that agree without their word ``at``, the first speaks for all: the others go
        order = np.lexsort((number[who], ids[row[who]], spot, v2, v1))
        a, b, c = v1[order], v2[order], spot[order]
        fresh = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (c[1:] != c[:-1])]) | (c < 0)
        ahead = order[np.flatnonzero(fresh)[np.cumsum(fresh) - 1]]
        other = (ids[row[who[order]]] != ids[row[who[ahead]]]) | (number[who[order]] != number[who[ahead]])  # not the same place of a repeated row
        keep, sure = order[fresh], np.unique(who[order[~fresh & other]])
        told = np.concatenate([np.zeros(len(keep), bool), np.ones(len(sure), bool)])
        who = np.concatenate([who[keep], sure])
        own = signed(mix(number[sure].astype(np.uint64) ^ ids[row[sure]].view(np.uint64)))
        none = np.zeros(len(sure), np.int64)
        yield pa.record_batch(
            [pa.array(np.concatenate([v1[keep], own])), pa.array(np.concatenate([v2[keep], none]), pa.int32()), pa.array(np.concatenate([spot[keep], none - 2]).astype(np.int32)), pa.array(ids[row[who]]), pa.array(ths[row[who]]), pa.array(number[who].astype(np.int32)), pa.array(told)],
            names=["v1", "v2", "at", "doc_id", "th", "line", "told"],
        )


def _mark() -> Column:
    """A hash of the text, so that rows that share a doc_id stay apart."""
    return F.coalesce(F.xxhash64(F.coalesce(F.col("text"), F.lit(""))), F.lit(0))  # not nullable: both joins read one exchange


def _texts(docs: DataFrame) -> DataFrame:
    return id_text(docs).select("doc_id", _mark().alias("th"), "text").where("doc_id is not null")


def kept_lines(docs: DataFrame) -> DataFrame:
    """doc_id, th, kept array<int>: numbers of the lines with a word that stay in each text."""
    texts = _texts(docs)
    place = F.struct("doc_id", "line", "th")
    rows = texts.mapInArrow(_line_rows, "h1 long, h2 long, doc_id long, th long, line int, guards array<long>")
    distinct = checkpoint(rows.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.first("guards").alias("guards")).select("first.*", "guards"))
    guarded = distinct.select("doc_id", "th", "line", F.explode(F.array_distinct("guards")).alias("guard"))
    met = guarded.groupBy("guard").agg(F.count("*").alias("n")).where("n > 1").select("guard")
    likely = guarded.join(met, "guard").groupBy("doc_id", "th").agg(F.collect_set("line").alias("lines"))
    variants = texts.join(likely, ["doc_id", "th"]).select("doc_id", "th", "text", "lines").mapInArrow(_variant_rows, "v1 long, v2 int, at int, doc_id long, th long, line int, told boolean")
    # one exchange brings equal variants together; each line sees the first of those it may be matched with
    group = Window.partitionBy("v1", "v2")
    seen = variants.withColumns({
        "whole": F.min(F.when(F.col("at") == -1, place)).over(group), "less": F.min(F.when(F.col("at") >= 0, place)).over(group), "same": F.min(place).over(Window.partitionBy("v1", "v2", "at")),
    })
    later = F.when(F.col("at") < 0, F.col("less") < place).otherwise((F.col("whole") < place) | (F.col("same") < place))
    gone = seen.where(F.col("told") | F.coalesce(later, F.lit(False))).select("doc_id", "th", "line").distinct()
    return distinct.select("doc_id", "th", "line").join(gone, ["doc_id", "th", "line"], "left_anti").groupBy("doc_id", "th").agg(F.collect_set("line").alias("kept"))


def without_repeated_lines(docs: DataFrame) -> DataFrame:
    """doc_id, text, n_lines, n_removed and the other columns of docs, with the repeated lines gone.

    n_lines counts lines with a word, n_removed those taken out.  Null texts stay null and lose
    nothing; a text may end up without lines.  Of repeated rows of one doc_id all keep the same lines.
    Rows without doc_id have no place in the order and stay as they are.  Columns of docs that are
    themselves named n_lines or n_removed give way; ``with_repeats_gone`` keeps them.
    """
    others = [c for c in docs.columns if c not in ("doc_id", "text", "n_lines", "n_removed")]
    return _rewritten(docs).select("doc_id", "text", "n_lines", "n_removed", *(F.col("rest")[c].alias(c) for c in others))


def with_repeats_gone(docs: DataFrame) -> DataFrame:
    """The columns of docs, whatever their names, with the repeated lines gone; a text that so loses all its words goes.

    n_chars, if there is one, is counted anew where lines went.  Nulls, ties and repeated rows as above.
    """
    left = _rewritten(docs).where((F.col("n_removed") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    anew = {"doc_id": F.col("doc_id"), "text": F.col("text")}
    if "n_chars" in docs.columns:
        counted = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        anew["n_chars"] = F.when(F.col("n_removed") > 0, counted).otherwise(F.col("rest")["n_chars"])
    return left.select(*(anew.get(c, F.col("rest")[c]).alias(c) for c in docs.columns))


def _rewritten(docs: DataFrame) -> DataFrame:
    """doc_id, text, n_lines, n_removed, and the other columns of docs in the struct ``rest``."""
    others = [c for c in docs.columns if c not in ("doc_id", "text")] or [F.lit(0).alias("none")]
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _mark().alias("th"), "text", F.struct(*others).alias("rest"))
    joined = base.join(kept_lines(docs), ["doc_id", "th"], "left").select("doc_id", "text", "kept", "rest")
    schema = T.StructType([joined.schema["doc_id"], joined.schema["text"], T.StructField("n_lines", T.LongType()), T.StructField("n_removed", T.LongType()), joined.schema["rest"]])
    return joined.mapInArrow(_kept_rows, schema)


def cleaned_texts(docs: DataFrame) -> DataFrame:
    """doc_id, text, n_lines, n_removed: the same without the other columns.

    The texts are the frame that kept_lines() joins as well, so all joins read one exchange of them.
    """
    apart = id_text(docs).where("doc_id is null").select("doc_id", "text", F.lit(None).cast("array<int>").alias("kept"))
    joined = _texts(docs).join(kept_lines(docs), ["doc_id", "th"], "left").select("doc_id", "text", "kept")
    return joined.unionByName(apart).mapInArrow(_kept_rows, "doc_id long, text string, n_lines long, n_removed long")


def _kept_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        out, n_lines, n_removed = [], [], []
        for doc, text, kept in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), batch.column("kept").to_pylist(), strict=True):
            lines = text.split("\n") if text else []
            stay = set(kept or ())
            left, n, m = [], 0, 0
            for i, line in enumerate(lines):
                if has_word(line):
                    n += 1
                    if i not in stay and doc is not None:
                        m += 1
                        continue
                left.append(line)
            out.append("\n".join(left) if m else text)
            n_lines.append(n)
            n_removed.append(m)
        rest = [batch.column("rest")] if "rest" in batch.schema.names else []
        yield pa.record_batch([batch.column("doc_id"), pa.array(out, pa.string()), pa.array(n_lines, pa.int64()), pa.array(n_removed, pa.int64()), *rest], names=["doc_id", "text", "n_lines", "n_removed", "rest"][: 4 + len(rest)])


def digests(cleaned: DataFrame) -> DataFrame:
    return cleaned.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))
