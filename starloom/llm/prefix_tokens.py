"""Token counts by prefix dynamic programming.

For a byte-pair piece table the encoding of a text is the one chain of pieces in which no pair of
neighbours would have merged across its border.  The last piece of each prefix is therefore found
from the prefixes before it: the only piece that ends there, stands alone under the merges and
agrees with the last piece of the prefix it leaves.  One pass gives the exact number of tokens of
every prefix, from which cuts and budgets are read without encoding again.

The text is first cut where no piece of the table can reach across (before a run of word marks, and
around characters of no longer piece), so equal words share their counts, and sorted words share
those of their common beginnings.
"""

from __future__ import annotations

import itertools
import re
import string
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import id_text, slices

MARK = "▁"
MEMO_WORDS = 1_200_000


@dataclass(frozen=True)
class PieceTable:
    """Pieces that text can be made of, best first, and the ids they have in the model."""

    pieces: tuple[str, ...]
    ids: tuple[int, ...]
    scores: tuple[float, ...]
    byte_ids: tuple[int, ...]
    unknown_id: int
    kind: str  # "bpe" or "unigram"


def load_pieces(model_path: str, kind: str = "bpe") -> PieceTable:
    """Read a piece model on the driver; tasks get the table (some 32,000 short strings), not the path."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
    n = sp.get_piece_size()
    own = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
    own.sort(key=lambda i: (-sp.get_score(i), i))
    by = {sp.id_to_piece(i): i for i in range(n) if sp.is_byte(i)}
    return PieceTable(tuple(sp.id_to_piece(i) for i in own), tuple(own), tuple(sp.get_score(i) for i in own), tuple(by.get(f"<0x{b:02X}>", -1) for b in range(256)), sp.unk_id(), kind)


def _borders(pieces: tuple[str, ...]) -> tuple[set[tuple[str, str]], str, set[str]]:
    """Neighbours inside pieces, the newline if it has none, and the punctuation that no piece joins to a letter."""
    beside = {pair for p in pieces for pair in itertools.pairwise(p)}
    cut = "" if any("\n" in pair for pair in beside) else "\n"
    return beside, cut, set(string.punctuation) - {c for a, b in beside for c, d in ((a, b), (b, a)) if d.isalpha()}


def border_characters(pieces: tuple[str, ...]) -> list[str]:
    """Characters at which word_pattern() may cut inside a run between marks; a run without any is one word."""
    _, cut, marks = _borders(pieces)
    return sorted(marks | set(cut))


def word_pattern(pieces: tuple[str, ...]) -> str:
    """A pattern for the words of a marked text: cuts only where no piece of the table reaches across.

    That is before a run of marks, around a newline, and between punctuation that no piece joins to a letter
    and characters that no piece joins to such punctuation.
    """
    beside, cut, marks = _borders(pieces)
    if any(b == MARK and a != MARK for a, b in beside):
        return r"(?s).+"
    joined = {d for a, b in beside for c, d in ((a, b), (b, a)) if c in marks and d not in marks and d != MARK}
    q, j = (re.escape("".join(sorted(x))) for x in (marks, joined))
    parts = [rf"{MARK}*[^{MARK}{cut}]+", rf"{MARK}+"] + (["\n"] if cut else [])
    if marks:
        parts = [rf"{MARK}*[^{MARK}{cut}{q}]++(?:(?<=[^{MARK}{cut}{q}{j}])|(?![^{MARK}{cut}]))", rf"{MARK}*[{q}]++" + (f"(?![{j}])" if joined else ""), *parts]
    return "|".join(parts)


class PrefixCounter:
    """Counts tokens of words and of each of their prefixes."""

    def __init__(self, table: PieceTable):
        self.rank = {p: r for r, p in enumerate(table.pieces)}
        self.longest = max(map(len, table.pieces), default=1)
        self.bytes = table.byte_ids[0] >= 0
        self._right: dict[str, list] = {}
        self._left: dict[str, list] = {}
        self._agree: dict[tuple[str, str], bool] = {}
        self.whole = {p: self._halves(p) for p in table.pieces}
        self.whole = {p: h for p, h in self.whole.items() if h is not None}
        self.chunk = re.compile(word_pattern(table.pieces))
        self.memo: dict[str, bytes | tuple[int, ...]] = {}  # tokens of each prefix of a word, from one character on

    def merge(self, text: str) -> list[str]:
        """The merges themselves, for single pieces and as the plain check in tests."""
        parts = list(text)
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: (self.rank.get(parts[i] + parts[i + 1], 1 << 60), i))
            if parts[best] + parts[best + 1] not in self.rank:
                break
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        return parts

    def _halves(self, piece: str) -> tuple[str, str] | tuple[()] | None:
        """What a piece is last merged from; () for a character, None if merges never give it."""
        if len(piece) == 1:
            return ()
        parts = list(piece)
        while len(parts) > 2:
            best = min(range(len(parts) - 1), key=lambda i: (self.rank.get(parts[i] + parts[i + 1], 1 << 60), i))
            if parts[best] + parts[best + 1] not in self.rank:
                return None
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        return (parts[0], parts[1])

    def _edge(self, piece: str, side: int) -> list[tuple[str, int, int]]:
        """The symbols that stand at one edge while a piece is merged: (symbol, made at, gone at)."""
        store = (self._left, self._right)[side]
        got = store.get(piece)
        if got is None:
            got, gone, at = [], 1 << 60, piece
            while True:
                made = self.rank[at] if len(at) > 1 else -1
                got.append((at, made, gone))
                halves = self.whole.get(at)
                if not halves:
                    break
                gone, at = self.rank[at], halves[side]
            store[piece] = got
        return got

    def agree(self, a: str, b: str) -> bool:
        """Whether b may follow a: nothing merges over the border while both are made."""
        got = self._agree.get((a, b))
        if got is None:
            got = True
            for x, made_x, gone_x in self._edge(a, 1):
                for y, made_y, gone_y in self._edge(b, 0):
                    if max(made_x, made_y) < min(gone_x, gone_y):
                        c = self.rank.get(x + y)
                        if c is not None and c < gone_x and c <= gone_y:
                            got = False
            if len(self._agree) > 4_000_000:
                self._agree.clear()
            self._agree[a, b] = got
        return got

    def prefixes(self, word: str, last: list, count: list, known: int = 0) -> None:
        """Fill last piece and count for every prefix of a word, from the first ``known`` on."""
        del last[known + 1 :], count[known + 1 :]
        whole, agree = self.whole, self.agree
        for i in range(known + 1, len(word) + 1):
            for j in range(max(0, i - self.longest), i):
                p = word[j:i]
                if p in whole and (last[j] is None or agree(last[j], p)):
                    last.append(p)
                    count.append(count[j] + 1)
                    break
            else:
                last.append(None)
                count.append(count[i - 1] + (len(word[i - 1].encode()) if self.bytes else 1))

    def learn(self, words: set[str]) -> None:
        """Store the counts of all prefixes of words; neighbours in sorted order share beginnings."""
        memo = self.memo
        new = sorted(w for w in words if w not in memo)
        if len(memo) + len(new) > MEMO_WORDS:
            memo.clear()
            new = sorted(words)
        last, count, before = [None], [0], ""
        for w in new:
            n, top = 0, min(len(w), len(before))
            while n < top and w[n] == before[n]:
                n += 1
            self.prefixes(w, last, count, n)
            memo[w] = bytes(count[1:]) if count[-1] < 256 else tuple(count[1:])
            before = w

    def chunks(self, text: str) -> list[str]:
        return self.chunk.findall(MARK + text.replace(" ", MARK)) if text else []

    def all_prefixes(self, text: str) -> list[int]:
        """Tokens of text[:i] for i from 0 to its length; a prefix's own dummy mark is counted."""
        out, done = [0], 0
        for k, w in enumerate(self.chunks(text)):
            last, count = [None], [0]
            self.prefixes(w, last, count)
            skip = 1 if k == 0 else 0  # the mark put before the text is no character of it
            out.extend(done + c for c in count[1 + skip :])
            done += count[-1]
        return out


_counters: dict[PieceTable, PrefixCounter] = {}


def counter(table: PieceTable) -> PrefixCounter:
    """One counter for each table and Python worker; its memo is bounded and outlives a task."""
    if table not in _counters:
        _counters.clear()
        _counters[table] = PrefixCounter(table)
    return _counters[table]


def token_counts(docs: DataFrame, table: PieceTable, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit, keep_chars: the exact counts of whole texts.

    keep_chars is the length of the longest prefix of at most ``limit`` tokens.  Null and empty texts
    have 0 bytes and 0 tokens; each input row gives one row, so repeated rows repeat; columns other
    than doc_id and text are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(shared.value)
        for batch in slices(batches, limit=8 << 20):  # more words at once share more beginnings
            texts = batch.column("text").to_pylist()
            split = [own.chunks(t) for t in texts]
            own.learn({w for ws in split for w in ws})
            memo = own.memo
            tokens = [sum([memo[w][-1] for w in ws]) for ws in split]
            keep = [len(t) if n <= limit else cut(own, t, ws, limit) for t, ws, n in zip(texts, split, tokens, strict=True)]
            yield pa.record_batch([batch.column("doc_id"), pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(tokens, pa.int64()), pa.array([n > limit for n in tokens]), pa.array(keep, pa.int64())], names=["doc_id", "n_bytes", "n_tokens", "over_limit", "keep_chars"])

    return id_text(docs).mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean, keep_chars long")


def cut(own: PrefixCounter, text: str, words: list[str], limit: int) -> int:
    """Characters of the longest prefix with at most ``limit`` tokens, read off the stored counts of its words' prefixes."""
    best = chars = done = 0
    for k, w in enumerate(words):
        if done > limit + 4 * own.longest:
            break
        stored = own.memo[w]
        if done + 4 * len(w) <= limit:  # no character takes more than four tokens
            best = chars + len(w)
        else:
            best = max([best, *(chars + i for i, c in enumerate(stored, 1) if done + c <= limit)])
        chars += len(w)
        done += stored[-1]
    return max(0, best - 1)  # the mark before the text


def prefix_counts(docs: DataFrame, table: PieceTable) -> DataFrame:
    """doc_id, counts array<int>: tokens of text[:i] for every i, for questions of any budget."""
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(shared.value)
        for batch in slices(batches):
            yield pa.record_batch([batch.column("doc_id"), pa.array([own.all_prefixes(t) for t in batch.column("text").to_pylist()], pa.list_(pa.int32()))], names=["doc_id", "counts"])

    return id_text(docs).mapInArrow(run, "doc_id long, counts array<int>")


def within_budget(prefixes: DataFrame, budget: int) -> DataFrame:
    """doc_id, chars: the longest prefix of at most ``budget`` tokens, read off stored counts."""
    at = F.transform("counts", lambda c, i: F.when(c <= budget, i).otherwise(0))
    return prefixes.select("doc_id", F.array_max(at).cast("long").alias("chars"))
