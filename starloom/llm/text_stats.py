"""Counts over the words and lines of single texts, shared by the quality operators."""

from __future__ import annotations

import re

import numpy as np

from starloom.llm.common import WORD

words_in = re.compile(WORD).findall
has_word = re.compile(WORD).search
#: The characters that count as symbols.
SYMBOLS = "#*$%&|<>"
WINDOW = 5


def repeated_words(ids: list[int], n_distinct: int, k: int = WINDOW) -> int:
    """Words that lie in a window of k words found at least twice in the text."""
    n = len(ids)
    if n <= k or n_distinct == n:
        return 0
    a = np.array(ids, dtype=np.int64)
    code, width = a[: n - k + 1], n_distinct
    for i in range(1, k):
        nxt = a[i : n - k + 1 + i]
        if width > (1 << 62) // n_distinct:
            uniq, code = np.unique(code, return_inverse=True)
            width = len(uniq)
        code = code * n_distinct + nxt
        width *= n_distinct
    order = np.argsort(code, kind="stable")
    run = code[order]
    same = run[1:] == run[:-1]
    if not same.any():
        return 0
    twice = np.zeros(len(code), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    step = np.zeros(n + 1, dtype=np.int64)
    step[: n - k + 1] += twice
    step[k:] -= twice
    return int((np.cumsum(step)[:n] > 0).sum())


def base_counts(text: str) -> tuple[list[str], int, int, int, int]:
    """(words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of one text."""
    words = words_in(text)
    number: dict[str, int] = {}
    ids = [number.setdefault(w, len(number)) for w in words]
    symbols = sum(map(text.count, SYMBOLS))
    seen: set[str] = set()
    dup = 0
    if "\n" in text:
        for line in text.split("\n"):
            if line in seen:
                dup += has_word(line) is not None
            else:
                seen.add(line)
    return words, len(text) - sum(map(text.count, " \t\n\v\f\r")), symbols, dup, repeated_words(ids, len(number))


LINE_FEATURES = ("one", "short", "symbols", "upper", "bangs", "bars", "digits", "repeated", "stuttered", "seen", "stop", "markup")


def line_features(line: str, seen: bool) -> list[float]:
    """What the line labeller looks at, each from 0 to 1, in the order of LINE_FEATURES."""
    words = words_in(line)
    n = len(words) or 1
    chars = len(line) or 1
    bars, bangs = line.count("|"), line.count("!")
    symbols = sum(map(line.count, SYMBOLS))
    upper = sum(map(str.isupper, words))
    digits = sum(map(str.isdigit, line)) if any(d in line for d in "0123456789") else 0
    stutter = sum(a == b for a, b in zip(words, words[1:], strict=False))
    repeat = 1 - len(set(words)) / n if n >= 20 else 0.0
    return [1.0, float(n < 5), min(1.0, 2 * symbols / n), upper / n, min(1.0, 2 * bangs / n), min(1.0, 4 * bars / n), min(1.0, 5 * digits / chars), max(0.0, 2 * repeat - 1), min(1.0, 2 * stutter / n), float(seen), float(line.rstrip().endswith((".", "!", "?", ":", ";", '"', "”"))), float("</" in line or "http" in line)]


DOC_FEATURES = ("one", "few", "length", "symbols", "upper", "bangs", "bars", "digits", "dup_lines", "repeats", "stuttered", "distinct", "word_length", "stops", "any_symbols", "any_upper", "any_repeats", "short_lines")


def doc_features(text: str) -> list[float]:
    """Features of a whole text for the quality score, each from 0 to 1, in the order of DOC_FEATURES."""
    words, word_chars, symbols, dup, repeat = base_counts(text)
    n, chars = len(words) or 1, len(text) or 1
    lines = text.count("\n") + 1
    upper = sum(map(str.isupper, words)) / n
    digits = sum(map(text.count, "0123456789"))
    stutter = sum(a == b for a, b in zip(words, words[1:], strict=False))
    share, rep = symbols / n, repeat / n
    return [
        1.0, float(len(words) < 10), min(1.0, np.log1p(n) / 10), min(1.0, share), upper, min(1.0, text.count("!") / n), min(1.0, 2 * text.count("|") / n), min(1.0, 5 * digits / chars),
        min(1.0, dup / lines), rep, min(1.0, 2 * stutter / n), min(1.0, len(set(words)) / n ** 0.8), min(1.0, word_chars / n / 12), min(1.0, 5 * text.count(".") / n),
        min(1.0, 10 * share), min(1.0, 10 * max(0.0, upper - 0.05)), min(1.0, 4 * max(0.0, rep - 0.05)), min(1.0, lines / n * 4),
    ]

