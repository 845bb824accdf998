"""Plain statements of the rules that the text operators follow, for comparison on small inputs."""

from __future__ import annotations

import hashlib
import re

WORDS = re.compile(r"[^\x20\x09-\x0D]+").findall


def repeats(texts: dict[int, str], length: int = 13) -> dict[int, tuple[int, int, str]]:
    """doc_id -> (n_words, n_removed, kept_sha256)."""
    first: dict[tuple, int] = {}
    split = {i: WORDS(t or "") for i, t in texts.items()}
    for i in sorted(split):
        for j in range(len(split[i]) - length + 1):
            first.setdefault(tuple(split[i][j : j + length]), i)
    out = {}
    for i, ws in split.items():
        gone = {j + k for j in range(len(ws) - length + 1) if first[tuple(ws[j : j + length])] < i for k in range(length)}
        out[i] = (len(ws), len(gone), hashlib.sha256(" ".join(w for j, w in enumerate(ws) if j not in gone).encode()).hexdigest())
    return out


def one_edit(a: list[str], b: list[str]) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def line_dedup(texts: dict[int, str], least: int = 8) -> dict[int, str]:
    lines = [(i, j, WORDS(line)) for i in sorted(texts) for j, line in enumerate((texts[i] or "").split("\n"))]
    out: dict[int, list[str]] = {i: [] for i in texts}
    before: list[list[str]] = []
    for i, j, ws in lines:
        raw = (texts[i] or "").split("\n")[j]
        if not ws:
            out[i].append(raw)
            continue
        if not any(ws == o or min(len(ws), len(o)) >= least and one_edit(ws, o) for o in before):
            out[i].append(raw)
        before.append(ws)
    return {i: "\n".join(v) for i, v in out.items()}


def shingles(text: str, k: int = 5) -> frozenset:
    ws = WORDS(text or "")
    return frozenset(tuple(ws[i : i + k]) for i in range(len(ws) - k + 1)) if len(ws) >= k else frozenset([tuple(ws)] if ws else [])


def jaccard_classes(texts: dict[int, str], least: float = 0.8) -> dict[int, tuple[int, int]]:
    """doc_id -> (least doc_id of its class, number of other shingle sets it is linked to)."""
    sets: dict[frozenset, list[int]] = {}
    for i, t in texts.items():
        s = shingles(t)
        sets.setdefault(s if s else frozenset([("none", i)]), []).append(i)
    keys = list(sets)
    up = list(range(len(keys)))

    def root(x: int) -> int:
        while up[x] != x:
            x = up[x]
        return x

    links = [0] * len(keys)
    for x in range(len(keys)):
        for y in range(x):
            if len(keys[x] & keys[y]) >= least * len(keys[x] | keys[y]):
                links[x] += 1
                links[y] += 1
                up[root(x)] = root(y)
    low: dict[int, int] = {}
    for x, k in enumerate(keys):
        low[root(x)] = min(low.get(root(x), 1 << 60), *sets[k])
    return {i: (low[root(x)], links[x]) for x, k in enumerate(keys) for i in sets[k]}
