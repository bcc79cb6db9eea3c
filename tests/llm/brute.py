"""Plain Python versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from zlib import crc32

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lowered(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def removed(docs: list[tuple], size: int = 50) -> list[tuple]:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256)."""
    first: dict[bytes, float] = {}
    key = lambda i: math.inf if i is None else i
    raw = [(i, (t or "").encode()) for i, t in docs]
    for i, t in raw:
        for p in range(len(t) - size + 1):
            w = t[p : p + size]
            first[w] = min(first.get(w, math.inf), key(i))
    found = []
    for i, t in raw:
        gone = np.zeros(len(t), bool)
        for p in range(len(t) - size + 1):
            if first[t[p : p + size]] < key(i):
                gone[p : p + size] = True
        spans = int((gone & ~np.append(False, gone[:-1])).sum()) if len(t) else 0
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        found.append((i, len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return found


def shingles(text: str | None, size: int = 5) -> set:
    w = WORD.findall(lowered(text or ""))
    if not w:
        return set()
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))}


def roots(count: int, pairs) -> list[int]:
    parent = list(range(count))

    def top(v: int) -> int:
        while parent[v] != v:
            v = parent[v]
        return v

    for a, b in pairs:
        a, b = top(a), top(b)
        parent[max(a, b)] = min(a, b)
    return [top(v) for v in range(count)]


def near(docs: list[tuple], similarity: int = 85) -> list[tuple]:
    """(doc_id, n_shingles, component_id, kept); ids are distinct."""
    docs = sorted(docs)
    sets = [shingles(t) for _, t in docs]
    pairs = []
    for a in range(len(sets)):
        for b in range(a):
            if sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= similarity * len(sets[a] | sets[b]):
                    pairs.append((a, b))
    root = roots(len(docs), pairs)
    return [(docs[i][0], len(sets[i]), docs[root[i]][0], root[i] == i) for i in range(len(docs))]


def jaccard(a: str, b: str) -> float:
    x, y = Counter(WORD.findall(a)), Counter(WORD.findall(b))
    whole = sum((x | y).values())
    return sum((x & y).values()) / whole if whole else 1.0


def fold(doc_id, folds: int) -> int:
    return -1 if doc_id is None else crc32(str(doc_id).encode()) % folds


def base_scores(docs: list[tuple]) -> dict:
    """doc_id: (n_tokens, n_known, train_tokens, base_score)."""
    tokens = {i: [*WORD.findall(lowered(t or "")), None] for i, t in docs}
    counts = Counter(w for i, ws in tokens.items() if fold(i, 7) != 2 for w in ws)
    total, distinct = sum(counts.values()), len(counts)
    score = lambda w: math.log10((counts[w] + 1) / (total + 1 * (distinct + 1)))
    return {i: (len(ws), sum(counts[w] > 0 for w in ws), total, sum(map(score, ws))) for i, ws in tokens.items()}
