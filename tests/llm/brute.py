"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict


def removed(texts: dict[int, bytes], length: int, keep: str = "none") -> dict[int, list[bool]]:
    """For each text, in order of id, whether each byte goes."""
    where = defaultdict(list)
    for d in sorted(texts):
        for i in range(len(texts[d]) - length + 1):
            where[texts[d][i : i + length]].append((d, i))
    gone = {d: [False] * len(t) for d, t in texts.items()}
    for places in where.values():
        for d, i in places[keep == "first" :] if len(places) > 1 else []:
            gone[d][i : i + length] = [True] * length
    return gone


def removed_words(texts: dict[int, bytes], length: int) -> dict[int, list[bool]]:
    """For each text, whether each byte goes with a later copy of ``length`` words."""
    spans = {d: [m.span() for m in re.finditer(rb"[^ \t-\r]+", t)] for d, t in texts.items()}
    where = defaultdict(list)
    for d in sorted(texts):
        for i in range(len(spans[d]) - length + 1):
            a, z = spans[d][i][0], spans[d][i + length - 1][1]
            where[texts[d][a:z]].append((d, i))
    hit = defaultdict(set)
    for places in where.values():
        for d, i in places[1:]:
            hit[d].update(range(i, i + length))
    gone = {d: [False] * len(t) for d, t in texts.items()}
    for d, at in hit.items():
        for i in at:
            a, z = spans[d][i][0], spans[d][i + 1][0] if i + 1 in at else spans[d][i][1]
            gone[d][a:z] = [True] * (z - a)
    return gone


def cut(texts: dict[int, bytes], length: int, keep: str = "none") -> dict[int, tuple[int, int, int, str]]:
    out = {}
    for d, flags in removed(texts, length, keep).items():
        left = bytes(c for c, f in zip(texts[d], flags, strict=True) if not f)
        spans = sum(f and not (i and flags[i - 1]) for i, f in enumerate(flags))
        out[d] = (len(flags), sum(flags), spans, hashlib.sha256(left).hexdigest())
    return out


def shingles(text: str | None, n: int = 5) -> frozenset[bytes]:
    words = (text or "").encode().lower().split()
    return frozenset(b" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))) if words else frozenset()


def components(texts: dict[int, str | None], percent: int = 80) -> dict[int, tuple[int, int]]:
    sets = {d: shingles(t) for d, t in texts.items()}
    root = {d: d for d in sets}

    def find(d: int) -> int:
        while root[d] != d:
            d = root[d]
        return d

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: (len(s), find(d)) for d, s in sets.items()}
