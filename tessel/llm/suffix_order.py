"""Longest-previous-factor arrays over a group of strings, by their suffixes in order.

A group holds covers: pieces of texts, each with the windows that begin in it. The windows are suffixes cut off at the length
that counts. They are sorted by their bytes, neighbours in that order are compared for their longest common prefix (LCP), and
one stack pass finds for each suffix the nearest ones before and behind it in the order that begin at an earlier position. The
longer of the two common prefixes is its longest previous factor (LPF).
"""

from __future__ import annotations

import numpy as np

#: Suffixes whose bytes are compared at once.
ROWS = 4096


def neighbours(data: bytes, starts: np.ndarray, lengths: np.ndarray, sealed: bool) -> np.ndarray:
    """LCP of each suffix with the one before it (0 for the first), the suffixes being given in order.

    No suffix reaches beyond its length. With ``sealed`` each ends with a mark of its own, which counts as one byte more, so
    that a string is never alike to a longer one.
    """
    out = np.zeros(len(starts), np.int64)
    words = -(-int(lengths.max(initial=1)) // 8)
    padded = np.frombuffer(data + bytes(8 * words + 8), np.uint8)
    eights = np.ndarray(len(padded) - 7, "<u8", padded.data, 0, (1,))
    for at in range(1, len(starts), ROWS):
        rows = slice(at - 1, min(at + ROWS, len(starts)))
        found = eights[starts[rows, None] + 8 * np.arange(words)]
        apart = found[1:] ^ found[:-1]
        first = (apart != 0).argmax(1)
        bits = apart[np.arange(len(apart)), first]
        low = np.log2((bits & (~bits + np.uint64(1))).astype(np.float64), where=bits != 0, out=np.full(len(bits), 64.0)).astype(np.int64)
        reach = np.where(bits != 0, 8 * first + low // 8, 8 * words)
        own, before = lengths[rows][1:], lengths[rows][:-1]
        reach = np.minimum(reach, np.minimum(own, before))
        out[at : rows.stop] = reach + (sealed & (reach == own) & (own == before))
    return out


def previous_factors(order: list[int], lcp: list[int]) -> list[int]:
    """LPF of each position, from the positions in suffix order and the LCP of each with its predecessor there.

    The stack holds positions that grow from bottom to top: what lies beneath an entry is its previous smaller position, kept
    with the LCP to it. An entry is taken off by its next smaller position.
    """
    out = [0] * len(order)
    stack: list[tuple[int, int]] = []
    for here, reach in zip(order, lcp, strict=True):
        while stack and stack[-1][0] > here:
            there, back = stack.pop()
            out[there] = back if back > reach else reach
            reach = back if back < reach else reach
        stack.append((here, reach if stack else 0))
    for there, back in stack:
        out[there] = back
    return out


def repeated(covers: list[bytes], starts: list[np.ndarray], ends: list[np.ndarray], keep: str, sealed: bool = False) -> list[np.ndarray]:
    """For each cover, whether each of its windows repeats: an earlier one (keep "first") or any other (keep "none").

    Covers come in order of position, and windows in a cover too; a window is the bytes ``starts[k] .. ends[k]`` of its cover.
    """
    texts = [c.decode("latin-1") for c in covers]  # one character a byte, in the order of bytes
    strings = [t[a:b] for t, s, e in zip(texts, starts, ends, strict=True) for a, b in zip(s.tolist(), e.tolist(), strict=True)]
    order = sorted(range(len(strings)), key=strings.__getitem__)
    base = np.cumsum([0, *map(len, covers)])
    begin = np.concatenate([s + b for s, b in zip(starts, base, strict=False)])
    length = np.concatenate([e - s for s, e in zip(starts, ends, strict=True)])
    ranked = np.array(order)
    lcp = neighbours(b"".join(covers), begin[ranked], length[ranked], sealed)
    whole = length + sealed
    again = np.array(previous_factors(order, lcp.tolist())) >= whole
    if keep == "none":  # the first of a class is found by its second member, its neighbour in the order
        second = np.flatnonzero(lcp >= whole[ranked])
        again[ranked[second]] = again[ranked[second - 1]] = True
    return np.split(again, np.cumsum([len(s) for s in starts])[:-1])
