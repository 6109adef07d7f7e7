"""Hashes of all fixed-length byte windows of many texts at once.

Texts are laid end to end in chunks of bounded size (a longer text is cut into slices that overlap by one window), and
prefix sums of a polynomial hash give the hash of any window by one subtraction and one product, modulo 2**64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

CHUNK = 1 << 17
#: Low bits of a comparison key that hold a position in the chunk.
PLACE_BITS = 19
_SIZE = (1 << PLACE_BITS) + 1
_tables: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _table(family: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers for the byte values, powers of an odd base, and powers of its inverse."""
    if family not in _tables:
        values = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(family))
        base = int(mixed(np.array([977 + family], np.uint64))[0]) | 1
        powers = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(_SIZE, b, np.uint64)
            p[0] = 1
            powers.append(np.multiply.accumulate(p))
        _tables[family] = (values, *powers)
    return _tables[family]


class Hashes:
    """Window hashes of one chunk of bytes."""

    def __init__(self, data: np.ndarray, family: int) -> None:
        values, self.powers, self.inverse = _table(family)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(values[data] * self.powers[: len(data)], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self.sums[ends] - self.sums[starts]) * self.inverse[starts])

    def every(self, length: int) -> np.ndarray:
        """Of the windows at all starts."""
        n = len(self.sums) - length
        return mixed((self.sums[length:] - self.sums[:n]) * self.inverse[:n])


def sliding_min(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive keys."""
    span = 1
    while 2 * span <= width:
        keys = np.minimum(keys[:-span], keys[span:])
        span *= 2
    return np.minimum(keys[: len(keys) - (width - span)], keys[width - span :]) if width > span else keys


def chunks(texts: list[bytes], window: int, size: int = CHUNK) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, item's text, item's place in the chunk, item's start in its text) for chunks that hold all windows once.

    An item is a text, or a slice of one; texts shorter than ``window`` have no windows and are left out.
    """
    parts: list[bytes] = []
    items: list[tuple[int, int, int]] = []
    held = 0
    for k, text in enumerate(texts):
        for at in range(0, max(0, len(text) - window + 1), size):
            part = text[at : at + size + window - 1]
            parts.append(part)
            items.append((k, held, at))
            held += len(part)
            if held >= size:
                yield np.frombuffer(b"".join(parts), np.uint8), *np.array(items, np.int64).T
                parts, items, held = [], [], 0
    if parts:
        yield np.frombuffer(b"".join(parts), np.uint8), *np.array(items, np.int64).T


def window_runs(texts: list[bytes], window: int, block: int) -> tuple[np.ndarray, ...]:
    """All windows of the texts, in runs that share their anchor.

    A window's anchor is the ``block`` bytes inside it whose hash is least (the leftmost of equals), so that equal windows
    have equal anchors at equal distances. Returns arrays: text, start, length of the run (windows), anchor hash, the hash of
    all bytes that the run's windows cover, and the distance from the run's start to its anchor.
    """
    out: list[tuple[np.ndarray, ...]] = []
    width = window - block + 1
    for data, text, place, start in chunks(texts, window):
        first, second = Hashes(data, 1), Hashes(data, 2)
        blocks = first.every(block)
        low = np.uint64((1 << PLACE_BITS) - 1)
        anchors = sliding_min((blocks & ~low) | np.arange(len(blocks), dtype=np.uint64), width) & low
        ends = np.append(place[1:], len(data)) - window + 1  # behind the last start of each item
        edge = np.zeros(len(anchors) + 1, np.int8)
        edge[place] += 1
        edge[ends] -= 1
        valid = np.cumsum(edge[:-1], dtype=np.int8).astype(bool)
        new = valid.copy()
        new[1:] &= ~valid[:-1] | (anchors[1:] != anchors[:-1])
        begin = np.flatnonzero(new)
        item = np.searchsorted(place, begin, side="right") - 1
        stop = np.minimum(np.append(begin[1:], len(anchors)), ends[item])
        out.append((text[item], begin - place[item] + start[item], stop - begin, blocks[anchors[begin]].view(np.int64), second.of(begin, stop + window - 1).view(np.int64), anchors[begin].astype(np.int64) - begin))
    if not out:
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def pieces(text: bytes, edges: tuple[np.ndarray, np.ndarray] | None, run: dict, window: int, width: int) -> list[tuple[int, int, int, int, int]]:
    """(key, content, start, n, lead) of a run's windows, cut by their distance from the anchor into ranges of ``width``.

    All windows of a range share a core around the anchor, which stands in for it: equal windows have equal cores at equal
    distances. ``edges`` are the first and last byte of each position where positions are not bytes.
    """
    begin = (lambda at: int(edges[0][at])) if edges else int
    end = (lambda at: int(edges[1][at])) if edges else (lambda at: at + 1)
    first, n, lead = run["start"], run["n"], run["lead"]
    base = begin(first)
    data = np.frombuffer(text, np.uint8, end(first + n + window - 2) - base, base)
    cores, contents = Hashes(data, 5), Hashes(data, 6)
    out = []
    for k in range(lead // width, (lead - n + 1) // width - 1, -1):
        a, z = first + lead - min(lead, k * width + width - 1), first + lead - max(lead - n + 1, k * width)
        core = first + lead - k * width  # the last window's start; the first window ends width - 1 before its end
        own = cores.of(np.array([begin(core) - base]), np.array([end(core - width + window) - base]))
        key = mixed(own ^ mixed(np.array([run["anchor"] + k], np.int64).view(np.uint64)))
        content = contents.of(np.array([begin(a) - base]), np.array([end(z + window - 1) - base]))
        out.append((int(key.view(np.int64)[0]), int(content.view(np.int64)[0]), a, z - a + 1, core - a))
    return out
