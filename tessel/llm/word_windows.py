"""Hashes of all windows of a fixed number of words, byte for byte, as ``windows`` has them for a number of bytes.

A window goes from the first byte of its first word to the last of its last one, so that equal windows have equal white space
inside. Positions count words. Words and white space of over ``LONG`` bytes are hashed by a digest that stands for them, of the
same kind, so that a window fits in a chunk whatever the text holds.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import xxhash

from tessel.llm.jaccard_join import _words
from tessel.llm.windows import CHUNK, PLACE_BITS, Hashes, sliding_min

LONG = 2048
_LONG = re.compile(rb"[^ \t-\r]{%d,}|[ \t-\r]{%d,}" % (LONG, LONG))


def _digest(match: re.Match) -> bytes:
    digest = xxhash.xxh3_128_hexdigest(match[0])
    return f"{int(digest, 16):0128b}".translate({48: " ", 49: "\t"}).encode() if match[0][:1].isspace() else digest.encode()


def word_edges(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of a text begin and end."""
    return _words(np.frombuffer(text, np.uint8))


def view(text: bytes) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The text with its long parts replaced, and where its words begin and end; their numbers stay."""
    text = _LONG.sub(_digest, text) if len(text) >= LONG else text
    return text, *word_edges(text)


def _chunks(texts: list[bytes], window: int, size: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, begins and ends of words, item's text, item's first word in the chunk and in its text); all windows once."""
    parts: list[bytes] = []
    edges: list[tuple[np.ndarray, np.ndarray]] = []
    items: list[tuple[int, int, int]] = []
    held = count = 0
    for k, whole in enumerate(texts):
        text, begin, end = view(whole)
        at = 0
        while at + window <= len(begin):
            stop = max(at + window, int(np.searchsorted(end, begin[at] + size, side="right")))
            part = text[begin[at] : end[stop - 1]]
            parts.append(part)
            edges.append((begin[at:stop] - begin[at] + held, end[at:stop] - begin[at] + held))
            items.append((k, count, at))
            held, count, at = held + len(part) + 1, count + stop - at, stop - window + 1
            if held >= size:
                yield np.frombuffer(b" ".join(parts), np.uint8), *(np.concatenate(x) for x in zip(*edges, strict=True)), *np.array(items, np.int64).T
                parts, edges, items, held, count = [], [], [], 0, 0
    if parts:
        yield np.frombuffer(b" ".join(parts), np.uint8), *(np.concatenate(x) for x in zip(*edges, strict=True)), *np.array(items, np.int64).T


def window_runs(texts: list[bytes], window: int, block: int, size: int = CHUNK) -> tuple[np.ndarray, ...]:
    """As ``windows.window_runs``, with ``window`` and ``block`` in words."""
    out: list[tuple[np.ndarray, ...]] = []
    low = np.uint64((1 << PLACE_BITS) - 1)
    for data, left, right, text, place, start in _chunks(texts, window, size):
        first, second = Hashes(data, 1), Hashes(data, 2)
        blocks = first.of(left[: len(left) - block + 1], right[block - 1 :])
        anchors = (sliding_min((blocks & ~low) | np.arange(len(blocks), dtype=np.uint64), window - block + 1) & low).astype(np.int64)
        ends = np.append(place[1:], len(left)) - window + 1  # behind the last start of each item
        edge = np.zeros(len(anchors) + 1, np.int8)
        edge[place] += 1
        edge[ends] -= 1
        valid = np.cumsum(edge[:-1], dtype=np.int8).astype(bool)
        new = valid.copy()
        new[1:] &= ~valid[:-1] | (anchors[1:] != anchors[:-1])
        new[place] = True
        begin = np.flatnonzero(new)
        item = np.searchsorted(place, begin, side="right") - 1
        stop = np.minimum(np.append(begin[1:], len(anchors)), ends[item])
        out.append((text[item], begin - place[item] + start[item], stop - begin, blocks[anchors[begin]].view(np.int64), second.of(left[begin], right[stop + window - 2]).view(np.int64), anchors[begin] - begin))
    if not out:
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))
