"""Token counts that follow edits: a segment tree of pre-tokens per document.

The leaves of a document's tree are its pre-tokens with their lengths and token counts; an inner node holds the sums of its
two children. An edit finds its leaves by descending the tree, widens the region to boundaries that no pre-token can cross
before or after the edit, re-encodes that region alone, puts the result into the region's first leaf and updates the sums
on the way up. Trees travel as plain array columns, so they can be stored and edited again later.

Defined cases: a null text is an empty one; null edits are none; an edit beyond the text's end is clipped to it; repeated
rows are counted each; very long texts have proportionally large trees; an empty table gives no rows; other columns are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tessel.llm import bpe

#: Pre-tokens whose counts a worker remembers, and the longest of them; beyond that it forgets all and starts anew.
REMEMBERED, REMEMBERED_CHARS = 200_000, 64


class Counter:
    """Splits a text into pre-tokens and counts the ids of each."""

    def __init__(self, ranks_file: str) -> None:
        self.encoder = bpe.encoder(ranks_file)
        self.pieces = bpe.pre_tokens().findall
        self.known: dict[str, int] = {}

    def split(self, text: str) -> tuple[list[str], list[int]]:
        pieces = self.pieces(text)
        if len(self.known) > REMEMBERED:
            self.known.clear()
        known = self.known
        rare: dict[str, int] = {}
        for piece in set(pieces).difference(known):
            (known if len(piece) <= REMEMBERED_CHARS else rare)[piece] = len(self.encoder._encode_single_piece(piece))
        return pieces, [known[p] if p in known else rare[p] for p in pieces]


class Tree:
    """Sums of leaf lengths (characters) and counts (ids) over a complete binary tree; ``levels[0]`` are the leaves."""

    def __init__(self, lengths: list[int], counts: list[int]) -> None:
        level = np.zeros((max(1, len(lengths)), 2), np.int64)
        if lengths:
            level[:, 0], level[:, 1] = lengths, counts
        self.levels = [level]
        while len(level) > 1:
            if len(level) % 2:
                level = np.vstack([level, np.zeros((1, 2), np.int64)])
                self.levels[-1] = level
            level = level[0::2] + level[1::2]
            self.levels.append(level)

    @property
    def tokens(self) -> int:
        return int(self.levels[-1][0, 1])

    @property
    def chars(self) -> int:
        return int(self.levels[-1][0, 0])

    def leaf_at(self, char: int) -> tuple[int, int]:
        """The leaf that holds character ``char``, and the leaf's first character."""
        node, before = 0, 0
        for level in reversed(self.levels[:-1]):
            node *= 2
            size = int(level[node, 0])
            if char - before >= size and node + 1 < len(level):
                before += size
                node += 1
        return node, before

    def replace(self, first: int, last: int, length: int, count: int) -> None:
        """Give leaf ``first`` these values, clear those up to ``last``, and renew the sums above."""
        self.levels[0][first : last + 1] = 0
        self.levels[0][first] = length, count
        for below, level in zip(self.levels, self.levels[1:], strict=False):
            first, last = first // 2, last // 2
            level[first : last + 1] = below[2 * first : 2 * last + 2 : 2] + below[2 * first + 1 : 2 * last + 2 : 2]


def _left(text: str, at: int) -> int:
    """The last safe boundary whose own characters lie before ``at``."""
    while at > 0:
        at = text.rfind(" ", 0, at - 1)
        if at <= 0:
            return 0
        if not text[at - 1].isspace() and not text[at + 1].isspace():
            return at
    return 0


def _right(text: str, at: int) -> int:
    """The first safe boundary whose preceding character lies at or after ``at``."""
    found = bpe.SAFE.search(text, at + 1) if at + 1 < len(text) else None
    return found.start() if found else len(text)


def edit(tree: Tree, text: str, counter: Counter, start: int, removed: int, inserted: str) -> tuple[str, int]:
    """Apply one edit to the tree; returns the new text and the characters that were encoded anew."""
    start = min(max(0, start), len(text))
    end = min(len(text), start + max(0, removed))
    a, b = _left(text, start), _right(text, end)
    first, a = tree.leaf_at(a)  # a leaf that an earlier edit made of several pre-tokens is taken whole
    last = len(tree.levels[0])
    if b < len(text):
        last, begins = tree.leaf_at(b)
        if begins < b:
            b = begins + int(tree.levels[0][last, 0])
            last += 1
    anew = text[a:start] + inserted + text[end:b]
    tree.replace(first, last - 1, len(anew), sum(counter.split(anew)[1]))
    return text[:start] + inserted + text[end:], len(anew)


def counted(df: DataFrame, key: str, text: str, edits: str, ranks_file: str) -> DataFrame:
    """Counts before and after the edits, applied in order.

    ``edits`` is an array of structs (start, removed, inserted) over code points of the text as edited so far. Per input row:
    key, n_tokens, n_tokens_edited, n_edits, n_chars_edited, n_chars_anew (characters encoded again), n_leaves.
    """
    schema = "key long, n_tokens long, n_tokens_edited long, n_edits long, n_chars_edited long, n_chars_anew long, n_leaves long"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(ranks_file)
        for b in batches:
            rows = []
            for key_, value, changes in zip(b.column(0).to_pylist(), b.column(1), b.column(2), strict=True):
                now = value.as_py() or ""
                pieces, counts = counter.split(now)
                tree = Tree(list(map(len, pieces)), counts)
                before, anew, n = tree.tokens, 0, 0
                for c in changes.as_py() or []:
                    if c is not None:
                        now, size = edit(tree, now, counter, c["start"] or 0, c["removed"] or 0, c["inserted"] or "")
                        anew, n = anew + size, n + 1
                rows.append((key_, before, tree.tokens, n, tree.chars, anew, len(pieces)))
            columns = list(zip(*rows, strict=True)) or [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=[c.split()[0] for c in schema.split(", ")])

    return df.select(df[key].cast("long").alias("key"), df[text].alias("text"), df[edits].alias("edits")).mapInArrow(work, schema)


def trees(df: DataFrame, key: str, text: str, ranks_file: str) -> DataFrame:
    """The trees as columns, to be stored: key, lengths and counts (arrays by leaf), n_tokens."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(ranks_file)
        for b in batches:
            for i in range(0, len(b), 64):
                part = b.slice(i, 64)
                split = [counter.split(v.as_py() or "") for v in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([list(map(len, p)) for p, _ in split], pa.list_(pa.int32())), pa.array([c for _, c in split], pa.list_(pa.int32())), pa.array([sum(c) for _, c in split], pa.int64())], names=["key", "lengths", "counts", "n_tokens"])

    return df.select(df[key].cast("long").alias("key"), df[text].alias("text")).mapInArrow(work, "key long, lengths array<int>, counts array<int>, n_tokens long")
