"""Alignment of two tokenizers' tokens of one text.

Both tokenizers end a token at a single blank between characters that are no blanks, so a text is cut there, and a worker aligns
each distinct cut once as long as it remembers it. New cuts are aligned many at a time: of either side the cumulative byte ends are
marked in a table from end to token, the ends that both have (an intersection, in order) slice both id lists into groups, and from
one end of either side to the next lie the bytes that one pair of tokens shares, which is a link. Cuts that are long, end in white
space or hold characters of which libraries differ go one by one: there a dictionary leads from end to index. Documents are then
sums, joins and counts over the codes of their cuts.

How many documents hold a pair is counted over all documents. A task keeps its documents as codes of the pairs of its block; each
block sends each of its pairs once to be counted, and the counts come back and replace the codes. So no group of rows grows with
a pair's frequency but by one row a block, and no link of a document travels twice.

Defined cases: a null or empty text, and one whose joined bytes differ from blank and text on either side, has no tokens, so
zeros and an empty ``groups_sha256``; each row of repeated ones is a document of its own; null keys stay null; an empty table gives
no rows; other columns are not read.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import operator
import re
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tessel.llm import arrow, bpe
from tessel.llm.word_table import byte_letters, has_unlisted, tokenizer
from tessel.plans.stages import sized, written

#: Distinct pairs at which a block ends.
BLOCK_PAIRS = 1 << 18
#: Cuts whose alignment a worker remembers, and bytes of groups and links of them; beyond either it forgets all and starts anew.
REMEMBERED, REMEMBERED_BYTES = 1 << 18, 1 << 26
#: Of longer cuts, in characters, each is aligned by itself.
REMEMBERED_CHARS = 64
#: Cuts that are aligned side by side.
LEARNED_AT_ONCE = 1 << 13
#: Bytes of texts that are taken at once, about; a longer text is taken in parts of so many.
WINDOW_BYTES = 1 << 21

_ALIGNED = "block long, at long, pair long, docs long, key long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, codes array<int>, times array<long>"


@functools.cache
def sentence_pieces(file: str):
    """The sentencepiece model of a file, made once for each Python worker."""
    import public_tokenizers
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(file))


@functools.cache
def piece_bytes(file: str) -> list[bytes]:
    """The bytes of each piece: U+2581 is a blank, <0xHH> one byte."""
    model = sentence_pieces(file)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    return [bytes([int(p[3:5], 16)]) if re.fullmatch(r"<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode() for p in pieces]


@functools.cache
def entry_bytes(file: str) -> list[bytes]:
    """The bytes of each entry of a byte-level tokenizer file."""
    own = byte_letters()
    entries = {i: token for token, i in tokenizer(file).get_vocab(with_added_tokens=False).items()}
    return [bytes(own[c] for c in entries[i]) if i in entries and own.keys() >= {*entries[i]} else b"" for i in range(max(entries) + 1)]


def groups(a: list[int], b: list[int], ends_a: list[int], ends_b: list[int]) -> Iterator[tuple[slice, slice]]:
    """The slices of both lists between the ends that both have."""
    at_a, at_b = {e: i for i, e in enumerate(ends_a)}, {e: i for i, e in enumerate(ends_b)}
    i = j = 0
    for end in sorted(at_a.keys() & at_b.keys()):
        yield slice(i, at_a[end] + 1), slice(j, at_b[end] + 1)
        i, j = at_a[end] + 1, at_b[end] + 1


def links(ends_a: list[int], ends_b: list[int], one: slice, other: slice) -> Iterator[tuple[int, int]]:
    """Positions in both lists, inside two slices of the same bytes, of tokens whose byte ranges overlap."""
    i, j = one.start, other.start
    while i < one.stop and j < other.stop:
        yield i, j
        ea, eb = ends_a[i], ends_b[j]
        i, j = i + (ea <= eb), j + (eb <= ea)


class Aligner:
    """Aligns cuts of texts and remembers them."""

    def __init__(self, file_a: str, ranks_a: str, file_b: str) -> None:
        self.library, self.ranks, self.model = tokenizer(file_a), bpe.encoder(ranks_a), sentence_pieces(file_b)
        self.entries, self.pieces = entry_bytes(file_a), piece_bytes(file_b)
        self.sizes_a, self.sizes_b = list(map(len, self.entries)), list(map(len, self.pieces))
        self.shown_a, self.shown_b = list(map(str, range(len(self.entries)))), list(map(str, range(len(self.pieces))))
        self.bytes_a, self.bytes_b = np.array(self.sizes_a), np.array(self.sizes_b)
        #: How an id is written: the first of its side in a group, a later one, for either side.
        self.written = [sign + x.encode() for signs, shown in ((b";,", self.shown_a), (b"|,", self.shown_b)) for sign in (signs[:1], signs[1:]) for x in shown]
        self.written_bytes = np.array(list(map(len, self.written)))
        self.generation = 0
        self._forget()

    def ids_a(self, cut: str, unlisted: bool) -> list[int]:
        if unlisted and has_unlisted(cut):
            self.library.encode_special_tokens = True
            try:
                return self.library.encode(cut, add_special_tokens=False).ids
            finally:
                self.library.encode_special_tokens = False
        return bpe.encode(self.ranks, cut)

    def aligned(self, cut: str, b: list[int], unlisted: bool = True) -> tuple | None:
        """n_a, n_b, n_groups, the groups as text, the pairs of ids (a << 32 | b) of all links; None if bytes differ.

        A cut begins with the blank that the second tokenizer adds; ``b`` has its ids there. ``unlisted`` says whether ``cut`` may have
        characters that are not in Python's Unicode table.
        """
        a = self.ids_a(cut, unlisted)
        bytes_a, bytes_b, content = [self.entries[i] for i in a], [self.pieces[i] for i in b], cut.encode()
        if not b"".join(bytes_a) == content == b"".join(bytes_b):
            return None
        if len(a) == 1 == len(b):
            return 1, 1, 1, b"%d|%d" % (a[0], b[0]), (a[0] << 32 | b[0],)
        if len(cut) <= REMEMBERED_CHARS and b"" not in bytes_a and b"" not in bytes_b:
            return self._short(a, b)
        ends_a, ends_b = list(itertools.accumulate(map(len, bytes_a))), list(itertools.accumulate(map(len, bytes_b)))
        found, pairs = [], []
        for one, other in groups(a, b, ends_a, ends_b):
            n, m = one.stop - one.start, other.stop - other.start
            if n == m == 1:
                x, y = a[one.start], b[other.start]
                found.append(f"{x}|{y}")
                pairs.append(x << 32 | y)
                continue
            found.append(",".join(map(str, a[one])) + "|" + ",".join(map(str, b[other])))
            if n == 1 or m == 1:  # a single token meets all of the other side
                pairs += [x << 32 | y for x in a[one] for y in b[other]]
            else:
                pairs += [a[i] << 32 | b[j] for i, j in links(ends_a, ends_b, one, other)]
        return len(a), len(b), len(found), ";".join(found).encode(), pairs

    def _short(self, a: list[int], b: list[int]) -> tuple:
        """The same for the ids of a short cut, none of which is empty: both sides are walked once, from end to end."""
        shown_a, shown_b = self.shown_a, self.shown_b
        sizes_a, sizes_b = [self.sizes_a[x] for x in a], [self.sizes_b[y] for y in b]
        found, pairs, n = [], [], len(a)
        i = j = first_i = first_j = 0
        left = sizes_a[0] - sizes_b[0]
        while True:
            x, y = a[i], b[j]
            pairs.append(x << 32 | y)
            if not left:  # both end here
                if i == first_i and j == first_j:
                    found.append(f"{shown_a[x]}|{shown_b[y]}")
                else:
                    found.append(f"{','.join([shown_a[x] for x in a[first_i : i + 1]])}|{','.join([shown_b[y] for y in b[first_j : j + 1]])}")
                i = first_i = i + 1
                j = first_j = j + 1
                if i == n:
                    return n, len(b), len(found), ";".join(found).encode(), tuple(pairs)
                left = sizes_a[i] - sizes_b[j]
            elif left < 0:
                i += 1
                left += sizes_a[i]
            else:
                j += 1
                left -= sizes_b[j]

    def trim(self) -> None:
        """Forgets all cuts once they are many; codes that were given out before hold no longer."""
        if len(self.known) >= REMEMBERED or self.size >= REMEMBERED_BYTES:
            self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.shown: list[bytes] = []
        self.pair_codes: dict[int, int] = {}
        self.numbers, self.first, self.links, self.pairs = np.zeros((1 << 12, 4), np.int64), np.zeros(1 << 12, np.int64), np.zeros(1 << 14, np.int32), np.zeros(1 << 12, np.int64)
        self.size, self.n_links, self.generation = 0, 0, self.generation + 1

    def codes_of(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Each cut's code, which is its place in ``numbers``, ``shown`` and ``first``; cuts not known yet are aligned together."""
        cut = pa.LargeStringArray.from_buffers(len(bounds) - 1, pa.py_buffer(np.ascontiguousarray(bounds, np.int64)), pa.py_buffer(data)).dictionary_encode()
        listed = cut.dictionary.to_pylist()
        own = list(map(self.known.get, listed))
        if None in own:
            self._learn([c for c, k in zip(listed, own) if k is None])
            own = list(map(self.known.__getitem__, listed))
        return np.array(own, np.int64)[cut.indices.to_numpy()]

    def _learn(self, new: list[str]) -> None:
        """Adds distinct cuts: short ones without white space at either end side by side, others one by one."""
        unlisted = has_unlisted("".join(new))
        together, others = [], []
        for c in new:
            (others if len(c) > REMEMBERED_CHARS or (rest := c[1:]).strip() != rest or not rest or (unlisted and has_unlisted(c)) else together).append(c)
        for some in itertools.batched(together, LEARNED_AT_ONCE):
            if not self._learn_together(some, ids := self.model.encode([c[1:] for c in some], num_threads=1)):
                fit = [b"".join([self.pieces[i] for i in b]) == c.encode() for c, b in zip(some, ids)]
                others += itertools.compress(some, map(operator.not_, fit))
                if not (any(fit) and self._learn_together([*itertools.compress(some, fit)], [*itertools.compress(ids, fit)])):
                    others += itertools.compress(some, fit)
        for c, b in zip(others, self.model.encode([c[1:] for c in others], num_threads=1) if others else ()):
            found = self.aligned(c, b, unlisted)
            numbers, shown, pairs = ((*found[:3], len(found[4])), found[3], found[4]) if found else ((0, 0, 0, 0), b"", ())
            self._store([c], np.array([numbers]), [b";" + shown], np.array(pairs, np.int64))

    def _learn_together(self, cuts: Sequence[str], ids_b: Sequence[list[int]]) -> bool:
        """Cuts side by side, at whose joints either tokenizer ends a token; whether they could be aligned so.

        From one end of either side to the next lie the bytes of one pair of overlapping tokens, and common ends close the groups.
        """
        joined = "".join(cuts)
        listed, content = bpe.encode(self.ranks, joined), joined.encode()
        a, b = np.array(listed, np.int64), np.fromiter(itertools.chain.from_iterable(ids_b), np.int64)
        sizes_a, sizes_b = self.bytes_a[a], self.bytes_b[b]
        if not sizes_a.all() or not sizes_b.all() or not b"".join([self.entries[i] for i in listed]) == content == b"".join([self.pieces[i] for i in b.tolist()]):
            return False
        ends = np.cumsum(np.fromiter(map(len, cuts) if len(joined) == len(content) else (len(c.encode()) for c in cuts), np.int64, len(cuts)))
        ends_a, ends_b = np.cumsum(sizes_a), np.cumsum(sizes_b)
        at_a, at_b = np.zeros((2, len(content) + 1), np.bool_)
        at_a[ends_a] = at_b[ends_b] = True
        if not at_a[ends].all() or not np.array_equal(np.append(0, ends_b)[np.cumsum(list(map(len, ids_b)))], ends):
            return False
        both, either = np.flatnonzero(at_a & at_b), np.flatnonzero(at_a | at_b)
        pairs = a[np.searchsorted(ends_a, either)] << 32 | b[np.searchsorted(ends_b, either)]
        upto = np.stack([np.searchsorted(x, ends, "right") for x in (ends_a, ends_b, both, either)], axis=1)
        group_a, group_b = np.searchsorted(both, ends_a), np.searchsorted(both, ends_b)
        later_a, later_b = np.diff(group_a, prepend=-1) == 0, np.diff(group_b, prepend=-1) == 0
        order = np.empty(len(a) + len(b), np.int64)  # a group's tokens of the first side, then those of the second
        order[np.arange(len(a)) + np.searchsorted(group_b, group_a)] = a + later_a * len(self.entries)
        order[np.arange(len(b)) + np.searchsorted(group_a, group_b, "right")] = 2 * len(self.entries) + b + later_b * len(self.pieces)
        shown = b"".join([self.written[k] for k in order.tolist()])
        edges = [0, *np.cumsum(self.written_bytes[order])[upto[:, 0] + upto[:, 1] - 1].tolist()]
        self._store(cuts, np.diff(upto, axis=0, prepend=0), [shown[i:j] for i, j in itertools.pairwise(edges)], pairs)
        return True

    def _store(self, cuts: Iterable[str], numbers: np.ndarray, shown: list[bytes], pairs: np.ndarray) -> None:
        at, end, n = len(self.shown), len(self.shown) + len(shown), self.n_links
        self.known.update(zip(cuts, range(at, end)))
        self.shown += shown
        self.size += sum(map(len, shown)) + 8 * len(pairs)
        values, own = np.unique(pairs, return_inverse=True)
        codes = np.array([self.pair_codes.setdefault(p, len(self.pair_codes)) for p in values.tolist()], np.int64)
        self.numbers, self.first = _grown(self.numbers, end), _grown(self.first, end)
        self.links, self.pairs = _grown(self.links, n + len(pairs)), _grown(self.pairs, len(self.pair_codes))
        self.numbers[at:end] = numbers
        self.first[at:end] = n + np.cumsum(numbers[:, 3]) - numbers[:, 3]
        self.links[n : n + len(pairs)] = codes[own]
        self.pairs[codes] = values
        self.n_links += len(pairs)


def _grown(array: np.ndarray, n: int) -> np.ndarray:
    """``array`` with room for ``n`` rows."""
    return array if n <= len(array) else np.concatenate([array, np.zeros((max(n, 2 * len(array)) - len(array), *array.shape[1:]), array.dtype)])


@functools.cache
def aligner(file_a: str, ranks_a: str, file_b: str) -> Aligner:
    """The aligner of two files, made once for each Python worker, so that a later task finds the cuts of an earlier one."""
    return Aligner(file_a, ranks_a, file_b)


#: White space as numbers, by its length in UTF-8.
_WHITE = [np.array([int.from_bytes(w) for w in map(str.encode, filter(str.isspace, map(chr, range(0x3001)))) if len(w) == n]) for n in (1, 2, 3)]
_IS_WHITE = np.isin(np.arange(256), _WHITE[0])
_MAY_BEGIN = np.isin(np.arange(256), np.concatenate([_WHITE[1] >> 8, _WHITE[2] >> 16]))
_MAY_END = np.isin(np.arange(256), np.concatenate([_WHITE[1] & 255, _WHITE[2] & 255]))


def cut_starts(data: np.ndarray, start: int, end: int) -> np.ndarray:
    """Where, from ``start`` to ``end``, single blanks lie between characters that are no white space (``bpe.SAFE``, on UTF-8)."""
    at = np.flatnonzero(data[start:end] == 32) + start
    at = at[(at > 0) & (at < len(data) - 1)]
    at = at[~(_IS_WHITE[data[at - 1]] | _IS_WHITE[data[at + 1]])]
    unsure = np.flatnonzero(_MAY_END[data[at - 1]] | _MAY_BEGIN[data[at + 1]])
    if len(unsure):
        byte = [data[np.clip(at[unsure] + k, 0, len(data) - 1)].astype(np.int64) for k in (-3, -2, -1, 1, 2, 3)]
        white = [np.isin(x << 8 | y, _WHITE[1]) for x, y in (byte[1:3], byte[3:5])] + [np.isin(x << 16 | y << 8 | z, _WHITE[2]) for x, y, z in (byte[:3], byte[3:])]
        at = np.delete(at, unsure[np.logical_or.reduce(white)])
    return at


def _with_blanks(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts, each behind a blank, and where each begins and the last ends."""
    made = pc.binary_join_element_wise(pa.scalar("", pa.large_string()), texts.cast(pa.large_string()), pa.scalar(" ", pa.large_string()))
    edges = np.frombuffer(made.buffers()[1], np.int64)[made.offset : made.offset + len(made) + 1]
    return np.frombuffer(made.buffers()[2], np.uint8)[: edges[-1]], edges


def _merged(some: np.ndarray, others: np.ndarray) -> np.ndarray:
    """The distinct values of both, in order."""
    both = np.sort(np.concatenate([some, others]), kind="stable")
    return both[np.diff(both, prepend=-1) > 0]


class _Window:
    """Texts, or a part of one, as codes of cuts: per text the four counts, and the codes of its pairs with their times."""

    def __init__(self, aligner: Aligner, data: np.ndarray, edges: np.ndarray, starts: np.ndarray) -> None:
        """``edges`` as in ``_with_blanks``, ``starts`` those of all cuts."""
        self.aligner, codes = aligner, aligner.codes_of(data, np.append(starts, edges[-1]))
        first = np.searchsorted(starts, edges)
        numbers = aligner.numbers[codes]
        self.good = np.minimum.reduceat(numbers[:, 0], first[:-1]) > 0
        self.numbers = np.add.reduceat(numbers, first[:-1], axis=0) * self.good[:, None]
        self.codes, self.first = codes.tolist(), first.tolist()
        text = np.repeat(np.arange(len(edges) - 1), np.diff(first))
        n = numbers[:, 3] * self.good[text]
        held = aligner.links[np.repeat(aligner.first[codes] - np.cumsum(n) + n, n) + np.arange(n.sum())]
        # sorted by text and pair
        key = np.repeat(text, n) * len(aligner.pair_codes) + held
        key.sort()
        new = np.flatnonzero(np.diff(key, prepend=-1))
        self.times = np.diff(new, append=len(key))
        of, self.pairs = np.divmod(key[new], max(1, len(aligner.pair_codes)))
        self.offsets = np.searchsorted(of, np.arange(len(edges)))

    def shown(self, k: int) -> bytes:
        """The groups of a text, each behind a semicolon."""
        shown = self.aligner.shown
        return b"".join([shown[c] for c in self.codes[self.first[k] : self.first[k + 1]]])

    def digest(self, k: int) -> str:
        return hashlib.sha256(memoryview(self.shown(k))[1:]).hexdigest() if self.good[k] else ""


def _long_document(aligner: Aligner, data: np.ndarray) -> tuple[list[int], str, dict[int, int]]:
    """The four counts, the digest and the pairs with their times of one text of any length, which is taken in windows."""
    n, digest, pairs, start, end = np.zeros(4, np.int64), hashlib.sha256(), Counter(), 0, 0
    while start < len(data):
        end = min(len(data), max(end, start) + WINDOW_BYTES)
        starts = cut_starts(data, start + 1, end)
        if end < len(data):
            if not len(starts):
                continue
            starts, last = starts[:-1], int(starts[-1])
        else:
            last = end
        aligner.trim()
        part = _Window(aligner, data[start:last], np.array([0, last - start]), np.concatenate([[0], starts - start]))
        if not part.good[0]:
            return [0, 0, 0, 0], "", {}
        digest.update(memoryview(part.shown(0))[start == 0 :])
        n += part.numbers[0]
        pairs.update(dict(zip(aligner.pairs[part.pairs].tolist(), part.times.tolist())))
        start = end = last
    return n.tolist(), digest.hexdigest(), pairs


class _Block:
    """The pairs of a block of documents, numbered, with the documents that hold each."""

    def __init__(self, number: int) -> None:
        self.number, self.at, self.codes, self.docs = number, 0, {}, np.zeros(0, np.int64)
        self.generation, self.own = None, np.zeros(0, np.int64)

    def count(self, codes: np.ndarray) -> None:
        """Counts pairs of one or more documents, each once a document."""
        n = np.bincount(codes, minlength=len(self.codes))
        n[: len(self.docs)] += self.docs
        self.docs = n

    def of(self, window: _Window) -> np.ndarray:
        """The block's codes of a window's pairs."""
        aligner = window.aligner
        if self.generation != aligner.generation:
            self.generation, self.own = aligner.generation, np.zeros(0, np.int64)
        if len(aligner.pair_codes) > len(self.own):
            self.own = np.concatenate([self.own, np.full(len(aligner.pair_codes) - len(self.own), -1)])
        seen = np.zeros(len(self.own), np.bool_)
        seen[window.pairs] = True
        new = np.flatnonzero(seen & (self.own < 0))
        self.own[new] = [self.codes.setdefault(p, len(self.codes)) for p in aligner.pairs[new].tolist()]
        return self.own[window.pairs]


def documents(df: DataFrame, key: str, text: str, file_a: str, ranks_a: str, file_b: str, block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """Blocks of documents (``pair`` null) with the codes of their pairs, and the block's pairs with the documents that hold them."""
    names = [x.split()[0] for x in _ALIGNED.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string(), "array<int>": pa.list_(pa.int32()), "array<long>": pa.list_(pa.int64())}
    types = [kinds[x.split()[1]] for x in _ALIGNED.split(", ")]

    def batch(columns: dict, n: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([columns[c] if isinstance(columns.get(c), pa.Array) else pa.array(columns[c], t) if c in columns else pa.nulls(n, t) for c, t in zip(names, types)], names=names)

    def ended(block: _Block) -> pa.RecordBatch:
        n = len(block.codes)
        return batch({"block": np.full(n, block.number), "at": np.arange(n), "pair": list(block.codes), "docs": block.docs}, n)

    def rows(block: _Block, own_aligner: Aligner, part: pa.RecordBatch) -> pa.RecordBatch:
        texts, n = part.column(1), len(part)
        at = np.flatnonzero(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
        numbers, digests, sizes, codes, times = np.zeros((n, 4), np.int64), np.full(n, "", object), np.zeros(n + 1, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        if len(at):
            data, edges = _with_blanks(texts.take(pa.array(at)))
            if len(at) == 1:
                numbers[at[0]], digests[at[0]], pairs = _long_document(own_aligner, data)
                codes = np.array([block.codes.setdefault(p, len(block.codes)) for p in pairs], np.int64)
                times = np.fromiter(pairs.values(), np.int64, len(pairs))
                sizes[at + 1] = len(codes)
            else:
                own_aligner.trim()
                window = _Window(own_aligner, data, edges, _merged(edges[:-1], cut_starts(data, 0, len(data))))
                numbers[at], digests[at] = window.numbers, [window.digest(k) for k in range(len(at))]
                codes, times = block.of(window), window.times
                sizes[at + 1] = np.diff(window.offsets)
            block.count(codes)
        ends = pa.array(np.cumsum(sizes), pa.int32())
        columns = {c: x for c, x in zip(("n_a", "n_b", "n_groups", "n_links"), numbers.T)} | {"key": part.column(0), "groups_sha256": digests, "at": np.arange(block.at, block.at + n), "block": np.full(n, block.number)}
        block.at += n
        lists = {"codes": pa.ListArray.from_arrays(ends, pa.array(codes, pa.int32())), "times": pa.ListArray.from_arrays(ends, pa.array(times, pa.int64()))}
        return batch(columns | lists, n)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_aligner, numbers = aligner(file_a, ranks_a, file_b), itertools.count(TaskContext.get().partitionId() << 32)
        block = _Block(next(numbers))
        for b in batches:
            for part in arrow.slices(b, 1, WINDOW_BYTES):
                yield rows(block, own_aligner, part)
                if len(block.codes) >= block_pairs:
                    yield ended(block)
                    block = _Block(next(numbers))
        yield ended(block)

    return df.select(df[key].cast("long").alias("key"), df[text].alias("text")).mapInArrow(work, _ALIGNED)


def pair_counts(blocks: DataFrame) -> DataFrame:
    """pair, n (documents that hold it), best: whether no pair with the same first id is held by more."""
    first = F.shiftright("pair", 32)
    counts = written(blocks.filter("pair is not null").groupBy("pair").agg(F.sum("docs").alias("n")), "pairs")
    most = written(counts.groupBy(first.alias("a")).agg(F.max("n").alias("most")), "most")
    return counts.join(sized(most, 64), first == F.col("a")).select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def aligned(df: DataFrame, key: str, text: str, file_a: str, ranks_a: str, file_b: str, block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of each row.

    ``ranks_a`` has the entries of ``file_a`` as ranks. n_best counts the links whose pair no other pair of its first id exceeds
    in documents, count_sum adds the documents of each link's pair.
    """
    blocks = written(documents(df, key, text, file_a, ranks_a, file_b, block_pairs), "aligned")
    counted = blocks.filter("pair is not null").select("block", "at", "pair").join(pair_counts(blocks), "pair")
    shown = ["key", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "codes", "times"]
    types = dict(blocks.dtypes)
    values = counted.select("block", F.lit(0).alias("kind"), "at", "n", "best", *(F.lit(None).cast(types[c]).alias(c) for c in shown))
    rows = blocks.filter("pair is null").select("block", F.lit(1).alias("kind"), "at", F.lit(None).cast("long").alias("n"), F.lit(None).cast("boolean").alias("best"), *shown)
    schema = "key long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, n, best, known = None, [], [], None
        for b in batches:
            sides = b.column("block").to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(sides)) + 1).tolist(), len(b)] if len(b) else []
            for start, end in itertools.pairwise(edges):
                part = b.slice(start, end - start)
                if sides[start] != current:
                    current, n, best, known = sides[start], [], [], None
                values = int((part.column("kind").to_numpy() == 0).sum())
                if values:
                    n.append(part.column("n").slice(0, values).to_numpy(zero_copy_only=False).astype(np.int64))
                    best.append(part.column("best").slice(0, values).to_numpy(zero_copy_only=False).astype(bool))
                part = part.slice(values)
                if not len(part):
                    continue
                if known is None:  # codes run from 0 without gaps, so the sorted rows are the tables
                    known = (np.concatenate([*n, np.zeros(0, np.int64)]), np.concatenate([*best, np.zeros(0, bool)]))
                sums, bests = [], []
                for codes, times in zip(part.column("codes"), part.column("times")):
                    own, k = codes.values.to_numpy(), times.values.to_numpy()
                    sums.append(int((known[0][own] * k).sum()))
                    bests.append(int(k[known[1][own]].sum()))
                columns = {c: part.column(c) for c in shown[:6]} | {"n_best": pa.array(bests, pa.int64()), "count_sum": pa.array(sums, pa.int64())}
                fields = [x.split()[0] for x in schema.split(", ")]
                yield pa.RecordBatch.from_arrays([columns[c] for c in fields], names=fields)

    return values.unionByName(rows).repartition("block").sortWithinPartitions("block", "kind", "at").mapInArrow(work, schema)
