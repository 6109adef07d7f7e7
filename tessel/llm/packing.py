"""Cost-balanced packing of tokenised documents into sequences of a fixed capacity.

A piece of n tokens costs ``linear * n + quadratic * n * n``, as attention stays inside documents. Documents are taken in
descending length, and each goes to the sequence of the lowest cost so far that has room; what does not fit is cut off and
takes its place again among the documents still waiting. The number of sequences is the least that holds all tokens, so
that only the last tokens of a window are padding.

A task packs one window of its documents after another, each of about ``WINDOW_TOKENS`` tokens: memory is bounded, nothing
is shuffled, and a window wastes less than one sequence. Sequence numbers carry the task and the window.

Defined cases: a null text is an empty one and packs as its end token alone; repeated rows are packed each; documents longer
than a window fill sequences of their own; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tessel.llm import bpe

CAPACITY = 1024
WINDOW_TOKENS = 1 << 21
#: Cost of a token on its own, and of a pair of tokens that attend to each other, in units of the former.
LINEAR, QUADRATIC = 1.0, 1.0 / 2048
#: Up to this character the two libraries' character classes are alike, so that the rank file gives the tokenizer's ids.
ALIKE = re.compile("[^\x00-ɏ]")

#: The token that the file adds to its vocabulary.
ADDED = "<|endoftext|>"

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, cost double"
_TOKENIZERS: dict[str, object] = {}


def blank_parts(text: str, size: int = bpe.PART_CHARS) -> Iterator[str]:
    """Parts of a text cut at single blanks, of about ``size`` characters; without such a place it comes whole."""
    at = 0
    while len(text) - at > size and (cut := bpe.SAFE.search(text, at + size)):
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


def tokenize(tokenizer_file: str, ranks_file: str, end_id: int) -> Callable[[str], np.ndarray]:
    """Ids of a text by the tokenizer file, then ``end_id``.

    The rank file holds the same vocabulary and merges several times faster; texts with characters beyond ``ALIKE``, or with a
    string that the tokenizer file reads as a token of its own, go through that file itself, long ones in parts cut at single
    blanks.
    """
    import public_tokenizers
    from tokenizers import Tokenizer

    enc = bpe.encoder(ranks_file)

    def ids(text: str) -> np.ndarray:
        if ALIKE.search(text) or ADDED in text:
            if tokenizer_file not in _TOKENIZERS:
                _TOKENIZERS[tokenizer_file] = Tokenizer.from_file(public_tokenizers.path(tokenizer_file))
            found = [i for part in blank_parts(text) for i in _TOKENIZERS[tokenizer_file].encode(part, add_special_tokens=False).ids]
        else:
            found = bpe.encode(enc, text)
        return np.array([*found, end_id], "<u4")

    return ids


def cost(n: int) -> float:
    return LINEAR * n + QUADRATIC * n * n


def place(lengths: list[int], capacity: int = CAPACITY) -> Iterator[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) for each piece of documents with these lengths.

    Ties go to the earlier document and the lower sequence number.
    """
    waiting = [(-n, d, 0) for d, n in enumerate(lengths) if n]
    heapq.heapify(waiting)
    open_sequences = [(0.0, s, 0) for s in range(-(-sum(lengths) // capacity))]
    while waiting:
        left, d, start = heapq.heappop(waiting)
        spent, s, used = heapq.heappop(open_sequences)
        n = min(-left, capacity - used)
        yield d, start, n, s, used
        if used + n < capacity:
            heapq.heappush(open_sequences, (spent + cost(n), s, used + n))
        if n < -left:
            heapq.heappush(waiting, (left + n, d, start + n))


def packed(df: DataFrame, key: str, text: str, tokenizer_file: str, ranks_file: str, end_id: int = 0, capacity: int = CAPACITY, window: int = WINDOW_TOKENS) -> DataFrame:
    """One row per piece, as in ``SCHEMA``: where it lies in its document and in its sequence, and a checksum of its ids."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to_ids = tokenize(tokenizer_file, ranks_file, end_id)
        context = TaskContext.get()
        first = (context.partitionId() if context else 0) << 40
        docs: list[tuple[int | None, np.ndarray]] = []
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal first, held
            rows = []
            for d, start, n, s, used in place([len(ids) for _, ids in docs], capacity):
                doc_id, ids = docs[d]
                rows.append((doc_id, start, n, zlib.crc32(ids[start : start + n].tobytes()), len(ids), first + s, used, cost(n)))
            first += -(-held // capacity)
            docs.clear()
            held = 0
            columns = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, pa.float64() if k == 7 else pa.int64()) for k, c in enumerate(columns)], names=[c.split()[0] for c in SCHEMA.split(", ")])

        for b in batches:
            for key_, value in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                docs.append((key_, to_ids(value.as_py() or "")))
                held += len(docs[-1][1])
                if held >= window:
                    yield flush()
        if docs:
            yield flush()

    return df.select(df[key].cast("long").alias("doc_id"), df[text].alias("text")).mapInArrow(work, SCHEMA)
