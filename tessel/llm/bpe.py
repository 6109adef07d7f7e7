"""Byte-level BPE with a local rank file.

Long texts are split at boundaries that no match of the pre-token pattern can cross, so that the ids are those of the whole text:
at single blanks, and where there is none for long, between matches found one by one. A match of great length (a run of blanks, a
text without blanks) is encoded by itself, without the pattern. Beside the text and its ids, memory is bounded by the longest
match. Decoding returns raw bytes, which need not be valid UTF-8 at the end of a piece.

Defined cases: a null text is an empty one, with no ids; repeated rows are encoded each; an empty table gives no rows;
columns other than the two named are not read, so clashing names do no harm.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

#: Texts are encoded in parts of about so many characters.
PART_CHARS = 1 << 16
#: A match of more characters is encoded by itself.
LONG_PIECE = 1 << 12
#: A space between two characters that are no white space: every pre-token ends before it.
SAFE = re.compile(r"(?<=\S) (?=\S)")

_ENCODERS: dict[str, object] = {}


@functools.cache
def pre_tokens():
    """The pre-token pattern."""
    import public_tokenizers
    import regex

    return regex.compile(public_tokenizers.PATTERN)


def encoder(ranks_file: str):
    """The encoder of a rank file, made once for each Python worker."""
    import public_tokenizers
    import tiktoken

    if ranks_file not in _ENCODERS:
        with open(public_tokenizers.path(ranks_file), "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        _ENCODERS[ranks_file] = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _ENCODERS[ranks_file]


def parts(text: str, size: int = PART_CHARS) -> Iterator[tuple[str, bool]]:
    """Consecutive parts of ``text`` of about ``size`` characters, and whether a part is a single match, to be encoded by itself.

    White space at a part's end would be matched as at the end of a text, so a match of white space before a cut is a part of its own.
    """
    at = 0
    while len(text) - at > size:
        if cut := SAFE.search(text, at + size, at + 2 * size):
            yield text[at : cut.start()], False
            at = cut.start()
            continue
        begin = last = at
        for match in pre_tokens().finditer(text, at):
            long_ = match.end() - match.start() > LONG_PIECE
            if begin < match.start() and (long_ or match.start() - begin >= size):
                if text[match.start() - 1].isspace() and text[match.start() - 1] not in "\x1c\x1d\x1e\x1f":  # no white space in the pattern
                    if begin < last:
                        yield text[begin:last], False
                    yield text[last : match.start()], True
                else:
                    yield text[begin : match.start()], False
                begin = match.start()
            last = match.start()
            if long_:
                yield match[0], True
                begin = match.end()
            if begin > at + size:
                break
        else:
            if begin < len(text):
                yield text[begin:], False
            return
        at = begin
    if at < len(text) or not text:
        yield text[at:], False


def encode(enc, text: str) -> list[int]:
    """Ids of the whole text, special tokens being ordinary text."""
    if len(text) <= PART_CHARS:
        return enc.encode_ordinary(text)
    ids: list[int] = []
    for part, single in parts(text):
        ids += enc._encode_single_piece(part) if single else enc.encode_ordinary(part)
    return ids


def encoded(df: DataFrame, key: str, text: str, ranks_file: str) -> DataFrame:
    """One row per input row: key and ids (array of int)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(ranks_file)
        for b in batches:
            for i in range(0, len(b), 256):
                part = b.slice(i, 256)
                ids = [encode(enc, x or "") for x in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["key", "ids"])

    return df.select(df[key].cast("long").alias("key"), df[text].alias("text")).mapInArrow(work, "key long, ids array<int>")


def decoded(df: DataFrame, ranks_file: str) -> DataFrame:
    """``df`` (key, ids) to (key, content): the raw bytes of the ids."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(ranks_file)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([enc.decode_bytes(ids or []) for ids in b.column(1).to_pylist()], pa.binary())], names=["key", "content"])

    return df.select("key", "ids").mapInArrow(work, "key long, content binary")


def digests(df: DataFrame, key: str, text: str, ranks_file: str) -> DataFrame:
    """Encode and decode in one pass: key, n_tokens, ids_sha256 (decimal ids joined by commas), decoded_sha256, n_bytes."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(ranks_file)
        decimal = [b"%d" % i for i in range(enc.n_vocab)]
        for b in batches:
            rows = []
            for value in b.column(1):
                ids = encode(enc, value.as_py() or "")
                content = enc.decode_bytes(ids)
                rows.append((len(ids), hashlib.sha256(b",".join([decimal[i] for i in ids])).hexdigest(), hashlib.sha256(content).hexdigest(), len(content)))
            n, ids_hash, text_hash, size = zip(*rows, strict=True) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(ids_hash, pa.string()), pa.array(text_hash, pa.string()), pa.array(size, pa.int64())], names=["key", "n_tokens", "ids_sha256", "decoded_sha256", "n_bytes"])

    return df.select(df[key].cast("long").alias("key"), df[text].alias("text")).mapInArrow(work, "key long, n_tokens long, ids_sha256 string, decoded_sha256 string, n_bytes long")
