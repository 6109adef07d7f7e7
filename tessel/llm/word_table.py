"""BPE encoding and decoding through a table of distinct words.

Texts are split into words (pre-tokens) block by block. A block is what one task reads, up to ``BLOCK_WORDS`` distinct words; it
keeps its texts as codes of its own words. Its words are dealt out by a hash of the word, those of one part packed in one row, so that
each distinct word of the corpus is encoded once, however many blocks hold it; their ids go back to the blocks and replace the codes by
position. The ids that a block holds are joined with the table of pieces, and the pieces, put in place of the ids, are the decoded text.

The codes lie in a table in buckets by block and are read there, so no text travels, and a task holds one block at a time.
A very frequent word costs one word a block. A text of any length is a run of records that are read in order.

Words are what the tokenizer file's own splitter makes of a text: added tokens first, as the library finds them, then the pattern.
``regex`` knows newer characters than the tokenizers library does; a text with a character that Python's own table does not list
goes through the library's splitter. A split word alone splits into itself, so its ids are those it has inside its text.

Defined cases: a null or empty text has no ids and decodes to an empty text; each row of repeated ones is encoded; a null key stays
null; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import codecs
import functools
import hashlib
import itertools
import re
import sys
import unicodedata
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from tessel.llm import arrow
from tessel.llm.bpe import LONG_PIECE, encoder, parts, pre_tokens
from tessel.llm.packed import pack, unpack
from tessel.plans.stages import bucketed, written

#: Distinct words, and bytes of them, at which a block ends.
BLOCK_WORDS, BLOCK_BYTES = 1 << 19, 1 << 24
#: Words of texts, and 32 for each text, at which a block ends.
BLOCK_TOTAL = 1 << 23
#: Words in a record of codes, about.
RECORD_WORDS = 1 << 16
#: Words in a record of a block's words, and words of all blocks that one part takes, about.
LISTED_WORDS, PART_WORDS = 1 << 18, 1 << 18

_SPLIT = "block long, at long, keys array<long>, counts array<int>, goes_on boolean, content binary"


@functools.cache
def tokenizer(file: str):
    """The tokenizer of a file, made once for each Python worker, without truncation and padding."""
    import public_tokenizers
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(public_tokenizers.path(file))
    made.no_truncation()
    made.no_padding()
    return made


@functools.cache
def added_tokens(file: str) -> re.Pattern | None:
    """A pattern of the file's added tokens; those that swallow blanks or need word borders are not supported."""
    added = tokenizer(file).get_added_tokens_decoder().values()
    if any(x.lstrip or x.rstrip or x.single_word or x.normalized for x in added):
        raise ValueError("added tokens with conditions around them are not supported")
    return re.compile("|".join(re.escape(x.content) for x in sorted(added, key=lambda x: -len(x.content)))) if added else None


@functools.cache
def unlisted() -> re.Pattern:
    """Characters that Python's Unicode table does not list; libraries of different age class these differently."""
    spans, start = [], None
    for c in range(sys.maxunicode + 2):
        open_ = c <= sys.maxunicode and unicodedata.category(chr(c)) == "Cn"
        if open_ and start is None:
            start = c
        elif not open_ and start is not None:
            spans.append(f"\\U{start:08x}-\\U{c - 1:08x}")
            start = None
    return re.compile(f"[{''.join(spans)}]")


def has_unlisted(text: str) -> bool:
    """Whether a character of ``text`` is not in Python's Unicode table; each distinct character is looked up once."""
    return not text.isascii() and unlisted().search("".join({*text})) is not None


def words(file: str, text: str) -> Iterator[list[str]]:
    """The words of a text, in lists of bounded size."""
    added, at = added_tokens(file), 0
    for token in itertools.chain(added.finditer(text) if added else (), (None,)):
        plain = text[at : token.start() if token else len(text)]
        if not plain:
            pass
        elif has_unlisted(plain):
            yield [plain[a:b] for _, (a, b) in tokenizer(file).pre_tokenizer.pre_tokenize_str(plain)]
        else:
            for part, single in parts(plain):
                yield [part] if single else pre_tokens().findall(part)
        if token:
            yield [token[0]]
            at = token.end()


class _Block:
    """The words of a block and the record that is being filled."""

    def __init__(self, number: int) -> None:
        self.number, self.codes, self.size, self.total, self.at = number, {}, 0, 0, 0
        self.fresh()

    def fresh(self) -> None:
        self.keys, self.counts, self.words = [], [], []

    def record(self, goes_on: bool) -> tuple:
        """The texts so far as a row of packed codes; ``goes_on`` if the last of them is not finished."""
        made = pa.array(self.words, pa.string()).dictionary_encode()
        new = made.dictionary.to_pylist()
        known = len(self.codes)
        own = np.fromiter((self.codes.setdefault(w, len(self.codes)) for w in new), np.int64, len(new))
        if len(self.codes) > known:
            self.size += sum(map(len, new))
        row = (self.number, self.at, self.keys, self.counts, goes_on, pack(own[made.indices.to_numpy()] if self.words else np.zeros(0)))
        self.at += 1
        self.fresh()
        return row

    def dictionary(self) -> list[tuple]:
        """The words as rows of packed UTF-8 with their lengths before; ``keys`` is null there, ``at`` the first code, ``counts`` their number."""
        rows, listed = [], list(self.codes)
        for i in range(0, len(listed), LISTED_WORDS):
            content = [w.encode() for w in listed[i : i + LISTED_WORDS]]
            rows.append((self.number, i, None, [len(content)], None, _pack_texts(content)))
        return rows


def _pack_texts(texts: list[bytes]) -> bytes:
    import zstandard

    lengths = pack(np.fromiter(map(len, texts), np.int64, len(texts)))
    return len(lengths).to_bytes(4, "little") + lengths + zstandard.ZstdCompressor(level=3).compress(b"".join(texts))


def _unpack_texts(content: bytes) -> list[str]:
    import zstandard

    n = int.from_bytes(content[:4], "little") + 4
    ends = np.cumsum(unpack(content[4:n])).tolist()
    joined = zstandard.ZstdDecompressor().decompress(content[n:])
    return [joined[a:b].decode() for a, b in zip([0, *ends], ends)]


def _rows(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary(), "string": pa.string(), "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32())}
    fields = [x.split() for x in schema.split(", ")]
    columns = zip(*rows, strict=True) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)], names=[n for n, _ in fields])


def split(df: DataFrame, key: str, text: str, file: str, block_words: int = BLOCK_WORDS, record_words: int = RECORD_WORDS) -> DataFrame:
    """Blocks of texts as codes of the block's words, and those words; write this table before it is read."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = itertools.count(TaskContext.get().partitionId() << 32)
        block = _Block(next(numbers))
        for b in batches:
            for part in arrow.slices(b, 1):
                for k, value in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    block.keys.append(k)
                    block.counts.append(0)
                    for some in words(file, value or ""):
                        block.words += some
                        block.counts[-1] += len(some)
                        if len(block.words) >= 2 * record_words:
                            yield _rows([block.record(goes_on=True)], _SPLIT)
                            block.keys, block.counts = [k], [0]
                    block.total += 32 + block.counts[-1]
                    if len(block.words) >= record_words or len(block.keys) >= record_words:
                        yield _rows([block.record(goes_on=False)], _SPLIT)
                    if len(block.codes) >= block_words or block.size >= BLOCK_BYTES or block.total >= BLOCK_TOTAL:
                        if block.keys:
                            yield _rows([block.record(goes_on=False)], _SPLIT)
                        yield from (_rows([x], _SPLIT) for x in block.dictionary())
                        block = _Block(next(numbers))
        if block.keys:
            yield _rows([block.record(goes_on=False)], _SPLIT)
        yield from (_rows([x], _SPLIT) for x in block.dictionary())

    return df.select(df[key].cast("long").alias("key"), df[text].alias("text")).mapInArrow(work, _SPLIT)


def words_by_block(blocks: DataFrame) -> DataFrame:
    """word, block, code: each word of each block."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block, first, content in zip(*(c.to_pylist() for c in b.columns)):
                listed = _unpack_texts(content)
                yield pa.RecordBatch.from_arrays([pa.array(listed, pa.string()), pa.array(np.full(len(listed), block)), pa.array(np.arange(first, first + len(listed), dtype=np.int32))], names=["word", "block", "code"])

    return blocks.filter("keys is null").select("block", "at", "content").mapInArrow(work, "word string, block long, code int")


def word_encoder(file: str, ranks: str | None) -> Callable[[list[str]], Iterator[list[int]]]:
    """Ids of many words: by the rank file of the same vocabulary, if given, else by the tokenizer file.

    Words with characters that Python's table does not list, and added tokens, always go through the tokenizer file.
    """
    library, added = tokenizer(file), {x.content for x in tokenizer(file).get_added_tokens_decoder().values()}
    if ranks is None:
        return lambda listed: (x.ids for x in library.encode_batch(listed, add_special_tokens=False))
    by_rank = encoder(ranks)

    def ids(word: str) -> list[int]:
        if word in added or has_unlisted(word):
            return library.encode(word, add_special_tokens=False).ids
        return by_rank.encode_ordinary(word) if len(word) <= LONG_PIECE else by_rank._encode_single_piece(word)

    return lambda listed: map(ids, listed)


def dealt_words(blocks: DataFrame, parts: int) -> DataFrame:
    """part, block, codes, words: the words of each block, those of one part (by hash of the word) packed together."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block, first, content in zip(*(c.to_pylist() for c in b.columns)):
                listed = [w.encode() for w in _unpack_texts(content)]
                part = np.fromiter(map(zlib.crc32, listed), np.int64, len(listed)) % parts
                order = np.argsort(part, kind="stable")
                edges = [0, *(np.flatnonzero(np.diff(part[order])) + 1).tolist(), len(order)]
                rows = [(int(part[own[0]]), block, pack(np.diff(own + first, prepend=0)), _pack_texts([listed[k] for k in own.tolist()])) for own in (order[i:j] for i, j in itertools.pairwise(edges))]
                yield _rows(rows, "part int, block long, codes binary, words binary")

    return blocks.filter("keys is null").select("block", "at", "content").mapInArrow(work, "part int, block long, codes binary, words binary")


def encoded_words(blocks: DataFrame, file: str, ranks: str | None = None) -> DataFrame:
    """block, codes with their ids (packed), and the distinct ids among them: each distinct word is encoded once."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, known = word_encoder(file, ranks), {}
        for b in batches:
            for block, codes, words_ in zip(*(b.column(c) for c in ("block", "codes", "words"))):
                listed = _unpack_texts(words_.as_py())
                new = [w for w in listed if w not in known]
                known.update(zip(new, (np.array(x, np.int32) for x in encode(new))))
                ids = [known[w] for w in listed]
                flat = np.concatenate(ids)
                yield _rows([(block.as_py(), _pack_many(unpack(codes.as_py()), list(map(len, ids)), flat), np.unique(flat))], "block long, content binary, ids array<int>")

    n = blocks.filter("keys is null").agg(F.sum(F.col("counts")[0])).first()[0] or 0
    parts = max(blocks.sparkSession.sparkContext.defaultParallelism, -(-n // PART_WORDS))
    return dealt_words(blocks, parts).repartition("part").mapInArrow(work, "block long, content binary, ids array<int>")


def _pack_many(*lists: list[int] | np.ndarray) -> bytes:
    made = [pack(np.array(x, np.int64)) for x in lists]
    return b"".join(len(x).to_bytes(4, "little") + x for x in made)


def _unpack_many(content: bytes) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(content):
        n = int.from_bytes(content[at : at + 4], "little")
        out.append(unpack(content[at + 4 : at + 4 + n]))
        at += 4 + n
    return out


def pieces(spark: SparkSession, file: str) -> DataFrame:
    """id, piece: the bytes of every id of the tokenizer file, as many rows as its vocabulary has."""
    made, own = tokenizer(file), byte_letters()
    special = {k for k, x in made.get_added_tokens_decoder().items()}
    rows = [(i, bytearray(token.encode() if i in special or not own.keys() >= {*token} else bytes(own[c] for c in token))) for token, i in made.get_vocab(with_added_tokens=True).items()]
    return spark.createDataFrame(rows, "id int, piece binary")


@functools.cache
def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable Latin-1 itself, the others from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in {*printable}]
    return {chr(b): b for b in printable} | {chr(0x100 + k): b for k, b in enumerate(others)}


class _Words:
    """Ids and bytes of a block's words by code."""

    def __init__(self) -> None:
        self.piece: dict[int, bytes] = {}
        self.ids: dict[int, list[int]] = {}

    def add(self, content: bytes) -> None:
        codes, lengths, flat = _unpack_many(content)
        ends, flat = np.cumsum(lengths).tolist(), flat.tolist()
        self.ids |= {c: flat[a:b] for c, a, b in zip(np.cumsum(codes).tolist(), [0, *ends], ends)}

    def close(self) -> None:
        n, piece = len(self.ids), self.piece
        listed = [self.ids[c] for c in range(n)]
        self.listed = listed
        self.decimal = [",".join(map(str, x)).encode() for x in listed]
        self.bytes = [b"".join([piece[i] for i in x]) for x in listed]


class _Digest:
    """Running digests of a text's ids and decoded text."""

    schema = "key long, n_tokens long, ids_sha256 string, decoded_sha256 string"

    def __init__(self) -> None:
        self.n, self.ids, self.text, self.decoder = 0, hashlib.sha256(), hashlib.sha256(), codecs.getincrementaldecoder("utf-8")("replace")

    def add(self, block: _Words, codes: list[int]) -> None:
        if codes:
            self.ids.update(b"," * bool(self.n) + b",".join([block.decimal[c] for c in codes]))
            self.n += sum([len(block.listed[c]) for c in codes])
            self.text.update(self.decoder.decode(b"".join([block.bytes[c] for c in codes])).encode())

    def row(self) -> tuple:
        self.text.update(self.decoder.decode(b"", final=True).encode())
        return self.n, self.ids.hexdigest(), self.text.hexdigest()


class _Whole:
    """The ids and the decoded text themselves."""

    schema = "key long, ids array<int>, decoded string"

    def __init__(self) -> None:
        self.ids, self.content = [], []

    def add(self, block: _Words, codes: list[int]) -> None:
        self.ids += itertools.chain.from_iterable(block.listed[c] for c in codes)
        self.content += [block.bytes[c] for c in codes]

    def row(self) -> tuple:
        return self.ids, b"".join(self.content).decode(errors="replace")


def _assembled(texts: DataFrame, given: DataFrame, kind: type[_Digest | _Whole]) -> DataFrame:
    """Texts put together block by block, from their records of codes, the ids of the words and the pieces of these ids."""

    def work(texts: pa.Table, given: pa.Table) -> pa.Table:
        own, text, rows = _Words(), None, []
        for piece, at, content in zip(*(given.column(c) for c in ("is_piece", "at", "content"))):
            if piece.as_py():
                own.piece[at.as_py()] = content.as_py()
            else:
                own.add(content.as_py())
        own.close()
        for i in np.argsort(texts.column("at").to_numpy()).tolist():
            keys, counts, goes_on, content = (texts.column(c)[i].as_py() for c in ("keys", "counts", "goes_on", "content"))
            codes, at = unpack(content).tolist(), 0
            for k, (key, n) in enumerate(zip(keys, counts)):
                text = text or kind()
                text.add(own, codes[at : at + n])
                at += n
                if not goes_on or k + 1 < len(keys):
                    rows.append((key, *text.row()))
                    text = None
        return pa.Table.from_batches([_rows(rows, kind.schema)])

    return texts.groupBy("block").cogroup(given.groupBy("block")).applyInArrow(work, kind.schema)


def _through(df: DataFrame, key: str, text: str, file: str, ranks: str | None, kind: type, **limits: int) -> DataFrame:
    blocks = bucketed(split(df, key, text, file, **limits), "block", "split")
    found = written(encoded_words(blocks, file, ranks), "words")
    # a block's list is bounded by its words, whatever the number of tasks that encoded them
    ids = found.groupBy("block").agg(F.array_distinct(F.flatten(F.collect_list("ids"))).alias("ids")).select("block", F.explode("ids").alias("id"))
    own = ids.join(F.broadcast(pieces(df.sparkSession, file)), "id").select("block", F.lit(True).alias("is_piece"), F.col("id").cast("long").alias("at"), F.col("piece").alias("content"))
    named = found.select("block", F.lit(False).alias("is_piece"), F.lit(0).cast("long").alias("at"), "content")
    return _assembled(blocks.filter("keys is not null"), own.unionByName(named), kind)


def encoded(df: DataFrame, key: str, text: str, file: str, ranks: str | None = None, **limits: int) -> DataFrame:
    """One row per input row: key, ids, and the text decoded from these ids. ``ranks`` has the entries of ``file`` as ranks."""
    return _through(df, key, text, file, ranks, _Whole, **limits)


def digests(df: DataFrame, key: str, text: str, file: str, ranks: str | None = None, **limits: int) -> DataFrame:
    """One row per input row: key, n_tokens, ids_sha256 (decimal ids joined by commas), decoded_sha256; ``ranks`` as above."""
    return _through(df, key, text, file, ranks, _Digest, **limits)


def decoded(df: DataFrame, ids: str, file: str) -> DataFrame:
    """``df`` with a column ``decoded``: the text of each row's array ``ids``, by a join of its distinct ids with the pieces.

    An id that the file does not have adds nothing; a null array gives a null text.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = []
            for values, known in zip(b.column("__ids").to_pylist(), b.column("__pieces").to_pylist()):
                piece = {x["id"]: x["piece"] for x in known or []}
                made.append(None if values is None else b"".join([piece.get(i, b"") for i in values]).decode(errors="replace"))
            yield pa.RecordBatch.from_arrays([b.column("__row"), pa.array(made, pa.string())], names=["row", "decoded"])

    rows = written(df.select(F.struct(*arrow.named(df)).alias("__row"), F.col(ids).alias("__ids"), F.expr("uuid()").alias("__id")), "sequences")
    distinct = rows.select("__id", F.explode(F.array_distinct("__ids")).alias("id"))
    known = distinct.join(F.broadcast(pieces(df.sparkSession, file)), "id").groupBy("__id").agg(F.collect_list(F.struct("id", "piece")).alias("__pieces"))
    joined = rows.join(known, "__id", "left").select("__row", "__ids", "__pieces")
    return joined.mapInArrow(work, f"row {joined.schema['__row'].dataType.simpleString()}, decoded string").select("row.*", "decoded")
