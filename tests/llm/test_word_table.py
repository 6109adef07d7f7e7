"""Encoding and decoding through a table of distinct words, against the tokenizers library."""

from __future__ import annotations

import hashlib
import random
import sys
import unicodedata
from collections import Counter

import public_tokenizers
import pytest
import numpy as np
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tessel.llm import word_table
from tessel.llm.packed import pack, unpack

FILE, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path(FILE))


def plain(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return ids, library.decode(ids, skip_special_tokens=False)


def digest(library, text):
    ids, back = plain(library, text)
    return len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()


@pytest.mark.parametrize("values", [[], [0], [0, 0], [1, 256, 70_000, 2**32 - 1], list(range(1000))])
def test_packed_integers(values):
    assert unpack(pack(np.array(values, np.int64))).tolist() == values


def test_words_are_the_library_s_for_every_character(library):
    """Every code point, listed or not, among letters, digits, blanks and its own kind."""
    points = [chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    for i in range(0, len(points), 4000):
        listed = [c for c in points[i : i + 4000] if unicodedata.category(c) != "Cn"]
        text = "".join(f"a{c}1{c} {c}{c} b!{c}\n" for c in listed)
        assert [w for some in word_table.words(FILE, text) for w in some] == [text[a:b] for _, (a, b) in library.pre_tokenizer.pre_tokenize_str(text)]
    assert word_table.unlisted().search("\U0003fc3f") and not word_table.unlisted().search("aé日")


def test_words_by_rank_are_the_library_s(library):
    """Every entry of the vocabulary, every listed character, random words and added tokens."""
    rng = random.Random(7)
    entries = [library.decode([i], skip_special_tokens=False) for i in range(library.get_vocab_size())]
    points = [chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000 and c % 7 == 3]
    mixed = ["".join(rng.choice("abcdeﬁéßñüøжы日語ال") for _ in range(rng.randrange(1, 14))) for _ in range(20_000)]
    listed = sorted({w for text in [*entries, *points, *mixed] for some in word_table.words(FILE, text) for w in some})
    assert list(word_table.word_encoder(FILE, RANKS)(listed)) == list(word_table.word_encoder(FILE, None)(listed))


def test_a_word_alone_is_one_word(library):
    rng = random.Random(5)
    for _ in range(2000):
        text = "".join(rng.choice("ab1é \n\t'stredvml!?-日 ") for _ in range(12))
        for some in word_table.words(FILE, text):
            for w in some:
                assert [a for _, a in library.pre_tokenizer.pre_tokenize_str(w)] == [(0, len(w))]


@pytest.mark.parametrize("ranks", [None, RANKS])
def test_digests_of_awkward_rows(awkward, none, library, ranks):
    got = word_table.digests(awkward, "doc_id", "text", FILE, ranks).collect()
    assert Counter(map(tuple, got)) == Counter((r.doc_id, *digest(library, r.text)) for r in awkward.collect())
    assert word_table.digests(none, "doc_id", "text", FILE, ranks).count() == 0


@pytest.mark.parametrize("block,record", [(7, 5), (50, 1 << 16)])
def test_small_blocks_and_records(awkward, library, block, record):
    """Texts over several records, words over several blocks."""
    short = awkward.filter("char_length(text) < 5000 or text is null")
    got = word_table.digests(short, "doc_id", "text", FILE, block_words=block, record_words=record).collect()
    assert Counter(map(tuple, got)) == Counter((r.doc_id, *digest(library, r.text)) for r in short.collect())


@pytest.mark.parametrize("ranks", [None, RANKS])
def test_ids_and_texts(spark, library, ranks):
    texts = ["a <|endoftext|> b<|endoftext|>", "<|endoftext|>", "x" * 200_000, " " * 200_000, "日本語" * 40_000, "word " * 60_000, "new \U0003fc3f character", None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.key: (r.ids, r.decoded) for r in word_table.encoded(df, "doc_id", "text", FILE, ranks).collect()}
    assert got == {k: plain(library, t) for k, t in enumerate(texts)}


def test_decoding_of_any_ids(spark, library):
    """Ids that no text has: halves of characters, special tokens, unknown ids, nulls; an extra column keeps its name."""
    rng = random.Random(1)
    rows = [([rng.randrange(50257) for _ in range(rng.randrange(40))], "x") for _ in range(60)] + [([], "y"), (None, "z")]
    df = spark.createDataFrame(rows, "ids array<int>, piece string")
    got = word_table.decoded(df, "ids", FILE).collect()
    expected = Counter((tuple(i) if i is not None else None, p, library.decode(i, skip_special_tokens=False) if i is not None else None) for i, p in rows)
    assert Counter((tuple(r.ids) if r.ids is not None else None, r.piece, r.decoded) for r in got) == expected
    assert word_table.decoded(spark.createDataFrame([([60_000],)], "ids array<int>"), "ids", FILE).first().decoded == ""


def test_each_distinct_word_is_encoded_once(spark):
    df = spark.createDataFrame([(k, "the same words in every text") for k in range(50)], "doc_id long, text string").repartition(5)
    blocks = word_table.written(word_table.split(df, "doc_id", "text", FILE), "test")
    named = word_table.words_by_block(blocks)
    assert named.count() > 6 and named.select("word").distinct().count() == 6
    assert named.groupBy("word").agg(F.count_distinct("block").alias("n")).filter("n > 1").count() == 6


def test_texts_do_not_travel(spark, library):
    """Codes of texts are read in the buckets they were written to; words travel packed, each to one part, with its code."""
    texts = ["some words of a text", "words again", "", None, "of other words " * 30]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    plan = word_table.digests(df, "doc_id", "text", FILE, RANKS)._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and "Exchange" not in plan[plan.index(":- Sort") : plan.index("+- Sort", plan.index(":- Sort"))]
    blocks = word_table.written(word_table.split(df, "doc_id", "text", FILE), "test")
    where = {}
    for r in word_table.dealt_words(blocks, 4).collect():
        listed = word_table._unpack_texts(bytes(r.words))
        assert all(where.setdefault(w, r.part) == r.part for w in listed)
        codes = np.cumsum(unpack(bytes(r.codes))).tolist()
        named = {(x.block, x.code): x.word for x in word_table.words_by_block(blocks).collect()}
        assert listed == [named[r.block, c] for c in codes]
    assert {*where} == {w for t in texts for some in word_table.words(FILE, t or "") for w in some}
    assert not any("tessel_split" in t.name for t in spark.catalog.listTables())
