"""Fingerprints, chat, BPE, token counts, packing: against plain versions, and on awkward input."""

from __future__ import annotations

import base64
import functools
import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tessel.llm import bpe, chat, fingerprints, packing, token_counts

MULTI, PLAIN = "byte_bpe_multi_50k.tiktoken", "byte_bpe_50k.tiktoken"


@functools.cache
def library(name: str) -> tiktoken.Encoding:
    with open(public_tokenizers.path(name), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


# --- fingerprints


def test_canonical_folds_case_space_and_compatibility():
    assert fingerprints.canonical(" E\u0301T\u00c9\n\tﬁ ") == fingerprints.canonical("\u00e9t\u00e9 FI")
    assert fingerprints.canonical("Straße") == fingerprints.canonical("STRASSE")
    assert fingerprints.canonical(" \n") == fingerprints.canonical("") == b""
    assert fingerprints.canonical("a b") != fingerprints.canonical("ab")


@pytest.mark.parametrize("bits", [128, 3])
def test_fingerprints(unique, bits):
    texts = {r.doc_id: r.text or "" for r in unique.collect()}
    ids = sorted(texts, reverse=True)
    got = {r.doc_id: r for r in fingerprints.fingerprints(unique, "doc_id", "text", bits).collect()}
    assert set(got) == set(texts)
    named = {}
    for k, d in enumerate(ids):
        follow = texts[ids[(k + 1) % len(ids)]]
        new = fingerprints.edited(texts[d], follow)
        r, own = got[d], fingerprints.canonical(texts[d])
        assert (r.n_chars, r.edited_sha256) == (len(texts[d]), hashlib.sha256(new.encode()).hexdigest())
        assert r.near_edited == float(own == fingerprints.canonical(new)) and r.near_next == float(own == fingerprints.canonical(follow))
        for name, content in ((r.fingerprint, own), (r.edited_fingerprint, fingerprints.canonical(new))):
            assert named.setdefault(name, content) == content
    assert len({got[d].fingerprint for d in ids}) == len({fingerprints.canonical(t) for t in texts.values()})


def test_fingerprints_of_awkward_rows(awkward, none):
    got = fingerprints.fingerprints(awkward, "doc_id", "text").collect()
    assert Counter(r.doc_id for r in got) == Counter(r.doc_id for r in awkward.collect())
    assert fingerprints.fingerprints(none, "doc_id", "text").count() == 0


# --- chat


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "a|b\n<s>", ""]), st.lists(st.sampled_from(["<s>", "</s>", "[INST]", "[/INST]", "\\", "<", "[", "s>", "\n", "x", "é", "<\\s>", "[\\\\/INST]", "|0\n"]), max_size=8).map("".join)), max_size=4))
def test_chat_round_trip(turns):
    assert list(chat.parse("".join(chat.render(r, t) for r, t in turns))) == turns


def test_chat_parser_refuses_other_grammar():
    assert list(chat.parse("<s>user|0\nno end")) == [None] and list(chat.parse("free text")) == [None]


def test_chat_digests(spark):
    rng = random.Random(5)
    parts = ["hello", "</s>", "[INST]", "\n", "é", "", "[/INST] ok"]
    rows = [(c, t, rng.choice(["user", "assistant", "system", None]), rng.choice([None, "".join(rng.choices(parts, k=4))]), "x") for c in range(40) for t in range(rng.randrange(1, 7))]
    rows += [(None, 0, "user", "u", "x"), (None, None, "assistant", "first", "x"), (3, 0, "user", "tie", "x"), (3, 0, "user", "tie", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    by = defaultdict(list)
    for c, t, r, x, _ in rows:
        by[c].append((t is not None, t or 0, r or "", x or ""))
    pieces = chat.formatted(df, "conv_id", "turn", "role", "text")
    got = {r.conv_id: r for r in chat.read_back(pieces).collect()}
    assert set(got) == set(by)
    whole = defaultdict(str)
    for p in sorted(pieces.collect(), key=lambda p: p.turn_no):
        whole[p.conv_id] += p.formatted
    for c, turns in by.items():
        turns = [x[2:] for x in sorted(turns)]
        loss = "".join(x for r, x in turns if r == "assistant")
        assert list(chat.parse(whole[c])) == turns
        assert tuple(got[c]) == (c, len(turns), hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in turns).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(whole[c]))
    for p in pieces.filter("loss_chars > 0").collect():
        assert 0 <= p.loss_start and p.loss_start + p.loss_chars <= len(whole[p.conv_id])
    assert chat.read_back(chat.formatted(df.limit(0), "conv_id", "turn", "role", "text")).count() == 0


# --- byte-level BPE


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([" ", "  ", "\n", "a", "don't", "é", "1", "'s", "\t", "日", "!", "\u00a0", "\u2009"]), max_size=60).map("".join), st.integers(1, 12))
def test_parts_keep_the_ids(text, size):
    enc = bpe.encoder(MULTI)
    for long_piece in (3, 1 << 12):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(bpe, "LONG_PIECE", long_piece)
            parts = list(bpe.parts(text, size))
        assert "".join(p for p, _ in parts) == text
        assert [i for p, single in parts for i in (enc._encode_single_piece(p) if single else enc.encode_ordinary(p))] == enc.encode_ordinary(text)
        assert "".join(packing.blank_parts(text, size)) == text


@pytest.mark.parametrize("text", ["  \xa0a", "b  \xa0a  \xa0a", "1\n\n\u2009a", " \t\xa0aaaaaaaa", "\xa0\xa0\xa0\u3000\xe9", "!  \x1c\xa0\x1c\x1ca\xa0\x1c"])
def test_parts_end_before_white_space(text):
    """A match of white space at a part's end goes by itself, as the end of a part is not the end of the text."""
    enc = bpe.encoder(MULTI)
    for size in range(1, len(text) + 1):
        for long_piece in (3, 1 << 12):
            with pytest.MonkeyPatch.context() as patch:
                patch.setattr(bpe, "LONG_PIECE", long_piece)
                parts = list(bpe.parts(text, size))
            assert "".join(p for p, _ in parts) == text
            assert [i for p, single in parts for i in (enc._encode_single_piece(p) if single else enc.encode_ordinary(p))] == enc.encode_ordinary(text)


LONG_TEXTS = {
    "blanks": " " * 1_000_000, "blanks and a letter": " " * 700_000 + "x", "chinese": "\u6f22\u5b57" * 150_000, "letters": "a" * 200_000,
    "double blanks": "word  " * 50_000, "line ends": "\n " * 100_000, "marks": "a!" * 100_000, "words": "some words " * 30_000,
}


@pytest.mark.parametrize("name", LONG_TEXTS)
def test_long_texts(name):
    """Ids of long texts are those of their pre-tokens, each encoded by itself; parts stay small where the pattern allows."""
    text = LONG_TEXTS[name]
    pieces = regex.findall(public_tokenizers.PATTERN, text)
    for file in (MULTI, PLAIN):
        enc = bpe.encoder(file)
        known = {p: enc._encode_single_piece(p) for p in set(pieces)}
        want = [i for p in pieces for i in known[p]]
        assert bpe.encode(enc, text) == want and enc.decode_bytes(want) == text.encode()
    assert max(len(p) for p, _ in bpe.parts(text)) <= max(2 * bpe.PART_CHARS, max(map(len, pieces)))
    assert packing.tokenize("byte_bpe_50k.json", PLAIN, 0)(text).tolist() == [*want, 0]
    counter = token_counts.Counter(PLAIN)
    assert sum(counter.split(text)[1]) == len(want) and max(map(len, counter.known), default=0) <= token_counts.REMEMBERED_CHARS


def test_bpe(awkward, none):
    enc = library(MULTI)
    got = Counter((r.key, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.digests(awkward, "doc_id", "text", MULTI).collect())
    want = Counter()
    for r in awkward.collect():
        ids = enc.encode_ordinary(r.text or "")
        want[r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest()] += 1
    assert got == want
    back = bpe.decoded(bpe.encoded(awkward, "doc_id", "text", MULTI), MULTI)
    assert Counter((r.key, bytes(r.content)) for r in back.collect()) == Counter((r.doc_id, (r.text or "").encode()) for r in awkward.collect())
    assert bpe.digests(none, "doc_id", "text", MULTI).count() == 0


# --- token counts


def test_tree_follows_random_edits():
    rng = random.Random(7)
    counter, enc = token_counts.Counter(PLAIN), library(PLAIN)
    parts = [" ", "  ", "\n", "word", " word", "'s", "é", "12", "...", " longerword"]
    for _ in range(150):
        text = "".join(rng.choices(parts, k=rng.randrange(60)))
        pieces, counts = counter.split(text)
        tree = token_counts.Tree(list(map(len, pieces)), counts)
        for _ in range(8):
            start, removed, new = rng.randrange(len(text) + 2), rng.randrange(12), "".join(rng.choices(parts, k=rng.randrange(4)))
            want = text[: min(start, len(text))] + new + text[min(start, len(text)) + removed :]
            text, _ = token_counts.edit(tree, text, counter, start, removed, new)
            assert text == want and tree.tokens == len(enc.encode_ordinary(text)) and tree.chars == len(text)


def test_edits_encode_little():
    counter = token_counts.Counter(PLAIN)
    text = "some words in a row " * 5000
    pieces, counts = counter.split(text)
    _, anew = token_counts.edit(token_counts.Tree(list(map(len, pieces)), counts), text, counter, 50_000, 3, "x y")
    assert anew < 60


def test_token_counts(awkward, none):
    edits = F.when(F.col("label") % 3 > 0, F.array(F.struct(F.lit(3).alias("start"), F.lit(4).alias("removed"), F.lit(" new").alias("inserted")), F.lit(None).cast("struct<start:int,removed:int,inserted:string>")))
    enc = library(PLAIN)
    rows = awkward.withColumn("edits", edits)
    got = Counter((r.key, r.n_tokens, r.n_tokens_edited) for r in token_counts.counted(rows, "doc_id", "text", "edits", PLAIN).collect())
    want = Counter()
    for r in rows.collect():
        t = r.text or ""
        new = t[:3] + " new" + t[7:] if r.edits else t
        want[r.doc_id, len(enc.encode_ordinary(t)), len(enc.encode_ordinary(new))] += 1
    assert got == want
    assert token_counts.counted(none.withColumn("edits", edits), "doc_id", "text", "edits", PLAIN).count() == 0
    assert {r.n_tokens == sum(r.counts) for r in token_counts.trees(awkward, "doc_id", "text", PLAIN).collect()} == {True}


# --- packing


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 300), max_size=40))
def test_place_fills_sequences_and_balances(lengths):
    pieces = list(packing.place(lengths, 64))
    taken, inside = defaultdict(list), defaultdict(list)
    for d, start, n, s, at in pieces:
        taken[d].append((start, n))
        inside[s].append((at, n))
    for key, spans in [*taken.items(), *inside.items()]:
        end = 0
        for a, n in sorted(spans):
            assert a == end and n > 0, key
            end += n
    assert {d: sum(n for _, n in v) for d, v in taken.items()} == {d: n for d, n in enumerate(lengths) if n}
    assert len(inside) == -(-sum(lengths) // 64) and all(sum(n for _, n in v) <= 64 for v in inside.values())


def test_longest_goes_to_the_cheapest():
    assert list(packing.place([60, 30, 20], 64)) == [(0, 0, 60, 0, 0), (1, 0, 30, 1, 0), (2, 0, 20, 1, 30)]


@pytest.mark.parametrize("window", [1 << 21, 700])
def test_packing(awkward, window):
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = defaultdict(list)
    for r in awkward.collect():
        ids[r.doc_id].append(np.array([*tok.encode(r.text or "", add_special_tokens=False).ids, 0], "<u4"))
    rows = packing.packed(awkward, "doc_id", "text", "byte_bpe_50k.json", PLAIN, window=window).collect()
    assert sum(r.length for r in rows) == sum(len(x) for v in ids.values() for x in v)
    fill = Counter()
    for r in rows:
        fill[r.sequence_id] += r.length
        assert any(len(x) == r.doc_tokens and zlib.crc32(x[r.start : r.start + r.length].tobytes()) == r.ids_crc32 for x in ids[r.doc_id])
    assert max(fill.values()) <= 1024


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(max_codepoint=0x24F), max_size=80))
def test_rank_file_gives_the_tokenizers_ids_of_random_strings(text):
    tok = packing._TOKENIZERS.setdefault("byte_bpe_50k.json", Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")))
    assert tok.encode(text, add_special_tokens=False).ids == library(PLAIN).encode_ordinary(text)


def test_added_token_is_read_as_the_tokenizer_file_reads_it():
    ids = packing.tokenize("byte_bpe_50k.json", PLAIN, 0)("a <|endoftext|> b").tolist()
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert ids == [*tok.encode("a <|endoftext|> b", add_special_tokens=False).ids, 0] and 50256 in ids


def test_packing_of_nothing(none):
    assert packing.packed(none, "doc_id", "text", "byte_bpe_50k.json", PLAIN).count() == 0


def test_rank_file_gives_the_tokenizers_ids_below_the_bound():
    """Every character the fast way is used for, in several surroundings."""
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    enc = library(PLAIN)
    for c in map(chr, range(0x250)):
        for text in (f"a{c}b", f" {c}{c} 1{c}", f"{c}\n {c}", f"it{c}'s{c}"):
            assert not packing.ALIKE.search(text) and packing.ADDED not in text and tok.encode(text, add_special_tokens=False).ids == enc.encode_ordinary(text)
