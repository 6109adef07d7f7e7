"""Alignment of two tokenizers against a plain version over whole texts."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tessel.llm import alignment

A, RANKS, B = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"


def plain(texts):
    """Rows of (n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), all links by comparing all ranges."""
    a, b = Tokenizer.from_file(public_tokenizers.path(A)), sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(B))
    a.encode_special_tokens = True
    letter = {x: k for k, x in alignment.byte_letters().items()}
    assert len(letter) == 256
    entry = {i: bytes(alignment.byte_letters()[c] for c in t) for t, i in a.get_vocab(with_added_tokens=False).items() if t != "<|endoftext|>"}

    def spans(pieces):
        out, at = [], 0
        for p in pieces:
            out.append((at, at + len(p)))
            at += len(p)
        return out

    made = []
    for text in texts:
        whole = (" " + (text or "")).encode()
        ids_a = a.encode(" " + (text or ""), add_special_tokens=False).ids
        ids_b = b.encode(text or "")
        bytes_a = [entry[i] for i in ids_a]
        pieces = [b.id_to_piece(i) for i in ids_b]
        bytes_b = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode() for p in pieces]
        if not text or b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
            made.append(None)
            continue
        sa, sb = spans(bytes_a), spans(bytes_b)
        both = sorted({e for _, e in sa} & {e for _, e in sb})
        groups = [",".join(str(i) for i, (s, e) in zip(ids_a, sa) if lo <= s < hi) + "|" + ",".join(str(i) for i, (s, e) in zip(ids_b, sb) if lo <= s < hi) for lo, hi in zip([0, *both], both)]
        links = [(x, y) for x, (s, e) in zip(ids_a, sa) for y, (s2, e2) in zip(ids_b, sb) if s < e2 and s2 < e]
        made.append((len(ids_a), len(ids_b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    held = Counter(p for m in made if m for p in set(m[3]))
    best = defaultdict(int)
    for (x, _), n in held.items():
        best[x] = max(best[x], n)
    return [(0,) * 6 + ("",) if m is None else (*m[:3], len(m[3]), sum(held[p] == best[p[0]] for p in m[3]), sum(held[p] for p in m[3]), m[4]) for m in made]


@pytest.mark.parametrize("block", [1 << 18, 5])
def test_alignment_of_awkward_rows(awkward, none, block):
    short = awkward.filter("char_length(text) < 5000 or text is null")
    rows = short.collect()
    got = alignment.aligned(short, "doc_id", "text", A, RANKS, B, block_pairs=block).collect()
    assert Counter(map(tuple, got)) == Counter((r.doc_id, *m) for r, m in zip(rows, plain([r.text for r in rows])))
    assert alignment.aligned(none, "doc_id", "text", A, RANKS, B).count() == 0


def test_cuts_give_the_tokens_of_whole_texts(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choice(["a", "be", "the", " ", " ", "  ", "\n", "\t", "é", "日本", "1", "23", ".", "'s", "<s>", "</s>", "<|endoftext|>", "<0x0A>", " ", "　", "ﬁ", "é", "\x00", "\U0003fc3f", "\U0001f600"]) for _ in range(30)) for _ in range(150)]
    texts += ["x▁y", "▁", " ", "  lead", "trail  ", "\r\n\r\n"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.key: tuple(r)[1:] for r in alignment.aligned(df, "doc_id", "text", A, RANKS, B).collect()}
    assert got == dict(enumerate(plain(texts)))
    assert got[150] == got[151] == (0, 0, 0, 0, 0, 0, "")


def test_very_long_texts(spark):
    texts = ["a" * 100_000, " " * 100_000, "日本語" * 30_000, "one two " * 50_000]
    got = {r.key: r for r in alignment.aligned(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "doc_id", "text", A, RANKS, B).collect()}
    a = Tokenizer.from_file(public_tokenizers.path(A))
    assert [got[k].n_a for k in range(4)] == [len(a.encode(" " + t, add_special_tokens=False).ids) for t in texts]
    assert all(got[k].n_links >= max(got[k].n_a, got[k].n_b) for k in range(4))


def test_short_cuts_walk_once(monkeypatch):
    """Groups and links of short cuts are those of the general way, which they do not go any more."""
    import random

    from tessel.llm import alignment

    made = alignment.Aligner("byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "piece_bpe_32k.model")
    rng = random.Random(7)
    cuts = {" " + "".join(rng.choice(["a", "th", "ing", "é", "ß", "日本", "7", "'s", "--", "qz", "😀", "Zur", " "]) for _ in range(rng.randrange(1, 12))) for _ in range(3000)}
    listed = [(c, made.model.encode(c[1:])) for c in sorted(cuts) if len(c) <= alignment.REMEMBERED_CHARS]
    with monkeypatch.context() as patch:
        patch.setattr(alignment, "REMEMBERED_CHARS", 0)
        general = [made.aligned(c, b) for c, b in listed]
    assert sum(x is not None and x[2] < min(x[:2]) for x in general) > 100
    with monkeypatch.context() as patch:
        patch.setattr(alignment, "groups", None)
        short = [made.aligned(c, b) for c, b in listed]
    assert [x and (*x[:4], list(x[4])) for x in short] == [x and (*x[:4], list(x[4])) for x in general]


@pytest.mark.parametrize("window,remembered", [(1 << 22, 1 << 19), (64, 1 << 19), (64, 40)])
def test_cuts_are_aligned_side_by_side(monkeypatch, window, remembered):
    """Texts taken together, in windows, and after cuts were forgotten; plain cuts are not aligned one by one any more."""
    import pyarrow as pa

    rng = random.Random(11)
    parts = ["the", "Zurich", "qzxv", "日本語", "naïve", "é", "à", "x y", " ", "　", "ﬁ", "12", "--", "don't", "😀", "\u0085", " ", "\n", "", "</s>", "\U0003fc3f"]
    texts = [" ".join(rng.choice(parts) for _ in range(rng.randrange(1, 40))) or "a" for _ in range(400)]
    expected = [(*(m[:4] if m[0] else (0,) * 4), m[6]) for m in plain(texts)]
    made = alignment.Aligner(A, RANKS, B)
    monkeypatch.setattr(alignment, "WINDOW_BYTES", window)
    monkeypatch.setattr(alignment, "REMEMBERED", remembered)
    monkeypatch.setattr(alignment, "LEARNED_AT_ONCE", 50)
    asked, general = [], made.aligned
    monkeypatch.setattr(made, "aligned", lambda cut, *rest: asked.append(cut) or general(cut, *rest))
    long = [alignment._long_document(made, alignment._with_blanks(pa.array([t]))[0]) for t in texts]
    assert [(*n, digest) for n, digest, _ in long] == expected
    for i in range(0, len(texts), 100):
        made.trim()
        data, edges = alignment._with_blanks(pa.array(texts[i : i + 100]))
        got = alignment._Window(made, data, edges, alignment._merged(edges[:-1], alignment.cut_starts(data, 0, len(data))))
        assert [(*n, got.digest(k)) for k, n in enumerate(got.numbers.tolist())] == expected[i : i + 100]
        for k, (a, z) in enumerate(zip(got.offsets, got.offsets[1:])):
            assert dict(zip(made.pairs[got.pairs[a:z]].tolist(), got.times[a:z].tolist())) == dict(long[i + k][2])
    assert asked and not {" the", " Zurich", " qzxv", " 日本語", " naïve"} & {*asked}


def test_cuts_lie_where_the_pattern_has_them():
    import numpy as np

    rng = random.Random(13)
    letters = ["a", " ", " ", "é", "\x85", "\xa0", " ", " ", " ", "​", " ", " ", "　", "、", "Å", "х", "…", "\x1c", "\t", "日", "😀"]
    for _ in range(3000):
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(1, 14)))
        places = [len(text[: m.start()].encode()) for m in re.finditer(r"(?<=\S) (?=\S)", text)]
        assert alignment.cut_starts(np.frombuffer(text.encode(), np.uint8), 0, len(text.encode())).tolist() == places
