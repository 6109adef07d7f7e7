"""Repeated passages counted in words: against brute force, and through the pipeline's stages of passages."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from tessel.llm import suffix_dedup, word_windows

WORD = re.compile(rb"[^ \t-\r]+")


def without(texts: dict[int, bytes], length: int) -> dict[int, bytes]:
    """The texts without the later copies of ``length`` words, plainly."""
    where, words = defaultdict(list), {d: [m.span() for m in WORD.finditer(t)] for d, t in texts.items()}
    for d in sorted(texts):
        w = words[d]
        for i in range(len(w) - length + 1):
            where[texts[d][w[i][0] : w[i + length - 1][1]]].append((d, i))
    gone = {d: [False] * len(w) for d, w in words.items()}
    for places in where.values():
        for d, i in places[1:]:
            gone[d][i : i + length] = [True] * length
    left = {}
    for d, t in texts.items():
        keep = [True] * len(t)
        for i, (a, z) in enumerate(words[d]):
            if gone[d][i]:
                keep[a : words[d][i + 1][0] if i + 1 < len(words[d]) and gone[d][i + 1] else z] = [False] * ((words[d][i + 1][0] if i + 1 < len(words[d]) and gone[d][i + 1] else z) - a)
        left[d] = bytes(c for c, k in zip(t, keep, strict=True) if k)
    return left


def short_words(n: int, seed: int) -> str:
    return " ".join(random.Random(seed).choices(["a", "of", "to", "in", "it", "is", "we", "do", "so", "no"], k=n))


@pytest.mark.parametrize("size", [1, 60, 1 << 17])
def test_word_runs_cover_every_window_once(size):
    rng = random.Random(5)
    texts = [b"", b" a  b\n", *(b" ".join(rng.choices([b"a", b"bc", b"\n", b"d" * 2100], k=n)) for n in (9, 10, 11, 80, 300)), b"a " * 200]
    text, start, n, anchor, _, _ = word_windows.window_runs(texts, 8, 4, size)
    seen = Counter((t, s + i) for t, s, m in zip(text, start, n, strict=True) for i in range(m))
    assert seen == Counter((t, s) for t, x in enumerate(texts) for s in range(len(x.split()) - 7))
    of = {}
    for t, s, m, a in zip(text, start, n, anchor, strict=True):
        w = [x.span() for x in WORD.finditer(texts[t])]
        for i in range(s, s + m):
            assert of.setdefault(texts[t][w[i][0] : w[i + 7][1]], a) == a


@pytest.mark.parametrize("group_runs", [512, 3, 1])
def test_words_against_brute_force(spark, group_runs):
    rng = random.Random(12)
    pool = [short_words(rng.randrange(3, 40), k) for k in range(10)] + ["x" * 5000, " " * 3000, "\u00e9\u4e2d", "\n\t"]
    rows = [(k, " ".join(rng.choices(pool, k=rng.randrange(0, 7)))) for k in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.text.encode() for r in suffix_dedup.without_repeats(df, "doc_id", "text", length=12, block=6, group_runs=group_runs, words=True).collect()}
    copies = Counter(t for _, t in rows)
    want = without({k: t.encode() for k, t in rows}, 12)
    alone = {k for k, t in rows if copies[t] == 1}
    assert {k: got[k] for k in alone} == {k: want[k] for k in alone}


def test_pipeline_cuts_passages_of_51_short_words(spark):
    """51 words of 100 to 160 bytes, repeated among others; the 50 words of another passage stay."""
    passage, below = short_words(51, 1), short_words(50, 2)
    assert len(passage) < corpus_pipeline.PASSAGE_BYTES and len(passage.split()) == 51
    rows = [(k, " ".join([f"head{k}", passage, f"middle{k}", below, f"tail{k}"]), 0) for k in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long").repartition(3)
    for name, stage in corpus_pipeline.STAGES:
        if "passages" in name:
            docs = stage(spark, docs, "")
    left = {r.doc_id: r for r in docs.collect()}
    assert left[0].text == rows[0][1]
    assert all(left[k].text == f"head{k}  middle{k} {below} tail{k}" for k in range(1, 6))
    assert all(r.n_chars == len(r.text) for r in left.values())
