"""Suffix dedup, Jaccard join and the pipeline: against brute force, and on awkward input."""

from __future__ import annotations

import random
from collections import Counter

import brute
import corpus_pipeline
import numpy as np
import pytest
from awkward_docs import words
from pyspark.sql import functions as F

from tessel.llm import jaccard_join, suffix_dedup, windows

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("size", [60, 1 << 18])
def test_window_runs_cover_every_window_once(size, monkeypatch):
    monkeypatch.setattr(windows.chunks, "__defaults__", (size,))
    rng = random.Random(3)
    texts = [bytes(rng.choices(b"ab", k=n)) for n in (0, 5, 40, 41, 400, 90)] + [b"a" * 300, b"xyz" * 70]
    text, start, n, anchor, _, _ = windows.window_runs(texts, 40, 20)
    seen = Counter((t, s + i) for t, s, m in zip(text, start, n, strict=True) for i in range(m))
    assert seen == Counter((t, s) for t, x in enumerate(texts) for s in range(len(x) - 39))
    of = {}
    for t, s, m, a in zip(text, start, n, anchor, strict=True):
        for i in range(s, s + m):
            assert of.setdefault(texts[t][i : i + 40], a) == a


@pytest.mark.parametrize("keep", ["none", "first"])
@pytest.mark.parametrize("group_runs", [512, 3, 1])
def test_suffix_dedup(unique, keep, group_runs):
    texts = {r.doc_id: (r.text or "").encode() for r in unique.collect()}
    got = {r.doc_id: tuple(r)[1:] for r in suffix_dedup.cut_report(unique, "doc_id", "text", keep, 60, block=30, group_runs=group_runs).collect()}
    assert got == brute.cut(texts, 60, keep)


def test_suffix_dedup_of_random_overlaps(spark):
    rng = random.Random(11)
    pool = [bytes(rng.choices(b"abcdef", k=rng.randrange(20, 120))).decode() for _ in range(12)]
    rows = [(k, "".join(rng.choices(pool, k=rng.randrange(0, 7)))) for k in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for keep in ("none", "first"):
        got = {r.doc_id: tuple(r)[1:] for r in suffix_dedup.cut_report(df, "doc_id", "text", keep, 50, block=25, group_runs=3).collect()}
        assert got == brute.cut({k: t.encode() for k, t in rows}, 50, keep)


def test_suffix_dedup_of_awkward_rows(awkward, none):
    got = suffix_dedup.without_repeats(awkward, "doc_id", "text", length=60, block=30)
    assert got.columns == awkward.columns and got.count() == awkward.count()
    base = words(80, 1)
    assert sum(r.text == base for r in got.collect()) == 1  # one row of the repeated text stays whole
    assert suffix_dedup.without_repeats(none, "doc_id", "text").count() == 0
    assert suffix_dedup.cut_report(none, "doc_id", "text").count() == 0


def test_jaccard(unique, none):
    texts = {r.doc_id: r.text for r in unique.collect()}
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.components(unique, "doc_id", "text").collect()}
    assert got == brute.components(texts)
    assert jaccard_join.components(none, "doc_id", "text").count() == 0


@pytest.mark.parametrize("common", [(8, 32), (1, 2)])
def test_jaccard_near_the_bound(spark, common, monkeypatch):
    """Chains of edits around the bound, hot passages, short texts; with many and with few common shingles."""
    monkeypatch.setattr(jaccard_join, "COMMON_IN_BATCH", common[0])
    monkeypatch.setattr(jaccard_join, "COMMON", common[1])
    monkeypatch.setattr(jaccard_join, "GROUP_PAIRS", 3)
    rng = random.Random(common[0])
    hot = words(30, 99).split()
    texts = []
    for g in range(12):
        text = words(rng.randrange(4, 90), 200 + g).split() + hot[: rng.randrange(31)]
        for _ in range(9):
            texts.append(" ".join(text))
            text = list(text)
            for _ in range(rng.randrange(4)):
                text[rng.randrange(len(text))] = f"n{rng.randrange(10**6)}"
    rng.shuffle(texts)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.components(df, "doc_id", "text").collect()}
    assert got == brute.components(dict(enumerate(texts)))


def test_one_of_each(awkward, none):
    got = jaccard_join.one_of_each(awkward, "doc_id", "text")
    assert got.columns == awkward.columns
    rows = got.collect()
    base = words(80, 1).lower()
    assert sum((r.text or "").lower().startswith(base[:100]) for r in rows) == 1
    assert Counter(r.doc_id for r in rows if not (r.text or "").split()) == Counter([0, 1, 2, None])
    assert {r.text for r in rows if r.doc_id == 12} == {r.text for r in awkward.collect() if r.doc_id == 12}
    assert jaccard_join.one_of_each(none, "doc_id", "text").count() == 0


def test_long_words_hash_alike():
    word = "y" * ((1 << 20) + 5)
    a, b = jaccard_join.shingle_sets([f"{word} a b c d e f", f"a b c d e f {word}"])
    assert len(np.intersect1d(a, b)) == 2


def test_pipeline_stages_on_awkward_rows(spark, awkward, none):
    for df in (awkward, none):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, df, SMALL)
            if name != "packing":
                df = df.withColumn("n_chars", F.lit(0).cast("long")) if "n_chars" not in df.columns else df
                out = stage(spark, df, SMALL)
                assert out.dtypes == df.dtypes
                df = spark.createDataFrame(out.collect(), out.schema)
            else:
                assert (out.count() == 0) == (df.count() == 0)


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SMALL)
        before = {r.doc_id: r for r in docs.collect()}
        if name != "packing":
            assert out.dtypes == docs.dtypes
        after = out.collect()
        if name == "near_duplicates":
            classes = brute.components({d: r.text for d, r in before.items()})
            assert {r.doc_id for r in after} == {d for d, (n, c) in classes.items() if c == d or not n}
        if name == "passages":
            texts = {d: (r.text or "").encode() for d, r in before.items()}
            gone, by_words = brute.removed(texts, corpus_pipeline.PASSAGE_BYTES, "first"), brute.removed_words(texts, corpus_pipeline.PASSAGE_WORDS)
            gone = {d: [a or b for a, b in zip(gone[d], by_words[d], strict=True)] for d in texts}
            assert {r.doc_id: r.text for r in after} == {d: bytes(c for c, f in zip(t, gone[d], strict=True) if not f).decode(errors="ignore") for d, t in texts.items()}
            assert all(r.n_chars == len(r.text) for r in after)
        docs = spark.createDataFrame(after, out.schema)
    assert docs.agg(F.max(F.col("offset") + F.col("length"))).first()[0] <= 1024
