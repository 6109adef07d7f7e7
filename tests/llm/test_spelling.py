"""Spelling variants against a plain version."""

from __future__ import annotations

import itertools
import random
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings, strategies as st

from tessel.llm import spelling


def one_error(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(rows):
    n = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 199 == 0:
                i = h % len(run)
                run = run[:i] + run[i + 1 :]
            n[run] += 1
    words = [w for w, k in n.items() if k >= 5 and len(w) >= 6]
    near = {w: [v for v in words if one_error(w, v)] for w in words}
    form = {w: min(near[w], key=lambda v: (-n[v], v), default=None) for w in words}
    form = {w: f if f is not None and n[f] >= 5 * n[w] else None for w, f in form.items()}

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {(w, form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in words}


def variants_of(seed: int, words: int) -> list[tuple[int, str]]:
    """Texts of words around few stems, with large and small counts, so that chains of forms occur."""
    rng = random.Random(seed)
    stems = ["colour", "harbour", "signature", "überraschung", "aaaaaa", "abababab", "straßenbahn", "éclairs"]
    made = Counter()
    for stem in stems:
        made[stem] += rng.choice([700, 2000])
        for _ in range(words):
            word = stem
            for _ in range(rng.choice([1, 1, 2, 3])):
                i = rng.randrange(len(word) + 1)
                word = rng.choice([word[:i] + rng.choice("abeé") + word[i:], word[:i] + word[i + 1 :], word[:i] + rng.choice("abcë") + word[i + 1 :]])
            made[word] += rng.choice([4, 5, 6, 30, 150])
    listed = list(made.elements())
    rng.shuffle(listed)
    return [(k, " ".join(x)) for k, x in enumerate(itertools.batched(listed, 500))]


@settings(max_examples=300, deadline=None)
@given(st.text("abc", min_size=3, max_size=9), st.lists(st.text("abc", min_size=2, max_size=10), min_size=1, max_size=40, unique=True), st.integers(0, 4))
def test_index(word, words, half):
    index = spelling.Index(words)
    same, longer, shorter, shared = index.near(word, half)
    picked = lambda bits: {w for k, w in enumerate(words) if bits >> k & 1}
    assert picked(same) == {w for w in words if len(w) == len(word) and one_error(w, word)}
    assert picked(longer) == {w for w in words if len(w) == len(word) + 1 and one_error(w, word)}
    assert picked(shorter) == {w for w in words if len(w) == len(word) - 1 and one_error(w, word)}
    if half < len(word):
        assert picked(shared) == {w for w in words if w[:half] == word[:half]}


@pytest.mark.parametrize("index_words", [1 << 13, 7])
def test_variants(spark, index_words):
    rows = variants_of(1, 60)
    got = spelling.variants(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), "doc_id", "text", index_words).collect()
    expected = plain(rows)
    assert {tuple(r) for r in got} == expected and len(got) == len(expected)
    assert sum(r[2] not in (r[0], r[1]) for r in expected) > 5  # chains of two forms or more


def test_awkward_rows(spark, awkward, none):
    long_ = [(900, "Zebra" * 3 + " " + "x" * 300_000 + " Quagga" + " quaggas colour colours" * 100_000), (None, "colouur colouur Colouur COLOUUR colouur"), (901, "×÷×÷×÷ " * 6)]
    rows = [*((r.doc_id, r.text) for r in awkward.collect()), *long_]
    got = spelling.variants(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text").collect()
    assert {tuple(r) for r in got} == plain(rows) and len(got) > 4
    assert spelling.variants(none, "doc_id", "text").count() == 0
    assert spelling.variants(none, "doc_id", "text").columns == ["word", "form", "root", "n", "n_near", "form_n"]


def test_pairs_are_not_rows(spark):
    """A family of words that are all near each other gives one row a word and block, not one a pair."""
    letters = "abcdefghijklmnopqrstuvwxyzàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"
    vocabulary = spark.createDataFrame([(f"prefix{c}suffix", 5) for c in letters], "word string, n long")
    for index_words in (1 << 13, 10):
        got = spelling.neighbours(vocabulary, index_words)
        assert {r.n_near for r in got.collect()} == {len(letters) - 1} and got.count() == len(letters)
