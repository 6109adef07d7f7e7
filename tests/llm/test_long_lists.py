"""Long lists of the Jaccard join: all pairs that the caps allow, in bounded groups, and no more than the lists grow."""

from __future__ import annotations

import random

import brute
import numpy as np
import pytest
from awkward_docs import words

from tessel.llm import jaccard_join


def plain(size, cap, label, side) -> set[tuple[int, int]]:
    n = range(len(size))
    return {(i, j) for j in n for i in range(j) if size[i] <= cap[j] and size[j] <= cap[i] and label[i] != label[j] and (side[i] != side[j] or side[i] == -1)}


@pytest.mark.parametrize("block", [7, 1024])
def test_fitting_pairs(block, monkeypatch):
    monkeypatch.setattr(jaccard_join, "LIST_BLOCK", block)
    rng = random.Random(block)
    for classes in (1, 2, 5, 90):
        size = np.array(sorted(rng.randrange(50, 120) for _ in range(150)))
        cap = jaccard_join.caps(size, np.array([rng.randrange(12) for _ in size]), 80)
        label, side = (np.array([rng.randrange(a, k) for _ in size]) for a, k in ((0, classes), (-1, 2)))
        got = [z for x, y in jaccard_join.fitting_pairs(size, cap, label, side) for z in zip(x.tolist(), y.tolist(), strict=True)]
        assert set(got) == plain(size, cap, label, side) and len(set(got)) == len(got)


def test_caps():
    """A pair whose first common shingle lies at these places is linked at most up to the cap."""
    for n in range(1, 60):
        for pos in range(n):
            cap = int(jaccard_join.caps(np.array([n]), np.array([pos]), 80)[0])
            room = n - pos
            fits = [m for m in range(1, 100) if 100 * min(room, m) >= 80 * (n + m - min(room, m))]
            assert all(m <= cap for m in fits) and (cap not in range(room, 100) or cap in fits or not fits)


def test_possible_pairs_keep_every_link(spark):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, 3000, np.int64).view(np.uint64)
    sets = [np.unique(np.concatenate([base[: n - k], rng.integers(0, 1 << 63, k, np.int64).view(np.uint64)])) for n in (1, 5, 31, 33, 64, 65, 120, 129, 146, 900, 1024, 1100) for k in range(0, n // 2 + 1, max(1, n // 20))]
    docs = spark.createDataFrame([], "doc_id long, text string")
    rows = spark.createDataFrame([(k, k, len(s), jaccard_join.sketch(s).tolist()) for k, s in enumerate(sets)], "doc_id long, key long, size long, sketch array<long>")
    pairs = [(i, j, len(sets[i]), len(sets[j])) for j in range(len(sets)) for i in range(j) if len(sets[i]) <= 2 * len(sets[j]) <= 4 * len(sets[i])]
    left = {(r.x, r.y) for r in jaccard_join.Answers(docs, rows, 5).possible(spark.createDataFrame(pairs, "x long, y long, nx int, ny int"), 80).collect()}
    both = {(i, j): len(np.intersect1d(sets[i], sets[j])) for i, j, _, _ in pairs}
    links = {p for p, o in both.items() if 100 * o >= 80 * (len(sets[p[0]]) + len(sets[p[1]]) - o)}
    far = {p for p, o in both.items() if 100 * o < 65 * (len(sets[p[0]]) + len(sets[p[1]]) - o) and len(sets[p[0]]) > 60}
    assert links <= left and len(far & left) < len(far) / 50


@pytest.mark.parametrize("chunk", [3, 10, 1000])
def test_cross_pairs_of_a_long_list(spark, chunk):
    rng = random.Random(chunk)
    rows = [(t, 100 + k % 3, k, rng.randrange(6), k % 4 if k % 3 else 0) for t in (1, 2) for k in range(60)]
    lists = spark.createDataFrame(rows, "token long, size int, key long, pos int, label long")
    got = {(r.x, r.y): r.c for r in jaccard_join.cross_pairs(lists, 80, chunk).collect()}
    want = {}
    for a in rows:
        for b in rows:
            room = min(a[1] - a[3], b[1] - b[3])
            if a[0] == b[0] and a[4] != b[4] and (a[1], a[2]) < (b[1], b[2]) and 100 * room >= 80 * (a[1] + b[1] - room):
                want[a[2], b[2]] = want.get((a[2], b[2]), 0) + 1
    assert got == want


def near_copies(members: int) -> list[str]:
    rng = random.Random(members)
    base = words(150, 77).split()
    out = []
    for k in range(members):
        text = list(base)
        for at in rng.sample(range(len(text)), rng.randrange(1, 8)):
            text[at] = f"m{k}x{at}"
        out.append(" ".join(text))
    return [" ".join(base), *out]


def test_pairs_grow_with_a_group_of_near_copies(spark, monkeypatch):
    made = []
    true = jaccard_join.cross_pairs

    def counted(known, percent, chunk=jaccard_join.CHUNK):
        out = true(known, percent, chunk)
        made.append(out.count())
        return out

    monkeypatch.setattr(jaccard_join, "cross_pairs", counted)
    for members in (100, 200, 400):
        texts = dict(enumerate(near_copies(members)))
        df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.components(df, "doc_id", "text").collect()}
        if members < 400:
            assert got == brute.components(texts)
    assert all(n <= 5 * members for n, members in zip(made, (100, 200, 400), strict=True)), made


def unlinked_copies(members: int) -> list[str]:
    """Texts of 1000 words, 20 of them changed in each: about 0.68 alike, so that none are linked."""
    rng = random.Random(members)
    base = words(1000, 78).split()
    out = []
    for k in range(members):
        text = list(base)
        for at in rng.sample(range(len(text)), 20):
            text[at] = f"u{k}x{at}"
        out.append(" ".join(text))
    return out


def test_pairs_grow_with_a_group_that_does_not_link(spark, monkeypatch):
    made = []
    for name in ("cross_pairs", "group_pairs"):

        def counted(known, percent, chunk=jaccard_join.CHUNK, true=getattr(jaccard_join, name)):
            out = true(known, percent, chunk)
            made.append(out.count())
            return out

        monkeypatch.setattr(jaccard_join, name, counted)
    for members in (100, 200, 400):
        texts = dict(enumerate(unlinked_copies(members)))
        df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
        got = {r.doc_id: r.component_id for r in jaccard_join.components(df, "doc_id", "text").collect()}
        assert got == {k: k for k in texts}
    sums = [a + b for a, b in zip(made[::2], made[1::2], strict=True)]
    assert all(n <= 5 * members for n, members in zip(sums, (100, 200, 400), strict=True)), made


@pytest.mark.parametrize("chunk", [3, 1000])
def test_group_pairs_keep_every_link(spark, chunk):
    rng = np.random.default_rng(chunk)
    base = rng.integers(0, 1 << 63, 300, np.int64).view(np.uint64)
    sets = [np.unique(np.concatenate([base[: n - k], rng.integers(0, 1 << 63, k, np.int64).view(np.uint64)])) for n in (1, 5, 31, 60, 65, 120, 129, 146, 280) for k in range(0, n // 2 + 1, max(1, n // 12))]
    rows = [(7, len(s), k, 0, k % 5, jaccard_join.sketch(s).tolist()) for k, s in enumerate(sets)]
    members = spark.createDataFrame(rows, "token long, size int, key long, pos int, label long, sketch array<long>")
    got = {(r.x, r.y): r.c for r in jaccard_join.group_pairs(members, 80, chunk).collect()}
    n, both = range(len(sets)), lambda i, j: len(np.intersect1d(sets[i], sets[j]))
    links = {(i, j) for j in n for i in n if (len(sets[i]), i) < (len(sets[j]), j) and i % 5 != j % 5 and 100 * both(i, j) >= 80 * (len(sets[i]) + len(sets[j]) - both(i, j))}
    assert links <= got.keys() and all(c >= both(*p) for p, c in got.items())
    assert all(i % 5 != j % 5 for i, j in got) and len(got) < len(sets) ** 2 / 4


def test_most_shared_counts_all_bits():
    """The sign bit of a word is one bit like the others."""
    words_ = [np.array([0], np.int64), np.array([-1 << 63], np.int64), np.array([-1], np.int64), np.array([-3, 5], np.int64)]
    bound = jaccard_join.most_shared(np.array([40, 40, 40, 70]), words_)
    assert bound(np.array([0, 0, 1, 0]), np.array([1, 2, 2, 3])).tolist() == [39, 8, 8, 24]
