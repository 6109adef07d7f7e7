"""Semantics of the operators on small fixtures."""

from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tessel.functions import text as fn
from tessel.operators import aggregates as agg, geometry as geo, ledger, quota, ranking, relations as rel, release
from tessel.operators.graph import connected_components
from tessel.streaming import metrics


def _cells(spark, **samples):
    rows = [(k, x, y, z) for k, points in samples.items() for x, y, z in points]
    return spark.createDataFrame(rows, "sample_id string, x int, y int, z int")


L_SHAPE = [(0, 0, 0), (1, 0, 0), (2, 0, 0), (2, 0, 1), (2, 1, 1), (0, 1, 0)]


def _hashes(df, rotations=None):
    return {r.sample_id: r["shape"] for r in geo.shape_hash(df, "sample_id", rotations).collect()}


def test_rotations_are_proper():
    assert len(geo.CUBE) == 24 and len(geo.UPRIGHT) == 4


def test_shape_hashes(spark):
    turned = [(z + 7, y + 1, -x + 9) for x, y, z in L_SHAPE]
    inverted = [(x, -y, -z) for x, y, z in L_SHAPE]
    df = _cells(spark, a=L_SHAPE, b=[(x + 5, y + 3, z) for x, y, z in L_SHAPE], c=turned, d=inverted)
    moved, upright, cube = _hashes(df), _hashes(df, geo.UPRIGHT), _hashes(df, geo.CUBE)
    assert moved["a"] == moved["b"] != moved["c"]
    assert upright["a"] == upright["b"] == upright["c"] != upright["d"]
    assert len(set(cube.values())) == 1


def test_composition_margin_and_extent(spark):
    wall = [("s", x, y, 10, "structure") for x in range(10, 20) for y in range(10, 20)]
    rows = wall + [("s", x, 10, 0, "environment") for x in range(20)] + [("s", 21, 10, 12, "attached"), ("s", 22, 10, 10, "attached")]
    got = geo.composition(spark.createDataFrame(rows, "sample_id string, x int, y int, z int, kind string"), "sample_id", F.col("kind"), 0.1, 0.8).first()
    assert (got.subject, got.environment, got.unclassified) == (101, 20, 1)
    assert got.context_violation and got.extent_violation and not got.subject_missing


def test_strokes_last_wins_and_erases(spark):
    rows = [("s", 1, 0, 2, 0, 0, 0, 0, 1), ("s", 2, 1, 1, 0, 0, 0, 0, None), ("s", 3, 2, 2, 0, 0, 0, 0, 2)]
    df = spark.createDataFrame(rows, "sample_id string, seq int, x0 int, x1 int, y0 int, y1 int, z0 int, z1 int, material int")
    assert {(r.x, r.material) for r in geo.strokes_to_voxels(df, "sample_id", "seq", "material").collect()} == {(0, 1), (2, 2)}


def test_bodies(spark):
    df = spark.createDataFrame([(1, 0, 0, 0), (1, 1, 1, 1), (1, 5, 5, 5), (2, 0, 0, 0)], "sample_id long, x int, y int, z int")
    sizes = sorted((r.sample_id, r.n, r.main) for r in geo.body_sizes(geo.bodies(df, "sample_id"), "sample_id").collect())
    assert sizes == [(1, 1, False), (1, 2, True), (2, 1, True)]


@pytest.mark.parametrize("n, k", [(0, 0), (60, 40), (80, 200)])
def test_connected_components(spark, n, k):
    rng = random.Random(n + k)
    edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(k)] + [(i, i + 1) for i in range(100, 100 + n)]
    root = {x: x for e in edges for x in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            m = min(root[a], root[b])
            changed |= root[a] != m or root[b] != m
            root[a] = root[b] = m
    got = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.component for r in got} == root


def test_apportion_ties_and_negatives(spark):
    rows = [("c", k, w, 10) for k, w in (("b", 1.0), ("a", 1.0), ("d", 1.0), ("e", -4.0))] + [("z", "a", 0.0, 5)]
    got = quota.apportion(spark.createDataFrame(rows, "g string, k string, w double, total int"), ["g"], "k", "w", "total").collect()
    assert {(r.g, r.k): r.quota for r in got} == {("c", "a"): 4, ("c", "b"): 3, ("c", "d"): 3, ("c", "e"): 0}


def test_apportion_two_modes(spark):
    rows = [("h", "contextual", 20.0, 30), ("h", "environment_rich", 10.0, 30)]
    got = quota.apportion(spark.createDataFrame(rows, "g string, k string, w double, total int"), ["g"], "k", "w", "total").collect()
    assert {r.k: r.quota for r in got} == {"contextual": 20, "environment_rich": 10}


def test_debts(spark):
    targets = spark.createDataFrame([("pure", 4), ("contextual", 6)], "mode string, target int")
    stats = spark.createDataFrame([("contextual", 0, 6)], "mode string, accepted int, provisional int")
    got = {r["mode"]: (r.debt, r.candidate_debt) for r in quota.debts(targets, stats, ["mode"]).collect()}
    assert got == {"pure": (4, 4), "contextual": (6, 0)}


def test_null_poisons_tokens(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, None), ("b", None, 3), ("b", 4, 4)], "k string, cost long, tokens long")
    got = {r.k: (r.cost_known, r.cost_unknown, r.tokens, r.cost_shown) for r in ledger.usage(df, ["k"], "cost", "tokens").collect()}
    assert got == {"a": (3, 0, None, 3), "b": (4, 1, 7, None)}


def test_nearest_rank(spark):
    df = spark.createDataFrame([("a", float(i)) for i in range(20)] + [("b", 3.0), ("c", None)], "k string, v double")
    assert {r.k: r.p for r in agg.nearest_rank(df, ["k"], "v", 0.95, "p").collect()} == {"a": 19.0, "b": 3.0}


def test_streaks(spark):
    df = spark.createDataFrame([("f", i, bad) for i, bad in enumerate([True, True, False, True, True, True])], "k string, i int, bad boolean")
    assert [r.streak for r in ranking.streaks(df, ["k"], ["i"], ~F.col("bad")).orderBy("i").collect()] == [1, 2, 0, 1, 2, 3]


def test_same_streak_with_nulls(spark):
    df = spark.createDataFrame([("f", i, e) for i, e in enumerate(["x", "x", None, None, "y"])], "k string, i int, e string")
    assert [r.streak for r in ranking.same_streak(df, ["k"], ["i"], "e").orderBy("i").collect()] == [1, 2, 1, 2, 1]


def test_bounded_shards(spark):
    df = spark.createDataFrame([("r", i, s) for i, s in enumerate([5, 5, 5, 50, 1, 1, 1, 1])], "rel string, i int, size long")
    got = ranking.bounded_shards(df, "rel", ["i"], "size", 3, 12).orderBy("i").collect()
    assert [r["shard"] for r in got] == [0, 0, 1, 2, 3, 3, 3, 4]


def test_shortages_are_not_made_up(spark):
    have = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "m string, i int")
    limits = spark.createDataFrame([("a", 1), ("b", 2), ("c", 1)], "m string, n int")
    assert ranking.quota(have, ["m"], ["i"], limits, "n").count() == 2
    assert {(r.m, r.available) for r in ranking.shortages(have, ["m"], limits, "n").collect()} == {("b", 1), ("c", 0)}


def test_split_bucket(spark):
    want = int(hashlib.sha256(b"split\0g1").hexdigest()[:16], 16) % 10000
    assert spark.range(1).select(release.split_bucket(F.lit("g1")).alias("b")).first().b == want


def test_lineage_merges_through_shared_tokens(spark):
    df = spark.createDataFrame([(1, "s", "v1"), (2, "s", "v2"), (3, "t", "v2"), (4, "u", None)], "id int, src string, vox string")
    got = {r.id: r.lineage_group for r in release.lineage_groups(df, "id", {"src": F.col("src"), "vox": F.col("vox")}).collect()}
    assert got[1] == got[2] == got[3] == "sample:1" and got[4] == "sample:4"


def test_release_verification(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "id int, h string")
    b = spark.createDataFrame([(1, "x"), (2, "Y"), (4, "w")], "id int, h string")
    assert {(r.id, r.finding) for r in release.verified(a, b, ["id"], "h").collect()} == {(2, "altered"), (3, "missing"), (4, "unexpected")}
    release.assert_clean(release.verified(a, a, ["id"], "h"))
    with pytest.raises(ValueError, match="not sound"):
        release.assert_clean(release.verified(a, b, ["id"], "h"))


@pytest.mark.parametrize("state, want", [
    ("oak_log[waterlogged=false,axis=x]", "minecraft:oak_log[axis=x,waterlogged=false]"), ("stone", "minecraft:stone"), ("mod:thing[b=1,a=2]", "mod:thing[a=2,b=1]"), ("Bad Name", None), ("x[axis=", None),
])
def test_block_state(spark, state, want):
    assert spark.createDataFrame([(state,)], "s string").select(fn.block_state(F.col("s")).alias("b")).first().b == want


@pytest.mark.parametrize("mode, observed, focus, extraneous, want", [
    ("pure_target", "pure_target", "dominant", False, (True, True)), ("light_context", "pure_target", "dominant", False, (True, False)), ("pure_target", "pure_target", "co_primary", False, (False, False)),
    ("contextual", "contextual", "co_primary", False, (True, True)), ("contextual", None, "dominant", False, (None, None)), ("contextual", "contextual", "absent", False, (False, False)), ("contextual", "contextual", "unclear", True, (None, None)),
])
def test_compliance(spark, mode, observed, focus, extraneous, want):
    df = spark.createDataFrame([(mode, observed, focus, extraneous)], "m string, o string, f string, e boolean")
    args = [F.col(c) for c in "mofe"]
    assert tuple(df.select(fn.within_allowance(*args), fn.complies(*args)).first()) == want


def test_any_key_join_and_full_merge(spark):
    left = spark.createDataFrame([(1, "a", "p"), (2, "b", "q")], "l int, k1 string, k2 string")
    right = spark.createDataFrame([(7, "a", "p"), (8, "x", "q"), (9, None, None)], "r int, k1 string, k2 string")
    assert {tuple(r) for r in rel.any_key_join(left, right, ["k1", "k2"], "l", "r").collect()} == {(1, 7), (2, 8)}
    t = spark.createDataFrame([("n", None, 5)], "s string, m string, target int")
    g = spark.createDataFrame([("n", None, 2), ("n", "c", 1)], "s string, m string, made int")
    assert {tuple(r) for r in rel.full_merge(t, g, ["s", "m"], ["target", "made"]).collect()} == {("n", None, 5, 2), ("n", "c", 0, 1)}


def test_stream_equals_table_for_closed_minutes(spark, tmp_path):
    rows = [(i, f"2024-01-01 00:{i // 4:02d}:{i % 4 * 15:02d}", i % 2, "error" if i % 3 else "view", float(i)) for i in range(120)]
    df = spark.createDataFrame(rows, "id long, ts string, pool int, event_type string, value double").withColumn("ts", F.col("ts").cast("timestamp"))
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    made = lambda d: metrics.minute_counters(d, ["pool"], "ts", "event_type", ["error", "view"])
    stream = {tuple(r) for r in metrics.replay(spark, str(tmp_path / "in"), df.schema, made).collect()}
    whole = {tuple(r) for r in made(df).collect()}
    assert stream and stream <= whole


def test_adaptive_cap(spark):
    """Too soon twice, raised, too soon, lowered, held, too few, raised by what gathered; and never below 1."""
    rows = [(1, 0, 0, 20, 20), (1, 60, 0, 20, 20), (1, 130, 0, 5, 5), (1, 200, 3, 26, 29), (1, 260, 0, 1, 1), (1, 400, 1, 27, 30), (1, 530, 0, 10, 10), (1, 540, 0, 20, 20)]
    df = spark.createDataFrame(rows, "p long, at long, bad long, done long, n long")
    got = metrics.adaptive_cap(df, "p", "at", "bad", "done", "n").orderBy("batch_at").collect()
    assert [r.cap for r in got] == [128, 128, 160, 160, 112, 112, 112, 140]
    low = metrics.adaptive_cap(df.filter("at IN (0, 200, 260)").withColumn("bad", F.col("n")), "p", "at", "bad", "done", "n", start=1).collect()
    assert {r.cap for r in low} == {1}


@pytest.mark.parametrize("content, want", [("```python\nx = 1\n```", "x = 1"), ("  ```\na\nb\n```\n", "a\nb"), ("text ```\nx\n```", None), ("```\nx", None), ("```\na\n```\n```\nb\n```", None), (None, None)])
def test_fenced_source(spark, content, want):
    assert spark.createDataFrame([(content,)], "s string").select(fn.fenced_source(F.col("s")).alias("b")).first().b == want


def test_source_policy(spark):
    rows = {"x = 1": None, "import os": "import", "eval('1')": "banned:eval", "().__class__": "reflection", "def f(:": "syntax", None: "missing"}
    got = spark.createDataFrame([(s,) for s in rows], "s string").select("s", fn.source_policy(F.col("s")).alias("p")).select("s", "p.*").collect()
    assert {r.s: r.reason for r in got} == rows and all(r.ok == (r.reason is None) for r in got)


def test_uuid5(spark):
    import uuid

    space = "6ba7b811-9dad-11d1-80b4-00c04fd430c8"
    got = spark.createDataFrame([("a/b",), ("é",)], "s string").select("s", fn.uuid5(space, F.col("s")).alias("u")).collect()
    assert {r.s: r.u for r in got} == {s: str(uuid.uuid5(uuid.UUID(space), s)) for s in ("a/b", "é")}


def test_redaction_and_tags(spark):
    r = spark.sql("SELECT map('url', 'u', 'apiKey', 's', 'TOKEN', null) AS m, array('a:b:c', 'd') AS t").select(fn.redacted(F.col("m")).alias("m"), fn.tags_as_pairs(F.col("t")).alias("t")).first()
    assert r.m == {"url": "u", "apiKey": "***", "TOKEN": None} and [tuple(x) for x in r.t] == [("a", "b:c"), ("d", None)]


def test_binary_hashes(spark):
    import random as r
    import struct

    from tessel.operators import binary_hashes as bh

    rows = [("a", x, y, z, "m:stone" if x else "m:log[axis=x]") for x, y, z in L_SHAPE]
    shuffled = [("b", *row[1:]) for row in r.Random(1).sample(rows, len(rows))]
    turned = [("c", z + 3, y, -x + 9, s) for _, x, y, z, s in rows]
    inverted = [("d", x, 9 - y, 9 - z, s) for _, x, y, z, s in rows]
    df = spark.createDataFrame([*rows, *shuffled, *turned, *inverted], "sample_id string, x int, y int, z int, state string")
    got = {h.sample_id: h for h in bh.binary_hashes(df, "sample_id", "state", "v", "s", "t").collect()}
    assert got["a"][1:] == got["b"][1:] and got["a"].shift_hash != got["c"].shift_hash
    assert got["a"].upright_hash == got["c"].upright_hash != got["d"].upright_hash and got["a"].cube_hash == got["d"].cube_hash
    cells = sorted(L_SHAPE)
    names = b'["m:log[axis=x]","m:stone"]'
    body = b"v\0" + struct.pack("<3H", 256, 256, 256) + struct.pack("<Q", len(names)) + names + struct.pack("<Q", 6) + b"".join(struct.pack("<3H", *c) for c in cells) + b"".join(struct.pack("<I", c[0] > 0) for c in cells)
    assert got["a"].voxel_hash == hashlib.sha256(body).hexdigest()
    assert got["a"].shift_hash == hashlib.sha256(b"s\0" + struct.pack("<Q", 6) + b"".join(struct.pack("<3i", *c) for c in cells)).hexdigest()


def _text_hash(cells, rotations):
    texts = []
    for rotation in rotations:
        turned = [tuple(s * c[a] for a, s in rotation) for c in cells]
        low = [min(c[i] for c in turned) for i in range(3)]
        texts.append(";".join(",".join(map(str, c)) for c in sorted(tuple(v - l for v, l in zip(c, low, strict=True)) for c in turned)))
    return hashlib.sha256(min(texts).encode()).hexdigest()


def _shapes():
    """Small and wide samples, cells below 0, and shapes whose rotations differ in the last cell or the number of digits only."""
    rng = random.Random(11)
    out = {k: {(rng.randrange(-w, w), rng.randrange(h), rng.randrange(w)) for _ in range(rng.randrange(1, 12))} for k, (w, h) in enumerate([(2, 2), (3, 2), (12, 3), (12, 12), (101, 101), (300, 11)] * 6)}
    return out | {100: {(0, 0, 0)}, 101: {(0, 0, 0), (0, 0, 12)}, 102: {(0, 0, 0), (0, 0, 1), (0, 0, 12)}, 103: {(0, 0, 0), (9, 10, 100)}}


def test_shape_hashes_of_many_samples_at_once(spark):
    shapes = _shapes()
    rows = [(k, *c) for k, cells in shapes.items() for c in cells]
    df = spark.createDataFrame([*rows, rows[0]], "sample_id long, x int, y int, z int").repartition(2)
    for rotations in (None, geo.UPRIGHT, geo.CUBE):
        hashed = geo.shape_hash(df, "sample_id", rotations)
        assert "collect_list" not in hashed._jdf.queryExecution().optimizedPlan().toString()
        assert {r.sample_id: (r.n_voxels, r["shape"]) for r in hashed.collect()} == {k: (len(c), _text_hash(c, rotations or [((0, 1), (1, 1), (2, 1))])) for k, c in shapes.items()}


def test_binary_hashes_of_many_samples_at_once(spark):
    import numpy as np

    from tessel.operators import binary_hashes as bh

    shapes = {k: sorted((x + 300, y, z) for x, y, z in c) for k, c in _shapes().items()}
    states = {k: [f"s{(x + k) % 3}\u00e9" for x, _, _ in c] for k, c in shapes.items()}
    df = spark.createDataFrame([(k, *c, s) for k in shapes for c, s in zip(shapes[k], states[k], strict=True)], "sample_id long, x int, y int, z int, state string").repartition(2)
    hashed = bh.binary_hashes(df, "sample_id", "state", "v", "s", "t")
    assert "FlatMapGroups" not in hashed._jdf.queryExecution().optimizedPlan().toString()
    for r in hashed.collect():
        cells = np.array(shapes[r.sample_id], np.int64)
        assert tuple(r)[1:] == (bh.voxel_digest(cells, states[r.sample_id], "v"), bh.shape_digest(cells, "s"), bh.shape_digest(cells, "t", geo.CUBE), bh.shape_digest(cells, "t", geo.UPRIGHT))
