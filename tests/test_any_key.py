"""Pairs of a join by any key."""

from __future__ import annotations

import random

from tessel.operators import relations as rel


def final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_pairs_of_single_rows_are_not_grouped(spark):
    left = spark.createDataFrame([(i, i % 3, i % 7) for i in range(40)], "l int, k1 int, k2 int")
    right = spark.createDataFrame([(i, i % 3, i % 5) for i in range(30)], "r int, k1 int, k2 int")
    assert "Aggregate" not in final_plan(rel.any_key_join(left, right, ["k1", "k2"], "l", "r"))


def test_any_key_join_with_repeated_ids_and_nulls(spark):
    rng = random.Random(5)
    some = lambda n, m: [(rng.choice([None, *range(m)]), rng.choice([None, 1, 2, 3, 4]), rng.choice([None, 1, 2, 3]), rng.choice([None, 1, 2, 3, 4, 5])) for _ in range(n)]
    for m in (8, 60):
        left, right = some(40, m), some(30, m)
        want = {(a[0], b[0]) for a in left for b in right if any(x is not None and x == y for x, y in zip(a[1:], b[1:]))}
        df = [spark.createDataFrame(rows, f"{i} int, k1 int, k2 int, k3 int") for rows, i in ((left, "l"), (right, "r"))]
        got = [tuple(r) for r in rel.any_key_join(*df, ["k1", "k2", "k3"], "l", "r").collect()]
        assert len(got) == len(set(got)) and set(got) == want
