"""Every registered query against its DuckDB counterpart on the smallest tables."""

from __future__ import annotations

import math

import duckdb
import pytest

import __spark_entry__ as entry
from tessel.plans import registry

SMALL = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _plain(value):
    if isinstance(value, bool) or value is None:
        return str(value)
    if isinstance(value, (int, float)):
        return f"{float(value):.12g}" if math.isfinite(value) else str(value)
    return str(value)


def same_rows(spark, f, sql: str) -> None:
    df = f(spark, SMALL)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    order = sorted(names)
    want = sorted(tuple(_plain(dict(zip(names, row, strict=True))[c]) for c in order) for row in cursor.fetchall())
    got = sorted(tuple(_plain(r[c]) for c in order) for r in df.collect())
    assert got == want


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_matches_duckdb(spark, name):
    same_rows(spark, registry.QUERIES[name], registry.ORACLE[name])


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLE)))
def test_runs(spark, name):
    assert registry.QUERIES[name](spark, SMALL).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
