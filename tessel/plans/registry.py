"""All queries on the reference side, with their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
FLAGSHIP = "lineage_split"


def query(name: str, sql: str | None = None):
    """Register a query, and the SQL that DuckDB runs for it."""

    def put(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f

    return put


from tessel.plans import queries_archive, queries_geometry, queries_ledger, queries_more, queries_rest, queries_release, queries_relations, queries_streaming  # noqa: E402, F401
