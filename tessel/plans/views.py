"""The ledger and geometry tables, as views of the given tables.

The operators take any table with the right columns; the registered queries bind them to these views. Each view is one SQL
text that Spark and DuckDB read alike, so that a query and its DuckDB counterpart start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tessel.plans.stages import parts_for
from tessel.plans.tables import table

SQL: dict[str, tuple[tuple[str, ...], str]] = {
    "samples": (("orders",), """
        SELECT o_orderkey AS sample_id, o_custkey % 8 AS campaign_id, o_custkey % 32 AS family_id, o_custkey % 256 AS seed_id,
          CASE o_custkey % 3 WHEN 0 THEN 'natural' WHEN 1 THEN 'architecture' ELSE 'hybrid' END AS scene_type,
          CASE WHEN o_custkey % 3 = 0 THEN NULL WHEN o_orderkey % 4 = 0 THEN 'pure_target' WHEN o_orderkey % 4 = 1 THEN 'light_context'
               WHEN o_orderkey % 4 = 2 THEN 'contextual' ELSE 'environment_rich' END AS mode,
          CASE WHEN o_orderstatus = 'F' THEN 'accepted' WHEN o_orderstatus = 'P' THEN 'provisional_pass' WHEN o_orderkey % 4 = 0 THEN 'ready'
               WHEN o_orderkey % 4 = 1 THEN 'running' WHEN o_orderkey % 4 = 2 THEN 'rejected' ELSE 'deferred' END AS status,
          CASE substring(o_orderpriority, 1, 1) WHEN '1' THEN 'author' WHEN '2' THEN 'refine' WHEN '3' THEN 'review' WHEN '4' THEN 'build' ELSE 'archive' END AS stage,
          CASE WHEN o_orderkey % 11 = 0 THEN 'duplicate' WHEN o_orderkey % 7 = 0 THEN 'geometry' WHEN o_orderkey % 5 = 0 THEN 'visual' END AS reason,
          o_orderkey % 5 AS revision, o_orderdate AS updated_at, o_totalprice AS price,
          concat('g', CAST(o_custkey % 400 AS VARCHAR(20))) AS lineage
        FROM {orders}"""),
    "attempts": (("lineitem",), """
        SELECT l_orderkey AS sample_id, l_linenumber AS attempt_no, l_partkey AS part_id, l_suppkey % 10 AS pool, l_suppkey AS endpoint_id,
          CASE l_linenumber % 3 WHEN 0 THEN 'author' WHEN 1 THEN 'review' ELSE 'refine' END AS role,
          CASE WHEN l_returnflag = 'R' THEN NULL ELSE CAST(round(l_extendedprice * 100) AS BIGINT) END AS cost,
          CASE WHEN l_returnflag = 'N' THEN NULL ELSE CAST(l_quantity AS BIGINT) END AS tokens,
          CASE WHEN l_linestatus = 'F' THEN 'complete' WHEN l_linenumber % 2 = 0 THEN 'running' ELSE 'outcome_unknown' END AS status,
          l_shipdate AS started_at, l_linenumber % 5 AS revision, l_linestatus = 'O' AS occupancy
        FROM {lineitem}"""),
    "ledger": (("events",), """
        SELECT event_id, ts, user_id AS sample_id, user_id % 6 AS campaign_id, event_type AS kind, value, props,
          CASE event_type WHEN 'purchase' THEN 'accepted' WHEN 'error' THEN 'rejected' WHEN 'click' THEN 'running' WHEN 'view' THEN 'ready' ELSE 'deferred' END AS status
        FROM {events}"""),
    "families": (("nation",), """
        SELECT n_nationkey AS family_id, n_name AS name, CASE n_regionkey % 3 WHEN 0 THEN 'natural' WHEN 1 THEN 'architecture' ELSE 'hybrid' END AS scene_type
        FROM {nation}"""),
    "campaigns": (("region",), """
        SELECT r_regionkey AS campaign_id, r_name AS name, 100 + 50 * r_regionkey AS target, 3 + r_regionkey AS api_cap,
          CASE WHEN r_regionkey % 2 = 0 THEN 'running' ELSE 'paused' END AS state
        FROM {region}"""),
    "voxels": (("lineitem",), """
        SELECT l_orderkey - l_orderkey % 20 AS sample_id, l_partkey % 10 AS x, l_suppkey % 6 AS y, (l_linenumber + CAST(l_quantity AS BIGINT)) % 10 AS z,
          max(l_suppkey % 7) AS component_id, max(l_partkey % 4) AS material
        FROM {lineitem} GROUP BY l_orderkey - l_orderkey % 20, l_partkey % 10, l_suppkey % 6, (l_linenumber + CAST(l_quantity AS BIGINT)) % 10"""),
    "strokes": (("lineitem",), """
        SELECT l_orderkey - l_orderkey % 20 AS sample_id, l_orderkey * 1000000000 + l_linenumber * 100000000 + l_partkey * 1000 + l_suppkey AS seq,
          min(l_partkey % 8) AS x0, min(l_partkey % 8 + l_suppkey % 3) AS x1, min(l_suppkey % 5) AS y0, min(l_suppkey % 5 + l_partkey % 2) AS y1,
          min(l_linenumber) AS z0, min(l_linenumber + l_partkey % 3) AS z1,
          min(CASE WHEN l_partkey % 6 = 0 THEN NULL ELSE l_partkey % 4 END) AS material
        FROM {lineitem} GROUP BY l_orderkey - l_orderkey % 20, l_orderkey * 1000000000 + l_linenumber * 100000000 + l_partkey * 1000 + l_suppkey"""),
    "rooms": (("orders",), """
        SELECT o_orderkey - o_orderkey % 20 AS sample_id, o_orderkey % 20 AS room_id, o_custkey % 5 AS x0, o_custkey % 5 + 2 + o_orderkey % 3 AS x1,
          o_custkey % 3 AS y0, o_custkey % 3 + 2 AS y1, o_custkey % 4 AS z0, o_custkey % 4 + 3 + o_orderkey % 2 AS z1
        FROM {orders}"""),
}

#: Views that group a table inside samples: the table and its sample. They are dealt by sample once, in as many parts as the rows
#: ask for; that exchange serves the grouping and whatever groups or ranks inside samples behind it.
BY_SAMPLE = {"voxels": ("lineitem", "l_orderkey - l_orderkey % 20"), "strokes": ("lineitem", "l_orderkey - l_orderkey % 20")}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    sources, text = SQL[name]
    given = {s: table(spark, sf_dir, s) for s in sources}
    if name in BY_SAMPLE:
        source, sample = BY_SAMPLE[name]
        given[source] = given[source].repartition(parts_for(given[source]), F.expr(sample))
    return spark.sql(text, **given)


def parts(spark: SparkSession, sf_dir: str, name: str) -> int:
    """Partitions for exchanges of the view's rows."""
    return parts_for(table(spark, sf_dir, SQL[name][0][0]))


def oracle(body: str, *names: str) -> str:
    """``body`` as DuckDB SQL over the named views."""
    parts = []
    for name in names:
        sources, text = SQL[name]
        parts.append(f"{name} AS ({text.format(**{s: s for s in sources})})")
    return f"WITH {', '.join(parts)}\n{body}" if parts else body
