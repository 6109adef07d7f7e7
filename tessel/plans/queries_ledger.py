"""Ledger accounting and state over the views of the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tessel.operators import ledger, relations as rel
from tessel.plans.registry import query
from tessel.plans.views import oracle, view


@query("led_usage", oracle("""
, u AS (SELECT sample_id, role, count(*) AS requests, coalesce(sum(cost), 0)::BIGINT AS cost_known, count(*) FILTER (cost IS NULL) AS cost_unknown, CASE WHEN count(tokens) = count(*) THEN sum(tokens)::BIGINT END AS tokens FROM attempts GROUP BY sample_id, role)
SELECT *, CASE WHEN cost_unknown = 0 THEN cost_known END AS cost_shown FROM u""", "attempts"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return ledger.usage(view(spark, sf, "attempts"), ["sample_id", "role"], "cost", "tokens")


@query("led_latest_state", oracle("SELECT sample_id, status, value, event_id FROM (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY ts DESC, event_id DESC) AS n FROM ledger) WHERE n = 1", "ledger"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return ledger.latest_state(view(spark, sf, "ledger"), "sample_id", ["ts", "event_id"], ["status", "value", "event_id"])


@query("led_drop_stale", oracle("SELECT a.sample_id, a.attempt_no, a.part_id FROM attempts a JOIN samples s ON a.sample_id = s.sample_id AND a.revision = s.revision WHERE s.status <> 'rejected'", "attempts", "samples"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    current = view(spark, sf, "samples").filter("status <> 'rejected'")
    return ledger.drop_stale(view(spark, sf, "attempts"), current, "sample_id", "revision").select("sample_id", "attempt_no", "part_id")


@query("led_unapplied", oracle("SELECT sample_id, attempt_no, part_id FROM attempts a WHERE status = 'complete' AND NOT EXISTS (SELECT 1 FROM samples s WHERE s.sample_id = a.sample_id AND s.status = 'accepted')", "attempts", "samples"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    applied = view(spark, sf, "samples").filter("status = 'accepted'")
    return ledger.unapplied(view(spark, sf, "attempts").filter("status = 'complete'"), applied, ["sample_id"]).select("sample_id", "attempt_no", "part_id")


@query("led_change_history", oracle("""
, c AS (SELECT event_id, sample_id, ts, status, lag(status) OVER w AS p, row_number() OVER w AS n FROM ledger WINDOW w AS (PARTITION BY sample_id ORDER BY ts, event_id))
SELECT event_id, sample_id, ts, status, row_number() OVER w::INT AS revision_no, lead(ts) OVER w AS valid_to FROM c WHERE n = 1 OR status IS DISTINCT FROM p WINDOW w AS (PARTITION BY sample_id ORDER BY ts, event_id)""".replace("row_number() OVER w::INT", "CAST(row_number() OVER w AS INT)"), "ledger"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return ledger.change_history(view(spark, sf, "ledger").select("event_id", "sample_id", "ts", "status"), "sample_id", ["ts", "event_id"], "status")


@query("led_admission", oracle("""
, n AS (SELECT pool, count(*) FILTER (occupancy) AS busy FROM attempts GROUP BY pool)
SELECT a.sample_id, a.attempt_no, a.part_id, CASE WHEN a.revision <> s.revision THEN 'stale_revision' WHEN s.status IN ('accepted', 'rejected') THEN 'closed' WHEN coalesce(n.busy > 3000, FALSE) THEN 'pool_full' WHEN a.tokens IS NULL THEN 'no_estimate' ELSE 'admitted' END AS decision
FROM attempts a JOIN samples s USING (sample_id) LEFT JOIN n USING (pool)""", "attempts", "samples"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    a, s = view(spark, sf, "attempts"), view(spark, sf, "samples").select("sample_id", F.col("revision").alias("now"), F.col("status").alias("state"))
    busy = a.groupBy("pool").agg(F.count(F.when(F.col("occupancy"), 1)).alias("busy"))
    rules = [("stale_revision", F.col("revision") != F.col("now")), ("closed", F.col("state").isin("accepted", "rejected")), ("pool_full", F.col("busy") > 3000), ("no_estimate", F.col("tokens").isNull())]
    return ledger.admission(a.join(s, "sample_id").join(busy, "pool", "left"), rules).select("sample_id", "attempt_no", "part_id", "decision")


@query("led_hysteresis", oracle("""
, m AS (SELECT event_id, campaign_id, ts, CASE WHEN value > 80 THEN TRUE WHEN value < 20 THEN FALSE END AS mark FROM ledger)
SELECT event_id, campaign_id, coalesce(last_value(mark IGNORE NULLS) OVER (PARTITION BY campaign_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), FALSE) AS pressed FROM m""", "ledger"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return ledger.hysteresis(view(spark, sf, "ledger"), ["campaign_id"], ["ts", "event_id"], "value", 80, 20).select("event_id", "campaign_id", "pressed")


@query("led_command_conflicts", oracle("SELECT lineage, count(*) AS uses, count(DISTINCT concat(stage, '/', status)) AS bodies, count(DISTINCT concat(stage, '/', status)) > 1 AS conflict FROM samples GROUP BY lineage", "samples"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return ledger.conflicts(view(spark, sf, "samples"), "lineage", F.concat_ws("/", "stage", "status"))


@query("led_cooldowns", oracle("SELECT pool, max(started_at) AS until FROM attempts WHERE status = 'outcome_unknown' GROUP BY pool", "attempts"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return ledger.cooldowns(view(spark, sf, "attempts").filter("status = 'outcome_unknown'"), "pool", "started_at")


@query("led_newest_snapshots", oracle("""
, m AS (SELECT event_id, campaign_id, value, max(value) OVER (PARTITION BY campaign_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM ledger)
SELECT event_id, campaign_id, value FROM m WHERE before IS NULL OR value > before""", "ledger"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return ledger.newest_snapshots(view(spark, sf, "ledger"), "campaign_id", ["ts", "event_id"], "value").select("event_id", "campaign_id", "value")


@query("led_late_results", oracle("""
, r AS (SELECT sample_id, attempt_no, part_id, cost, row_number() OVER (PARTITION BY sample_id, attempt_no ORDER BY CASE WHEN cost IS NULL THEN 1 ELSE 0 END, started_at, part_id) AS n FROM attempts)
SELECT sample_id, attempt_no, part_id, cost FROM r WHERE n = 1""", "attempts"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    a = view(spark, sf, "attempts")
    keys = a.select("sample_id", "attempt_no").distinct()
    return rel.first_match(keys, a, ["sample_id", "attempt_no"], [F.col("cost").isNull().cast("int"), F.col("started_at"), F.col("part_id")], ["part_id", "cost"])
