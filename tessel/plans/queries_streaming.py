"""Streaming metrics, run over the events table (as a table, or replayed as a stream)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tessel.plans.registry import query
from tessel.plans.tables import table
from tessel.plans.views import view
from tessel.streaming import metrics

KINDS = ["click", "error", "purchase", "signup", "view"]
_MINUTES = """
WITH m AS (SELECT date_trunc('minute', ts) AS minute, user_id % 6 AS pool, ts, event_type, value FROM events)
SELECT minute, pool, {counts}, arg_max(value, ts) AS last_value FROM m GROUP BY minute, pool""".format(counts=", ".join(f"count(*) FILTER (event_type = '{k}') AS {k}" for k in KINDS))


@query("str_minute_counters", _MINUTES)
def _(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").withColumn("pool", F.col("user_id") % 6)
    return metrics.minute_counters(events, ["pool"], "ts", "event_type", KINDS)


@query("str_minute_counters_replayed")
def _(spark: SparkSession, sf: str) -> DataFrame:
    """The same as a stream; the last minutes stay open behind the watermark."""
    schema = table(spark, sf, "events").schema
    return metrics.replay(spark, sf, schema, lambda s: metrics.minute_counters(s.withColumn("pool", F.col("user_id") % 6), ["pool"], "ts", "event_type", KINDS), glob="events.parquet")


@query("str_sliding_counts", """
WITH w AS (SELECT event_type, unnest([date_trunc('minute', ts) - INTERVAL 1 MINUTE * k + INTERVAL 5 MINUTE for k in range(0, 5)]) AS until FROM events)
SELECT until, event_type, count(*) AS n FROM w GROUP BY until, event_type""".replace("[date_trunc('minute', ts) - INTERVAL 1 MINUTE * k + INTERVAL 5 MINUTE for k in range(0, 5)]", "list_transform(range(0, 5), lambda k: date_trunc('minute', ts) - to_minutes(k) + INTERVAL 5 MINUTE)"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.sliding_counts(table(spark, sf, "events"), ["event_type"], "ts", "5 minutes", "1 minute")


@query("str_adaptive_cap")
def _(spark: SparkSession, sf: str) -> DataFrame:
    e = view(spark, sf, "ledger").withColumn("at", F.floor(F.unix_timestamp("ts") / 60) * 60)
    failed = F.count(F.when(F.col("kind") == "error", 1))
    minutes = e.groupBy("campaign_id", "at").agg(failed.alias("failed"), (F.count("*") - failed).alias("complete"), F.count("*").alias("results"))
    return metrics.adaptive_cap(minutes, "campaign_id", "at", "failed", "complete", "results")
