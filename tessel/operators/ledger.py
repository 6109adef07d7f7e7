"""Ledger accounting and state from ordered events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tessel.operators.aggregates import count_where, sum_or_null


def usage(attempts: DataFrame, keys: list[str], cost: str, tokens: str) -> DataFrame:
    """Requests, known cost, requests of unknown cost, and tokens; tokens are null if any request lacks them."""
    return attempts.groupBy(*keys).agg(
        F.count("*").alias("requests"), F.coalesce(F.sum(cost), F.lit(0)).alias("cost_known"), count_where(F.col(cost).isNull()).alias("cost_unknown"), sum_or_null(F.col(tokens)).alias("tokens"),
    ).withColumn("cost_shown", F.when((F.col("requests") > 0) & (F.col("cost_unknown") == 0), F.col("cost_known")))


def latest_state(events: DataFrame, key: str, order: list[str], take: list[str]) -> DataFrame:
    """The last event's columns for each key."""
    last = events.groupBy(key).agg(F.max_by(F.struct(*take), F.struct(*order)).alias("s"))
    return last.select(key, *[F.col(f"s.{t}").alias(t) for t in take])


def drop_stale(results: DataFrame, current: DataFrame, key: str, version: str) -> DataFrame:
    """Results that carry their key's current version."""
    return results.join(current.select(key, version), [key, version], "left_semi")


def unapplied(responses: DataFrame, applied: DataFrame, keys: list[str]) -> DataFrame:
    """Saved responses that were never applied."""
    return responses.join(applied.select(*keys).distinct(), keys, "left_anti")


def change_history(df: DataFrame, key: str, order: list[str], value: str) -> DataFrame:
    """Rows at which the value changes, numbered from 1: a slowly changing dimension of type 2, with its end."""
    w = W.partitionBy(key).orderBy(*order)
    changed = df.withColumn("__p", F.lag(value).over(w)).withColumn("__n", F.row_number().over(w)).filter((F.col("__n") == 1) | ~F.col(value).eqNullSafe(F.col("__p")))
    return changed.withColumns({"revision_no": F.row_number().over(w), "valid_to": F.lead(order[0]).over(w)}).drop("__p", "__n")


def admission(candidates: DataFrame, rules: list[tuple[str, Column]]) -> DataFrame:
    """Each candidate with the first rule that turns it away, or admitted."""
    reason = F.lit("admitted")
    for name, bad in reversed(rules):
        reason = F.when(F.coalesce(bad, F.lit(False)), name).otherwise(reason)
    return candidates.withColumn("decision", reason)


def hysteresis(df: DataFrame, keys: list[str], order: list[str], value: str, on: float, off: float) -> DataFrame:
    """A switch that goes on above one bound and off below another, keeping its state in between."""
    mark = F.when(F.col(value) > on, True).when(F.col(value) < off, False)
    w = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    return df.withColumn("pressed", F.coalesce(F.last(mark, ignorenulls=True).over(w), F.lit(False)))


def conflicts(df: DataFrame, key: str, body: Column) -> DataFrame:
    """Keys used for more than one body, with their uses."""
    return df.groupBy(key).agg(F.count("*").alias("uses"), F.countDistinct(body).alias("bodies")).withColumn("conflict", F.col("bodies") > 1)


def cooldowns(df: DataFrame, pool: str, deadline: str) -> DataFrame:
    """The latest deadline of each pool."""
    return df.groupBy(pool).agg(F.max(deadline).alias("until"))


def newest_snapshots(df: DataFrame, key: str, arrival: list[str], version: str) -> DataFrame:
    """Snapshots accepted by a reader that takes only strictly newer ones, in order of arrival."""
    w = W.partitionBy(key).orderBy(*arrival).rowsBetween(W.unboundedPreceding, -1)
    return df.withColumn("__m", F.max(version).over(w)).filter(F.col("__m").isNull() | (F.col(version) > F.col("__m"))).drop("__m")


def chunk_fold(chunks: DataFrame, key: str, order: str, text: str, usage: str, finish: str) -> DataFrame:
    """Response of each key from its chunks in order: texts joined, last known usage and finish reason.

    A response is bounded by its source (32 MiB), so that its chunks form one row.
    """
    rows = F.sort_array(F.collect_list(F.struct(order, text)))
    last = lambda c: F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(order)))
    return chunks.groupBy(key).agg(F.array_join(F.transform(rows, lambda r: F.coalesce(r[text], F.lit(""))), "").alias("content"), last(usage).alias("usage"), last(finish).alias("finish"))


def receipt_faults(events: DataFrame, receipt: str, kind: str) -> DataFrame:
    """Receipts dispatched more than once, settled without dispatch, or dispatched without reservation."""
    n = events.groupBy(receipt).agg(*[count_where(F.col(kind) == k).alias(k) for k in ("reserved", "dispatched", "settled")])
    fault = F.when(F.col("dispatched") > 1, "dispatched_twice").when((F.col("settled") > 0) & (F.col("dispatched") == 0), "settled_undispatched").when((F.col("dispatched") > 0) & (F.col("reserved") == 0), "unreserved")
    return n.withColumn("fault", fault).filter("fault IS NOT NULL").select(receipt, "fault")


def stop_reason(state: DataFrame, rules: list[tuple[str, Column]]) -> DataFrame:
    """Each row with the first stop rule that holds, or null."""
    reason = F.lit(None).cast("string")
    for name, holds in reversed(rules):
        reason = F.when(F.coalesce(holds, F.lit(False)), name).otherwise(reason)
    return state.withColumn("stop_reason", reason)


def expired(attempts: DataFrame, deadline: str, now: Column, occupancy: str) -> DataFrame:
    """Occupied rows whose deadline has come; a null deadline never comes."""
    return attempts.filter(F.col(occupancy) & (F.col(deadline) <= now))


def budget_left(df: DataFrame, keys: list[str], order: list[str], spent: Column, budget: int) -> DataFrame:
    """Tries of each key in order while its budget lasts."""
    w = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return df.withColumn("used", F.coalesce(F.sum(spent.cast("int")).over(w), F.lit(0))).filter(F.col("used") < budget)
