"""Grouped measures whose nulls and zeros carry meaning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F


def count_where(condition: Column) -> Column:
    """Rows that satisfy the condition; 0, not null, for none."""
    return F.count(F.when(condition, 1))


def sum_or_null(value: Column) -> Column:
    """The sum, or null if any value is missing."""
    return F.when(F.count(value) == F.count(F.lit(1)), F.sum(value))


def rate(part: Column, whole: Column) -> Column:
    """part / whole, null where there is no whole."""
    return F.when(whole > 0, part / whole)


def conditional_sums(df: DataFrame, keys: list[str], **conditions: Column) -> DataFrame:
    return df.groupBy(*keys).agg(*[count_where(c).alias(n) for n, c in conditions.items()])


def nearest_rank(df: DataFrame, keys: list[str], value: str, share: float, name: str) -> DataFrame:
    """The value at place ``min(n - 1, floor(share * n))`` of the sorted values of each group; nothing is interpolated."""
    w = W.partitionBy(*keys)
    ranked = df.filter(F.col(value).isNotNull()).select(*keys, value, (F.row_number().over(w.orderBy(value)) - 1).alias("__k"), F.count("*").over(w).alias("__n"))
    return ranked.filter(F.col("__k") == F.least(F.col("__n") - 1, F.floor(F.lit(share) * F.col("__n")))).select(*keys, F.col(value).alias(name))


def signed_deltas(changes: DataFrame, keys: list[str], sign: str, **conditions: Column) -> DataFrame:
    """Maintained counts from old rows (sign -1) and new ones (+1)."""
    return changes.groupBy(*keys).agg(*[F.sum(F.when(c, F.col(sign)).otherwise(0)).alias(n) for n, c in conditions.items()])


def hourly_rate(n: Column, age: Column) -> Column:
    """Per hour over at most an hour; null below a minute of age or without any."""
    window = F.least(F.lit(3600.0), age)
    return F.when((window >= 60) & (n > 0), n * 3600 / window)


def ordered_digest(df: DataFrame, keys: list[str], order: list[str], text: Column) -> DataFrame:
    """sha256 over the rows' texts in order, one digest per key; a group's texts must fit in a row."""
    rows = F.sort_array(F.collect_list(F.struct(*order, text.alias("__t"))))
    return df.groupBy(*keys).agg(F.sha2(F.concat_ws("", F.transform(rows, lambda x: x["__t"])), 256).alias("digest"))


def last_minutes(df: DataFrame, keys: list[str], ts: str, seconds: int, **measures: Column) -> DataFrame:
    """Each row with measures over the ``seconds`` before and up to it."""
    at = F.unix_micros(F.col(ts).cast("timestamp"))
    w = W.partitionBy(*keys).orderBy(at).rangeBetween(-seconds * 1_000_000, 0)
    return df.withColumns({n: m.over(w) for n, m in measures.items()})
