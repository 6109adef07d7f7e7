"""Largest-remainder apportionment and coverage debts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F


def apportion(weights: DataFrame, group: list[str], key: str, weight: str, total: str) -> DataFrame:
    """Whole shares of each group's total in proportion to the weights.

    Negative weights count as none. Every key gets the whole part of its exact share; what is left goes to the largest
    fractions, the smaller key first among equals. Groups without positive weight are left out.
    """
    w = W.partitionBy(*group)
    shares = weights.withColumn("__w", F.greatest(F.lit(0.0), F.col(weight).cast("double"))).withColumn("__d", F.sum("__w").over(w)).filter("__d > 0")
    shares = shares.withColumn("__q", F.col(total) * F.col("__w") / F.col("__d")).withColumn("__f", F.floor("__q"))
    left = F.col(total) - F.sum("__f").over(w)
    place = F.row_number().over(w.orderBy((F.col("__q") - F.col("__f")).desc(), key))
    return shares.select(*group, key, (F.col("__f") + (place <= left).cast("long")).alias("quota"))


def debts(targets: DataFrame, stats: DataFrame, keys: list[str]) -> DataFrame:
    """Targets against what there is: debt counts accepted rows alone, candidate_debt provisional ones too."""
    joined = targets.join(stats, keys, "left").fillna(0, ["accepted", "provisional"])
    return joined.withColumns({
        "debt": F.greatest(F.lit(0), F.col("target") - F.col("accepted")),
        "candidate_debt": F.greatest(F.lit(0), F.col("target") - F.col("accepted") - F.col("provisional")),
    })
