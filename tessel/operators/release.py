"""Lineage groups, leak-free splits, selection and release checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tessel.operators.graph import connected_components

#: The split's domain, and its bounds out of 10000.
SPLIT_PREFIX = "split"
BOUNDS = ((9000, "train"), (9500, "val"))


def split_bucket(group: Column, prefix: str = SPLIT_PREFIX) -> Column:
    """0..9999 from the first 16 hex digits of sha256(prefix, NUL, group)."""
    digits = F.substring(F.sha2(F.concat(F.lit(prefix), F.chr(F.lit(0)), group), 256), 1, 16)
    return (F.conv(digits, 16, 10).cast("decimal(20,0)") % 10000).cast("int")


def split_name(bucket: Column) -> Column:
    name = F.lit("test")
    for bound, split in reversed(BOUNDS):
        name = F.when(bucket < bound, split).otherwise(name)
    return name


def lineage_groups(df: DataFrame, key: str, tokens: dict[str, Column]) -> DataFrame:
    """(key, lineage_group): rows that share any token, directly or through others, form a group.

    A group is named by the least token in it. Tokens are written ``name:value``; null ones tie nothing.
    """
    own = F.concat(F.lit("sample:"), F.col(key).cast("string"))
    edges = df.select(own.alias("a"), F.explode(F.array(own, *[F.concat(F.lit(f"{n}:"), c.cast("string")) for n, c in tokens.items()])).alias("b"))
    labels = connected_components(edges, "a", "b")
    return df.select(key, own.alias("__own")).join(labels, F.col("__own") == labels.node).select(key, F.col("component").alias("lineage_group"))


def assigned(df: DataFrame, group: str, accepted: Column, calibration: Column) -> DataFrame:
    """Split of each row: accepted rows by their group's hash, calibration rows apart, all others excluded."""
    return df.withColumn("split", F.when(accepted, split_name(split_bucket(F.col(group)))).when(calibration, "calibration").otherwise("excluded"))


def verified(declared: DataFrame, recomputed: DataFrame, keys: list[str], digest: str) -> DataFrame:
    """Rows that are missing, unexpected or altered, as findings; none for a sound release."""
    d, r = declared.select(*keys, F.col(digest).alias("__d")), recomputed.select(*keys, F.col(digest).alias("__r"))
    finding = F.when(F.col("__d").isNull(), "unexpected").when(F.col("__r").isNull(), "missing").when(F.col("__d") != F.col("__r"), "altered")
    return d.join(r, keys, "full").withColumn("finding", finding).filter("finding IS NOT NULL").select(*keys, "finding")


def assert_clean(findings: DataFrame) -> None:
    """Raise if there is any finding."""
    first = findings.take(3)
    if first:
        raise ValueError(f"release is not sound: {first}")
