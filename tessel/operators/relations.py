"""Filters, joins and set comparisons."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F


def where_given(df: DataFrame, **wanted) -> DataFrame:
    """Equality on each given column; null, empty or zero values ask for nothing."""
    return reduce(lambda d, kv: d.filter(F.col(kv[0]) == kv[1]) if kv[1] else d, wanted.items(), df)


def prefix_search(df: DataFrame, query: str, *columns: str) -> DataFrame:
    """Rows in which a column starts with the query, in any case; ``%`` and ``_`` in it stay wild; 100 characters count."""
    return df.filter(reduce(lambda a, b: a | b, [F.col(c).ilike(query[:100] + "%") for c in columns]))


def after(df: DataFrame, **key) -> DataFrame:
    """Rows behind a composite key, in the order of its columns."""
    return df.filter(F.struct(*key) > F.struct(*[F.lit(v).cast(df.schema[k].dataType).alias(k) for k, v in key.items()]))


def any_key_join(left: DataFrame, right: DataFrame, keys: list[str], left_id: str, right_id: str) -> DataFrame:
    """Pairs of ids that agree in any of the keys, each once: one equi-join per key, united, as an OR condition would compare all pairs.

    Two rows are paired by the first key that they share, so pairs of ids with one row each need not be made distinct.
    """
    alone = F.count(F.lit(1)).over(W.partitionBy("id")) == 1
    l, r = (df.select(F.col(i).alias("id"), *[F.col(k).alias(f"k{n}") for n, k in enumerate(keys)]).withColumn("alone", alone) for df, i in ((left, left_id), (right, right_id)))

    def pairs(a: DataFrame, b: DataFrame) -> DataFrame:
        a, b, found = a.alias("a"), b.alias("b"), []
        for n in range(len(keys)):
            before = [~F.coalesce(F.col(f"a.k{m}") == F.col(f"b.k{m}"), F.lit(False)) for m in range(n)]
            found.append(a.join(b, reduce(lambda p, q: p & q, before, F.col(f"a.k{n}") == F.col(f"b.k{n}"))).select(F.col("a.id").alias(left_id), F.col("b.id").alias(right_id)))
        return reduce(DataFrame.union, found)

    return pairs(l.filter("alone"), r.filter("alone")).union(pairs(l.filter("not alone"), r).union(pairs(l.filter("alone"), r.filter("not alone"))).distinct())


def first_match(left: DataFrame, right: DataFrame, on: list[str], order: list[Column], take: list[str]) -> DataFrame:
    """``left`` with the columns of the first right row by ``order`` for its key."""
    best = right.withColumn("__n", F.row_number().over(W.partitionBy(*on).orderBy(*order))).filter("__n = 1").select(*on, *take)
    return left.join(best, on, "left")


def in_boxes(points: DataFrame, boxes: DataFrame, on: str, axes: str = "xyz") -> DataFrame:
    """Points joined with the boxes of the same sample that hold them, bounds included."""
    inside = reduce(lambda a, b: a & b, [(F.col(a) >= F.col(f"{a}0")) & (F.col(a) <= F.col(f"{a}1")) for a in axes])
    return points.join(boxes, on).filter(inside)


def box_overlaps(boxes: DataFrame, on: str, box_id: str, axes: str = "xyz") -> DataFrame:
    """Pairs of overlapping boxes of one sample, the earlier first, with the volume they share."""
    a, b = boxes.alias("a"), boxes.alias("b")
    extent = [F.greatest(F.lit(0), F.least(F.col(f"a.{x}1"), F.col(f"b.{x}1")) - F.greatest(F.col(f"a.{x}0"), F.col(f"b.{x}0")) + 1) for x in axes]
    pairs = a.join(b, (F.col(f"a.{on}") == F.col(f"b.{on}")) & (F.col(f"a.{box_id}") < F.col(f"b.{box_id}")))
    return pairs.select(F.col(f"a.{on}").alias(on), F.col(f"a.{box_id}").alias("first_id"), F.col(f"b.{box_id}").alias("second_id"), reduce(lambda p, q: p * q, extent).alias("volume")).filter("volume > 0")


def revision_pairs(df: DataFrame, key: str, revision: str, failed: Column, passed: Column, keep: list[str]) -> DataFrame:
    """Each failing revision with the key's last passing one, if that is later."""
    final = df.filter(passed).groupBy(key).agg(F.max(revision).alias("after_revision"))
    return df.filter(failed).join(final, key).filter(F.col(revision) < F.col("after_revision")).select(key, F.col(revision).alias("before_revision"), "after_revision", *keep)


def leaking_groups(df: DataFrame, group: str, split: str, training: tuple[str, ...] = ("train", "val", "test")) -> DataFrame:
    """Groups that lie in two training splits or more."""
    return df.filter(F.col(split).isin(*training)).groupBy(group).agg(F.countDistinct(split).alias("n_splits")).filter("n_splits > 1")


def full_merge(left: DataFrame, right: DataFrame, keys: list[str], zero: list[str]) -> DataFrame:
    """Full outer join, nulls equal, with zeros for missing measures."""
    l, r = left.alias("l"), right.alias("r")
    on = reduce(lambda a, b: a & b, [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys])
    joined = l.join(r, on, "full")
    own = lambda c: f"l.{c}" if c in left.columns else f"r.{c}"
    return joined.select(*[F.coalesce(F.col(f"l.{k}"), F.col(f"r.{k}")).alias(k) for k in keys], *[F.coalesce(F.col(own(z)), F.lit(0)).alias(z) for z in zero])


def set_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows on one side only, with the side."""
    return left.exceptAll(right).withColumn("side", F.lit("left")).unionByName(right.exceptAll(left).withColumn("side", F.lit("right")))


def retained_share(reference: DataFrame, kept: DataFrame, key: str, cell: list[str], least: float = 0.98) -> DataFrame:
    """Share of each key's reference cells that are still there, and whether it suffices."""
    both = reference.select(key, *cell).distinct().join(kept.select(key, *cell).distinct().withColumn("__k", F.lit(1)), [key, *cell], "left")
    return both.groupBy(key).agg(F.count("*").alias("n_reference"), F.count("__k").alias("n_kept")).withColumn("passes", F.col("n_kept") >= F.lit(least) * F.col("n_reference"))


def duplicate_ids(df: DataFrame, key: str, digest: str, order: str) -> DataFrame:
    """For ids met more than once, in order: whether a later one repeats the first's content or contradicts it."""
    w = W.partitionBy(key).orderBy(order, digest)
    first = F.first(digest).over(w.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    return df.withColumns({"nth": F.row_number().over(w), "same": F.col(digest) == first}).filter("nth > 1").select(key, order, "nth", F.when(F.col("same"), "repeat").otherwise("conflict").alias("finding"))
