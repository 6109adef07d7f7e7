"""Pages, queues, argmax choices, streaks and quotas by rank."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tessel.plans.stages import sized


def page(df: DataFrame, key: str, after, limit: int) -> DataFrame:
    """Rows behind ``after`` in key order, one more than asked for: the surplus row says that there is a next page."""
    limit = max(1, min(100, limit))
    rows = df if after is None else df.filter(F.col(key) > after)
    return rows.orderBy(key).limit(limit + 1)


def best_by(df: DataFrame, keys: list[str], take: str, order: list[Column], least: bool = False) -> DataFrame:
    """The row id of the greatest (or least) order tuple in each group."""
    pick = F.min_by if least else F.max_by
    return df.groupBy(*keys).agg(pick(F.col(take), F.struct(*order)).alias(take))


def seeded_rank(df: DataFrame, keys: list[str], seed: str, ids: list[str]) -> DataFrame:
    """A reproducible random order inside each stratum: by the hash of seed and ids."""
    mark = F.sha2(F.concat_ws(":", F.lit(seed), *[F.col(c).cast("string") for c in ids]), 256)
    return df.withColumn("rank", F.row_number().over(W.partitionBy(*keys).orderBy(mark, *ids)))


def round_robin(ranked: DataFrame, strata: list[str], n: int) -> DataFrame:
    """The first ``n`` rows taking the strata in turn."""
    return ranked.orderBy("rank", *strata).limit(n)


def streaks(df: DataFrame, keys: list[str], order: list[str], broken: Column) -> DataFrame:
    """Each row with the number of rows since the last broken one, which counts 0."""
    w = W.partitionBy(*keys).orderBy(*order)
    island = F.sum(broken.cast("int")).over(w)
    marked = df.withColumns({"__i": island, "__b": broken})
    return marked.withColumn("streak", F.sum((~F.col("__b")).cast("int")).over(W.partitionBy(*keys, "__i").orderBy(*order))).drop("__i", "__b")


def same_streak(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """Length so far of the run of equal values."""
    w = W.partitionBy(*keys).orderBy(*order)
    new = F.coalesce((~F.col(value).eqNullSafe(F.lag(value).over(w))) | (F.row_number().over(w) == 1), F.lit(True))
    marked = df.withColumn("__i", F.sum(new.cast("int")).over(w))
    return marked.withColumn("streak", F.row_number().over(W.partitionBy(*keys, "__i").orderBy(*order))).drop("__i")


def quota(df: DataFrame, keys: list[str], order: list[str], limits: DataFrame, limit: str) -> DataFrame:
    """The first rows of each group up to its limit; groups without a limit give none, and none makes up for another."""
    ranked = df.join(sized(limits, 64), keys).withColumn("rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("rank") <= F.col(limit))


def shortages(df: DataFrame, keys: list[str], limits: DataFrame, limit: str) -> DataFrame:
    """Groups with fewer rows than asked for."""
    have = df.groupBy(*keys).agg(F.count("*").alias("available"))
    return limits.join(have, keys, "left").withColumn("available", F.coalesce("available", F.lit(0))).filter(F.col("available") < F.col(limit))


def first_then_repeats(df: DataFrame, keys: list[str], rule: str, pos: str) -> DataFrame:
    """Order in which each rule's first finding comes before any repeat."""
    nth = F.row_number().over(W.partitionBy(*keys, rule).orderBy(pos))
    return df.withColumn("__r", (nth > 1).cast("int")).withColumn("place", F.row_number().over(W.partitionBy(*keys).orderBy("__r", pos))).drop("__r")


def bounded_shards(df: DataFrame, release: str, order: list[str], size: str, most: int, most_bytes: int) -> DataFrame:
    """Shard numbers in order: a new shard where the count or the bytes of the open one would pass its bound.

    The running sums reset, so the fold runs over each release's rows in order; a release is one ordered stream, held in
    batches, and releases spread over the cluster.
    """
    columns = [release, *order, size]

    def fold(batches):
        import pyarrow as pa

        now, shard, n, held = None, 0, 0, 0
        for b in batches:
            out = []
            for r, s in zip(b.column(0).to_pylist(), b.column(len(columns) - 1).to_pylist(), strict=True):
                if r != now:
                    now, shard, n, held = r, 0, 0, 0
                if n and (n >= most or held + s > most_bytes):
                    shard, n, held = shard + 1, 0, 0
                n, held = n + 1, held + s
                out.append(shard)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.int32())], names=[*columns, "shard"])

    rows = df.select(*columns).repartition(release).sortWithinPartitions(release, *order)
    return rows.mapInArrow(fold, f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in rows.schema)}, shard int")
