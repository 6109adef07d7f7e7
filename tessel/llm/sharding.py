"""Contiguous shards of near-equal byte size, from global prefix sums (DataFrame functions only).

The rows are put in key order over range partitions. Each partition's total is one row of a small table; running sums over
that table give every partition its offset, and running sums inside a partition give every row the bytes before it. The
line of bytes is cut at equal targets, and a row belongs to the shard in which its middle byte lies.

Defined cases: a null text weighs only the fixed overhead; null keys come first; repeated rows are kept and weigh each;
rows with equal keys are ordered by checksum and size; an empty table gives no rows; other input columns are ignored, so
clashing names do no harm.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from tessel.plans.stages import written


def byte_shards(df: DataFrame, key: str, text: str, shards: int, overhead: int = 16) -> DataFrame:
    """One row per input row: key, size, text_crc32, shard, slot, bytes_before.

    ``size`` is the UTF-8 length of the text plus ``overhead``; ``slot`` counts from 0 inside the shard.
    Equal texts can fall into different shards: the law is equal bytes over one contiguous order.
    """
    sizes = df.select(
        F.col(key).alias("key"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + overhead).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
    )
    dealt = sizes.repartitionByRange("key").withColumn("part", F.spark_partition_id())
    rows = written(dealt, "sizes")  # the partition numbers must not change between the two uses

    order = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)  # one row for each partition
    offsets = (
        rows.groupBy("part").agg(F.sum("size").alias("b"), F.count("*").alias("n"))
        .withColumns({"bytes_off": F.coalesce(F.sum("b").over(order), F.lit(0)), "rows_off": F.coalesce(F.sum("n").over(order), F.lit(0))})
    )
    total = offsets.agg(F.sum("b").alias("total"))
    offsets = offsets.join(F.broadcast(total))  # a single row

    inside = W.partitionBy("part").orderBy("key", "text_crc32", "size").rowsBetween(W.unboundedPreceding, 0)
    placed = (
        rows.withColumns({"upto": F.sum("size").over(inside), "nth": F.count("*").over(inside)})
        .join(F.broadcast(offsets.drop("b", "n")), "part")  # as many rows as partitions
        .withColumns({"bytes_before": F.col("bytes_off") + F.col("upto") - F.col("size"), "place": F.col("rows_off") + F.col("nth") - 1})
        .withColumn("shard", F.least(F.lit(shards - 1), F.expr(f"(({shards} * (2 * bytes_before + size)) div (2 * total))")).cast("int"))
    )
    placed = written(placed.select("key", "size", "text_crc32", "shard", "place", "bytes_before"), "placed")
    starts = placed.groupBy("shard").agg(F.min("place").alias("start"))  # at most ``shards`` rows
    return placed.join(F.broadcast(starts), "shard").select("key", "size", "text_crc32", "shard", (F.col("place") - F.col("start")).alias("slot"), "bytes_before")
