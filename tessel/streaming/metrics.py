"""Event-time metrics that run alike on streams and on tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tessel.plans.stages import shared_folder


def _timed(events: DataFrame, ts: str, late: str) -> DataFrame:
    """Event time as an instant; on a stream, with its watermark."""
    rows = events.withColumn(ts, F.col(ts).cast("timestamp"))
    return rows.withWatermark(ts, late) if events.isStreaming else rows


def minute_counters(events: DataFrame, keys: list[str], ts: str, kind: str, kinds: list[str], late: str = "10 minutes") -> DataFrame:
    """Events per kind in tumbling minutes; rows later than the watermark are dropped on a stream."""
    rows = _timed(events, ts, late)
    return rows.groupBy(F.window(ts, "1 minute").alias("w"), *keys).agg(
        *[F.count(F.when(F.col(kind) == k, 1)).alias(k) for k in kinds], F.max_by("value", ts).alias("last_value")
    ).select(F.col("w.start").alias("minute"), *keys, *kinds, "last_value")


def sliding_counts(events: DataFrame, keys: list[str], ts: str, size: str, step: str, late: str = "10 minutes") -> DataFrame:
    rows = _timed(events, ts, late)
    return rows.groupBy(F.window(ts, size, step).alias("w"), *keys).agg(F.count("*").alias("n")).select(F.col("w.end").alias("until"), *keys, "n")


def replay(spark: SparkSession, folder: str, schema, made: Callable[[DataFrame], DataFrame], files_per_batch: int = 1, glob: str | None = None) -> DataFrame:
    """Run ``made`` over a folder's Parquet files as a stream until they are done, and read what it wrote.

    State and output lie in the shared folder; the sink is exactly-once by its own log.
    """
    where = f"{shared_folder(spark)}/tessel-stream-{uuid.uuid4().hex}"
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    stream = made((reader.option("pathGlobFilter", glob) if glob else reader).parquet(folder))
    stream.writeStream.outputMode("append").format("parquet").option("path", f"{where}/out").option("checkpointLocation", f"{where}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{where}/out")


def first_by_id(events: DataFrame, key: str, ts: str, late: str = "1 hour") -> DataFrame:
    """Each id once: repeated commands within the watermark are dropped."""
    rows = _timed(events, ts, late)
    return rows.dropDuplicatesWithinWatermark([key]) if events.isStreaming else rows.dropDuplicates([key])


def adaptive_cap(batches: DataFrame, key: str, at: str, failed: str, complete: str, results: str, start: int = 128, ceiling: int = 1024, seconds: int = 120, least: int = 30) -> DataFrame:
    """Cap of each pool after each batch of results; ``at`` is the batch's time in seconds.

    Results gather until both ``seconds`` have passed and ``least`` are there, however many batches that takes. Then over 5 % of
    failures lower the cap to 0.7 of itself (1 at least), over 95 % of complete answers raise it by a quarter (8 at least), and
    anything else leaves it; gathering starts anew. Each cap depends on the last one, so that a pool's batches are folded in order;
    give it one row for each stretch of time, so that their number doesn't follow the results.
    """
    schema = f"{key} long, batch_at long, cap long"

    def fold(pdf):  # noqa: ANN001, ANN202
        import pandas as pd

        cap, since, out = start, None, []
        bad = done = n = 0
        for now, failed_, complete_, results_ in pdf.sort_values(at)[[at, failed, complete, results]].itertuples(index=False):
            since = now if since is None else since
            bad, done, n = bad + failed_, done + complete_, n + results_
            if now - since >= seconds and n >= least:
                if bad > 0.05 * n:
                    cap = max(1, int(cap * 0.7))
                elif done > 0.95 * n:
                    cap = max(cap, min(ceiling, cap + max(8, cap // 4)))
                bad, done, n, since = 0, 0, 0, now
            out.append((pdf[key].iloc[0], now, cap))
        return pd.DataFrame(out, columns=[key, "batch_at", "cap"])

    return batches.select(key, at, failed, complete, results).groupBy(key).applyInPandas(fold, schema)
