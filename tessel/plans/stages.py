"""Cutting lineage, and joins that pick a broadcast only after measuring it."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession, functions as F

#: Largest side, in bytes of its rows, that is sent whole to every executor.
BROADCAST_BYTES = 24 * 1024 * 1024
#: Rows that a partition of a measured exchange takes, about.
PART_ROWS = 1 << 17
#: With this setting Spark drops a query's shuffle files when the query ends, and not when the driver's garbage is collected.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Where it is unset, a local session (tests) takes a temporary folder; on a cluster nobody else could read that, so it raises.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tessel-shared-"))
    return spark.sparkContext.getCheckpointDir()


def _remove(spark: SparkSession, where: str, at_exit: bool) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(where)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.deleteOnExit(path) if at_exit else files.delete(path, True)


@contextlib.contextmanager
def _shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries that run inside leave no shuffle files behind."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Later stages then start from files that survive the loss of any executor. The files go when the application ends, or in
    ``forgotten``; the shuffle files behind them go at once.
    """
    spark = df.sparkSession
    where = f"{shared_folder(spark)}/tessel-{label}-{uuid.uuid4().hex}"
    with _shuffles_dropped(spark):
        df.write.parquet(where)
    _remove(spark, where, at_exit=True)
    out = spark.read.schema(df.schema).parquet(where)
    out._tessel_files = where
    return out


def bucketed(df: DataFrame, key: str, label: str) -> DataFrame:
    """As ``written``, in buckets by ``key``: what groups these rows by it reads the files and needs no exchange of them."""
    spark, name = df.sparkSession, f"tessel_{label}_{uuid.uuid4().hex}"
    where = f"{shared_folder(spark)}/{name}"
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    with _shuffles_dropped(spark):
        df.write.format("parquet").bucketBy(parts, key).option("path", where).saveAsTable(name)
    _remove(spark, where, at_exit=True)
    out = spark.table(name)
    out.schema  # resolved now; the catalog keeps no entry, and the files stay, as the table is an external one
    spark.sql(f"DROP TABLE {name}")
    out._tessel_files = where
    return out


def forgotten(tables: Iterable[DataFrame]) -> None:
    """Delete the files of tables that ``written`` made, once nothing reads them any more."""
    for df in tables:
        if where := getattr(df, "_tessel_files", None):
            _remove(df.sparkSession, where, at_exit=False)


def parts_for(df: DataFrame) -> int:
    """Partitions for an exchange of the rows of ``df``, counted now, so that a task's share does not grow with the table.

    Give it a table as it is read: its count needs no column.
    """
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // PART_ROWS))


def sized(df: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` marked for broadcast if its rows, counted now, fit in ``limit`` bytes; otherwise as it is.

    The join gives the same rows either way; beyond the limit Spark shuffles both sides.
    Give it a written (or otherwise cheap) table, as counting runs it.
    """
    return F.broadcast(df) if df.count() * row_bytes <= limit else df
