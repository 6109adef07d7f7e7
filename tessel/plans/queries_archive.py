"""The archive over the given tables: files are made of rows, committed, verified, backed up and restored."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from tessel.plans.registry import query
from tessel.plans.stages import shared_folder, written
from tessel.plans.tables import table
from tessel.sources import archive


def _pages(spark: SparkSession, sf: str) -> DataFrame:
    """Every page as the file of an asset."""
    id_ = F.concat(F.lit("page-"), F.col("page_id").cast("string"))
    return table(spark, sf, "pages").select(id_.alias("asset_id"), F.lit(1).alias("revision"), F.lit("page.html").alias("name"), F.coalesce("html", F.lit("")).cast("binary").alias("content"))


@query("snk_archived_pages", """
SELECT concat('page-', page_id) AS asset_id, 1 AS revision, 'page.html' AS name, octet_length(encode(coalesce(html, '')))::BIGINT AS bytes, sha256(coalesce(html, '')) AS sha256, TRUE AS intact FROM pages""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    root = f"{shared_folder(spark)}/tessel-archive-{uuid.uuid4().hex}"
    archive.archived(_pages(spark, sf), root)
    faults = archive.faults(spark, root).select("path", F.lit(False).alias("whole"))
    return written(archive.manifest(spark, root).join(faults, "path", "left").select("asset_id", "revision", "name", "bytes", "sha256", F.coalesce("whole", F.lit(True)).alias("intact")), "archived")


@query("snk_restored_items", """
SELECT concat('item-', item_id) AS asset_id, octet_length(encode(coalesce(text, '')))::BIGINT AS bytes, sha256(coalesce(text, '')) AS sha256 FROM benchmark""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    """Benchmark items archived, backed up, restored into a new root, and read there by their list."""
    where = f"{shared_folder(spark)}/tessel-archive-{uuid.uuid4().hex}"
    rows = table(spark, sf, "benchmark").select(F.concat(F.lit("item-"), F.col("item_id").cast("string")).alias("asset_id"), F.lit(1).alias("revision"), F.lit("item.txt").alias("name"), F.coalesce("text", F.lit("")).cast("binary").alias("content"))
    archive.archived(rows, f"{where}/root")
    archive.backup(spark, f"{where}/root", f"{where}/backup")
    archive.restore(spark, f"{where}/backup", f"{where}/restored")
    return written(archive.manifest(spark, f"{where}/restored").select("asset_id", "bytes", "sha256"), "restored")
