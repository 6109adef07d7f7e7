"""Lineage, splits, release records and their verification over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tessel.operators import release
from tessel.plans.registry import query
from tessel.plans.tables import table
from tessel.plans.views import oracle, view

_BUCKET = "CAST(CAST(concat('0x', substr(sha256(concat('split', chr(0), {g})), 1, 16)) AS UBIGINT) % 10000 AS INT)"
_SPLIT = "CASE WHEN {b} < 9000 THEN 'train' WHEN {b} < 9500 THEN 'val' ELSE 'test' END"

#: Lineage tokens of a document: the text itself, and its first line where that is long enough to be telling.
_DOCS = """
WITH RECURSIVE t AS (SELECT doc_id, concat('sample:', doc_id) AS own, concat('text:', sha256(text)) AS a, CASE WHEN length(string_split(text, chr(10))[1]) >= 60 THEN concat('head:', sha256(string_split(text, chr(10))[1])) END AS b FROM documents),
e AS (SELECT own AS x, a AS y FROM t WHERE a IS NOT NULL UNION SELECT own, b FROM t WHERE b IS NOT NULL),
e2 AS (SELECT x, y FROM e UNION SELECT y, x FROM e),
r AS (SELECT own AS node, own AS label FROM t UNION SELECT y, y FROM e UNION SELECT e2.y, r.label FROM r JOIN e2 ON r.node = e2.x WHERE r.label < e2.y OR TRUE),
g AS (SELECT t.doc_id, min(r.label) AS lineage_group FROM t JOIN r ON r.node = t.own GROUP BY t.doc_id)
"""


def _groups(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    head = F.get(F.split("text", "\n"), 0)
    return release.lineage_groups(docs, "doc_id", {"text": F.sha2(F.col("text").cast("binary"), 256), "head": F.when(F.char_length(head) >= 60, F.sha2(head.cast("binary"), 256))})


@query("lineage_groups", _DOCS + "SELECT doc_id, lineage_group FROM g")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return _groups(spark, sf)


@query("lineage_split", _DOCS + f"""
, b AS (SELECT lang, {_BUCKET.format(g="lineage_group")} AS b FROM g JOIN documents USING (doc_id))
SELECT lang, {_SPLIT.format(b="b")} AS split, count(*) AS n FROM b GROUP BY ALL""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "lang").join(_groups(spark, sf), "doc_id")
    return docs.groupBy("lang", release.split_name(release.split_bucket(F.col("lineage_group"))).alias("split")).agg(F.count("*").alias("n"))


@query("rel_assigned_splits", oracle(f"""
SELECT sample_id, CASE WHEN status = 'accepted' THEN {_SPLIT.format(b=_BUCKET.format(g="lineage"))} WHEN stage = 'review' THEN 'calibration' ELSE 'excluded' END AS split FROM samples""", "samples"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return release.assigned(view(spark, sf, "samples"), "lineage", F.col("status") == "accepted", F.col("stage") == "review").select("sample_id", "split")


@query("rel_split_counters", oracle(f"""
, a AS (SELECT scene_type, CASE WHEN status = 'accepted' THEN {_SPLIT.format(b=_BUCKET.format(g="lineage"))} WHEN stage = 'review' THEN 'calibration' ELSE 'excluded' END AS split FROM samples)
SELECT scene_type, count(*) FILTER (split = 'train') AS train, count(*) FILTER (split = 'val') AS val, count(*) FILTER (split = 'test') AS test, count(*) FILTER (split = 'calibration') AS calibration, count(*) FILTER (split = 'excluded') AS excluded FROM a GROUP BY scene_type""", "samples"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    names = ["train", "val", "test", "calibration", "excluded"]
    rows = release.assigned(view(spark, sf, "samples"), "lineage", F.col("status") == "accepted", F.col("stage") == "review")
    return rows.groupBy("scene_type").pivot("split", names).agg(F.count(F.lit(1))).fillna(0, names)


@query("rel_verification", oracle("""
, d AS (SELECT sample_id, sha256(concat(sample_id, '/', status)) AS h FROM samples WHERE sample_id % 5 <> 0),
r AS (SELECT sample_id, sha256(concat(sample_id, '/', CASE WHEN sample_id % 9 = 0 THEN 'x' ELSE status END)) AS h FROM samples WHERE sample_id % 7 <> 0)
SELECT coalesce(d.sample_id, r.sample_id) AS sample_id, CASE WHEN d.h IS NULL THEN 'unexpected' WHEN r.h IS NULL THEN 'missing' ELSE 'altered' END AS finding FROM d FULL JOIN r ON d.sample_id = r.sample_id WHERE d.h IS NULL OR r.h IS NULL OR d.h <> r.h""", "samples"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    s = view(spark, sf, "samples")
    mark = lambda c: F.sha2(F.concat_ws("/", "sample_id", c), 256).alias("h")
    declared = s.filter("sample_id % 5 <> 0").select("sample_id", mark(F.col("status")))
    found = s.filter("sample_id % 7 <> 0").select("sample_id", mark(F.when(F.col("sample_id") % 9 == 0, "x").otherwise(F.col("status"))))
    return release.verified(declared, found, ["sample_id"], "h")


@query("rel_sft_records", "SELECT conv_id, string_agg(concat(role, ': ', text), chr(10) ORDER BY turn) AS record, count(*) AS turns FROM conversations WHERE text IS NOT NULL GROUP BY conv_id")
def _(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "conversations").filter("text IS NOT NULL")
    turns = F.sort_array(F.collect_list(F.struct("turn", F.concat_ws(": ", "role", "text").alias("t"))))
    return rows.groupBy("conv_id").agg(F.array_join(F.transform(turns, lambda x: x["t"]), "\n").alias("record"), F.count("*").alias("turns"))
