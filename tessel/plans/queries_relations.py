"""Filters, joins, aggregates, ranks, quotas and functions over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from tessel.functions import text as fn
from tessel.operators import aggregates as agg, quota as quotas, ranking, relations as rel
from tessel.plans.registry import query
from tessel.plans.tables import table
from tessel.plans.views import oracle, view

MODES = ", ".join(f"('{m}', {i})" for i, m in enumerate(fn.MODES))


# --- filters


@query("fil_optional_equality", oracle("SELECT sample_id, status, stage, mode FROM samples WHERE campaign_id = 3 AND stage = 'review'", "samples"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rel.where_given(view(spark, sf, "samples"), campaign_id=3, stage="review", status="", mode=None).select("sample_id", "status", "stage", "mode")


@query("fil_prefix_search", "SELECT p_partkey, p_name, p_brand FROM part WHERE p_name ILIKE 'Re%' OR p_brand ILIKE 'Re%'")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rel.prefix_search(table(spark, sf, "part"), "Re", "p_name", "p_brand").select("p_partkey", "p_name", "p_brand")


@query("fil_composite_keyset", oracle("SELECT sample_id, attempt_no, started_at FROM attempts WHERE started_at > TIMESTAMP '1999-01-01' OR (started_at = TIMESTAMP '1999-01-01' AND sample_id > 500)", "attempts"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rel.after(view(spark, sf, "attempts"), started_at="1999-01-01", sample_id=500).select("sample_id", "attempt_no", "started_at")


@query("fil_null_safe_mode", oracle("SELECT mode, reason, count(*) AS n FROM samples WHERE status <> 'accepted' AND (mode IS NOT DISTINCT FROM NULL OR mode IS NOT DISTINCT FROM 'contextual') GROUP BY mode, reason", "samples"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    s = view(spark, sf, "samples")
    wanted = F.col("mode").eqNullSafe(F.lit(None)) | F.col("mode").eqNullSafe(F.lit("contextual"))
    return s.filter((F.col("status") != "accepted") & wanted).groupBy("mode", "reason").agg(F.count("*").alias("n"))


@query("fil_json_path", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events WHERE CAST(json_extract_string(props, '$.k') AS BIGINT) >= 50")
def _(spark: SparkSession, sf: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("long")
    return table(spark, sf, "events").select("event_id", k.alias("k")).filter(F.col("k") >= 50)


@query("fil_sliding_hour", "SELECT event_type, count(*) AS n FROM events WHERE ts > TIMESTAMP '2024-01-20 12:00:00' - INTERVAL 3600 SECOND * 24 AND ts <= TIMESTAMP '2024-01-20 12:00:00' GROUP BY event_type")
def _(spark: SparkSession, sf: str) -> DataFrame:
    now = F.lit("2024-01-20 12:00:00").cast("timestamp")
    return table(spark, sf, "events").filter((F.col("ts") > now - F.expr("INTERVAL 24 HOURS")) & (F.col("ts") <= now)).groupBy("event_type").agg(F.count("*").alias("n"))


@query("fil_ready_work", oracle("""
, active AS (SELECT campaign_id, count(*) AS n FROM samples WHERE status = 'running' GROUP BY campaign_id)
SELECT s.sample_id, s.stage FROM samples s JOIN campaigns c USING (campaign_id) LEFT JOIN active a USING (campaign_id)
WHERE s.status IN ('ready', 'deferred') AND s.updated_at <= TIMESTAMP '1999-06-01'
  AND ((s.stage IN ('author', 'refine', 'review') AND c.state = 'running' AND coalesce(a.n, 0) < c.api_cap * 100) OR s.stage IN ('build', 'archive'))""", "samples", "campaigns"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    s, c = view(spark, sf, "samples"), view(spark, sf, "campaigns")
    active = s.filter("status = 'running'").groupBy("campaign_id").agg(F.count("*").alias("n"))
    joined = s.join(F.broadcast(c.select("campaign_id", "state", "api_cap")), "campaign_id").join(active, "campaign_id", "left")  # campaigns: a handful of rows
    network = F.col("stage").isin("author", "refine", "review") & (F.col("state") == "running") & (F.coalesce("n", F.lit(0)) < F.col("api_cap") * 100)
    due = F.col("status").isin("ready", "deferred") & (F.col("updated_at") <= F.lit("1999-06-01").cast("timestamp"))
    return joined.filter(due & (network | F.col("stage").isin("build", "archive"))).select("sample_id", "stage")


# --- joins


@query("jn_any_key", """
SELECT DISTINCT c.c_custkey, s.s_suppkey FROM customer c JOIN supplier s ON c.c_nationkey = s.s_nationkey AND c.c_custkey % 50 = s.s_suppkey % 50
UNION SELECT c.c_custkey, s.s_suppkey FROM customer c JOIN supplier s ON CAST(floor(c.c_acctbal) AS BIGINT) = CAST(floor(s.s_acctbal) AS BIGINT)""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    key = lambda p, k: F.concat_ws("-", F.col(f"{p}_nationkey"), F.col(k) % 50)
    c = table(spark, sf, "customer").select("c_custkey", key("c", "c_custkey").alias("place"), F.floor("c_acctbal").alias("balance"))
    s = table(spark, sf, "supplier").select("s_suppkey", key("s", "s_suppkey").alias("place"), F.floor("s_acctbal").alias("balance"))
    return rel.any_key_join(c, s, ["place", "balance"], "c_custkey", "s_suppkey")


@query("jn_first_match", """
, r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END, o_orderdate, o_orderkey) AS n FROM orders)
SELECT c_custkey, o_orderkey, o_orderstatus FROM customer LEFT JOIN r ON c_custkey = o_custkey AND n = 1""".replace(", r AS", "WITH r AS", 1))
def _(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").withColumnRenamed("o_custkey", "c_custkey")
    order = [F.when(F.col("o_orderstatus") == "F", 0).otherwise(1), F.col("o_orderdate"), F.col("o_orderkey")]
    return rel.first_match(table(spark, sf, "customer").select("c_custkey"), orders, ["c_custkey"], order, ["o_orderkey", "o_orderstatus"])


@query("jn_ledger_to_sample", oracle("SELECT a.sample_id, a.attempt_no, a.part_id, s.stage FROM attempts a JOIN samples s ON a.sample_id = s.sample_id AND a.revision = s.revision AND a.role = s.stage", "attempts", "samples"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    a, s = view(spark, sf, "attempts"), view(spark, sf, "samples")
    return a.join(s, (a.sample_id == s.sample_id) & (a.revision == s.revision) & (a.role == s.stage)).select(a.sample_id, "attempt_no", "part_id", "stage")


@query("jn_coverage_left", oracle("""
, st AS (SELECT family_id, count(*) FILTER (status = 'accepted') AS accepted, count(*) FILTER (status = 'rejected') AS rejected FROM samples GROUP BY family_id)
SELECT f.family_id, f.name, f.scene_type, coalesce(accepted, 0) AS accepted, coalesce(rejected, 0) AS rejected FROM families f LEFT JOIN st USING (family_id)""", "samples", "families"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    stats = agg.conditional_sums(view(spark, sf, "samples"), ["family_id"], accepted=F.col("status") == "accepted", rejected=F.col("status") == "rejected")
    return view(spark, sf, "families").join(stats, "family_id", "left").fillna(0, ["accepted", "rejected"])


@query("jn_full_merge", oracle("""
, t AS (SELECT scene_type, mode, count(*) AS target FROM samples WHERE campaign_id < 4 AND status = 'accepted' GROUP BY scene_type, mode),
g AS (SELECT scene_type, mode, count(*) AS made FROM samples WHERE campaign_id >= 4 AND reason IS NOT NULL GROUP BY scene_type, mode)
SELECT coalesce(t.scene_type, g.scene_type) AS scene_type, coalesce(t.mode, g.mode) AS mode, coalesce(target, 0) AS target, coalesce(made, 0) AS made
FROM t FULL JOIN g ON t.scene_type IS NOT DISTINCT FROM g.scene_type AND t.mode IS NOT DISTINCT FROM g.mode""", "samples"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    s = view(spark, sf, "samples")
    t = s.filter("campaign_id < 4 AND status = 'accepted'").groupBy("scene_type", "mode").agg(F.count("*").alias("target"))
    g = s.filter("campaign_id >= 4 AND reason IS NOT NULL").groupBy("scene_type", "mode").agg(F.count("*").alias("made"))
    return rel.full_merge(t, g, ["scene_type", "mode"], ["target", "made"])


@query("jn_selected_semi", oracle("SELECT sample_id, attempt_no, part_id FROM attempts a WHERE EXISTS (SELECT 1 FROM samples s WHERE s.sample_id = a.sample_id AND s.revision = a.revision AND s.status = 'accepted')", "attempts", "samples"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    chosen = view(spark, sf, "samples").filter("status = 'accepted'").select("sample_id", "revision")
    return view(spark, sf, "attempts").join(chosen, ["sample_id", "revision"], "left_semi").select("sample_id", "attempt_no", "part_id")


@query("jn_orphans_anti", oracle("SELECT sample_id, attempt_no, part_id FROM attempts a WHERE NOT EXISTS (SELECT 1 FROM samples s WHERE s.sample_id = a.sample_id AND s.revision = a.revision)", "attempts", "samples"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "attempts").join(view(spark, sf, "samples").select("sample_id", "revision"), ["sample_id", "revision"], "left_anti").select("sample_id", "attempt_no", "part_id")


@query("jn_point_in_box", oracle("SELECT v.sample_id, r.room_id, count(*) AS n FROM voxels v JOIN rooms r ON v.sample_id = r.sample_id AND x BETWEEN x0 AND x1 AND y BETWEEN y0 AND y1 AND z BETWEEN z0 AND z1 GROUP BY v.sample_id, r.room_id", "voxels", "rooms"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rel.in_boxes(view(spark, sf, "voxels"), view(spark, sf, "rooms"), "sample_id").groupBy("sample_id", "room_id").agg(F.count("*").alias("n"))


@query("jn_box_overlap", oracle("""
SELECT sample_id, first_id, second_id, volume FROM (
  SELECT a.sample_id, a.room_id AS first_id, b.room_id AS second_id,
    greatest(0, least(a.x1, b.x1) - greatest(a.x0, b.x0) + 1) * greatest(0, least(a.y1, b.y1) - greatest(a.y0, b.y0) + 1) * greatest(0, least(a.z1, b.z1) - greatest(a.z0, b.z0) + 1) AS volume
  FROM rooms a JOIN rooms b ON a.sample_id = b.sample_id AND a.room_id < b.room_id) WHERE volume > 0""", "rooms"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rel.box_overlaps(view(spark, sf, "rooms"), "sample_id", "room_id")


@query("jn_repair_pairs", oracle("""
, p AS (SELECT sample_id, max(attempt_no) AS after_revision FROM attempts WHERE status = 'complete' GROUP BY sample_id)
SELECT DISTINCT a.sample_id, a.attempt_no AS before_revision, p.after_revision, a.role FROM attempts a JOIN p USING (sample_id) WHERE a.status <> 'complete' AND a.attempt_no < p.after_revision""", "attempts"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rel.revision_pairs(view(spark, sf, "attempts"), "sample_id", "attempt_no", F.col("status") != "complete", F.col("status") == "complete", ["role"]).distinct()


@query("jn_duplicate_ids", oracle("""
, d AS (SELECT sample_id, part_id, cost, row_number() OVER w AS nth, first_value(role) OVER w AS f, role FROM attempts WINDOW w AS (PARTITION BY sample_id ORDER BY part_id, role))
SELECT sample_id, part_id, nth, CASE WHEN role = f THEN 'repeat' ELSE 'conflict' END AS finding FROM d WHERE nth > 1""", "attempts"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rel.duplicate_ids(view(spark, sf, "attempts"), "sample_id", "role", "part_id")


@query("jn_split_leakage", oracle("SELECT lineage, count(DISTINCT status) AS n_splits FROM samples WHERE status IN ('accepted', 'ready', 'rejected') GROUP BY lineage HAVING count(DISTINCT status) > 1", "samples"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return rel.leaking_groups(view(spark, sf, "samples"), "lineage", "status", ("accepted", "ready", "rejected"))


# --- sets


@query("set_difference", """
(SELECT c_nationkey AS k, 'left' AS side FROM (SELECT DISTINCT c_nationkey FROM customer WHERE c_acctbal > 9500) WHERE c_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 8000))
UNION ALL (SELECT s_nationkey, 'right' FROM (SELECT DISTINCT s_nationkey FROM supplier WHERE s_acctbal > 8000) WHERE s_nationkey NOT IN (SELECT c_nationkey FROM customer WHERE c_acctbal > 9500))""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    left = table(spark, sf, "customer").filter("c_acctbal > 9500").select(F.col("c_nationkey").alias("k")).distinct()
    right = table(spark, sf, "supplier").filter("s_acctbal > 8000").select(F.col("s_nationkey").alias("k")).distinct()
    return rel.set_difference(left, right)


@query("set_retained_share", oracle("""
, k AS (SELECT DISTINCT sample_id, x, y, z FROM voxels WHERE material <> 3)
SELECT v.sample_id, count(*) AS n_reference, count(k.x) AS n_kept, count(k.x) >= 0.7::DOUBLE * count(*) AS passes FROM voxels v LEFT JOIN k USING (sample_id, x, y, z) GROUP BY v.sample_id""", "voxels"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    v = view(spark, sf, "voxels")
    return rel.retained_share(v, v.filter("material <> 3"), "sample_id", ["x", "y", "z"], 0.7)


# --- aggregates


@query("agg_seed_stats", oracle("""
SELECT campaign_id, family_id, seed_id, count(*) FILTER (status = 'accepted') AS accepted, count(*) FILTER (status IN ('ready', 'running', 'deferred')) AS active,
  count(*) FILTER (status = 'rejected' AND reason IS DISTINCT FROM 'duplicate') AS rejected, count(*) FILTER (status = 'rejected' AND reason = 'duplicate') AS duplicate,
  count(*) FILTER (status = 'provisional_pass') AS provisional, count(*) AS planned FROM samples GROUP BY campaign_id, family_id, seed_id""", "samples"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    status, twice = F.col("status"), F.col("reason").eqNullSafe("duplicate")
    return agg.conditional_sums(view(spark, sf, "samples"), ["campaign_id", "family_id", "seed_id"], accepted=status == "accepted", active=status.isin("ready", "running", "deferred"),
                                rejected=(status == "rejected") & ~twice, duplicate=(status == "rejected") & twice, provisional=status == "provisional_pass", planned=F.lit(True))


@query("agg_composition_rates", oracle("""
SELECT scene_type, coalesce(mode, '') AS mode, count(*) AS tasks, count(*) FILTER (status = 'accepted') AS accepted, count(*) FILTER (reason IS NOT NULL) AS reviewed,
  count(*) FILTER (status IN ('accepted', 'provisional_pass')) / count(*) AS archive_rate,
  CASE WHEN count(*) FILTER (reason = 'visual') > 0 THEN count(*) FILTER (reason = 'visual' AND status = 'accepted') / count(*) FILTER (reason = 'visual') END AS visual_pass_rate
FROM samples GROUP BY scene_type, coalesce(mode, '')""", "samples"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    status, visual = F.col("status"), F.col("reason") == "visual"
    return view(spark, sf, "samples").groupBy("scene_type", F.coalesce("mode", F.lit("")).alias("mode")).agg(
        F.count("*").alias("tasks"), agg.count_where(status == "accepted").alias("accepted"), agg.count_where(F.col("reason").isNotNull()).alias("reviewed"),
        agg.rate(agg.count_where(status.isin("accepted", "provisional_pass")), F.count("*")).alias("archive_rate"),
        agg.rate(agg.count_where(visual & (status == "accepted")), agg.count_where(visual)).alias("visual_pass_rate"))


@query("agg_signed_deltas", oracle("""
, ch AS (SELECT campaign_id, status, -1 AS s FROM samples WHERE sample_id % 3 = 0 UNION ALL SELECT campaign_id, status, 1 FROM samples)
SELECT campaign_id, sum(CASE WHEN status = 'accepted' THEN s ELSE 0 END)::BIGINT AS accepted, sum(CASE WHEN status = 'rejected' THEN s ELSE 0 END)::BIGINT AS rejected FROM ch GROUP BY campaign_id""", "samples"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    s = view(spark, sf, "samples").select("campaign_id", "status", "sample_id")
    changes = s.filter("sample_id % 3 = 0").withColumn("s", F.lit(-1)).unionByName(s.withColumn("s", F.lit(1)))
    return agg.signed_deltas(changes, ["campaign_id"], "s", accepted=F.col("status") == "accepted", rejected=F.col("status") == "rejected")


@query("agg_coverage_totals", oracle("""
, i AS (SELECT campaign_id, family_id, count(*) FILTER (status = 'accepted') AS accepted, count(*) FILTER (status = 'rejected') AS rejected FROM samples GROUP BY campaign_id, family_id)
SELECT campaign_id, sum(accepted)::BIGINT AS accepted, sum(rejected)::BIGINT AS rejected, sum(greatest(0, 60 - accepted))::BIGINT AS debt, count(*) AS families FROM i GROUP BY campaign_id""", "samples"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    items = agg.conditional_sums(view(spark, sf, "samples"), ["campaign_id", "family_id"], accepted=F.col("status") == "accepted", rejected=F.col("status") == "rejected")
    return items.groupBy("campaign_id").agg(F.sum("accepted").alias("accepted"), F.sum("rejected").alias("rejected"), F.sum(F.greatest(F.lit(0), 60 - F.col("accepted"))).alias("debt"), F.count("*").alias("families"))


@query("agg_failures_by_reason", oracle("""
SELECT campaign_id, mode, reason, count(*) AS n FROM samples WHERE status = 'rejected' GROUP BY campaign_id, mode, reason
UNION ALL SELECT campaign_id, mode, 'ineligible', count(*) FROM samples WHERE status = 'accepted' AND reason = 'visual' GROUP BY campaign_id, mode""", "samples"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    s = view(spark, sf, "samples")
    failed = s.filter("status = 'rejected'").groupBy("campaign_id", "mode", "reason").agg(F.count("*").alias("n"))
    unfit = s.filter("status = 'accepted' AND reason = 'visual'").groupBy("campaign_id", "mode").agg(F.count("*").alias("n")).withColumn("reason", F.lit("ineligible"))
    return failed.unionByName(unfit)


@query("agg_queue_by_stage", oracle("""
SELECT stage, count(*) FILTER (status = 'ready') AS ready, count(*) FILTER (status = 'running') AS running,
  greatest(0, max(CASE WHEN status = 'ready' THEN date_diff('second', updated_at, TIMESTAMP '2002-01-01') END)) AS oldest_wait FROM samples GROUP BY stage""", "samples"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    now = F.unix_timestamp(F.lit("2002-01-01").cast("timestamp"))
    wait = F.max(F.when(F.col("status") == "ready", now - F.unix_timestamp("updated_at")))
    return view(spark, sf, "samples").groupBy("stage").agg(agg.count_where(F.col("status") == "ready").alias("ready"), agg.count_where(F.col("status") == "running").alias("running"), F.greatest(F.lit(0), wait).alias("oldest_wait"))


@query("agg_display_lanes", oracle("""
, m AS (SELECT * FROM (VALUES ('author', 'write'), ('refine', 'write'), ('review', 'judge'), ('build', 'make'), ('archive', 'store')) t(stage, lane))
SELECT lane, count(*) FILTER (status = 'ready') AS ready, count(*) FILTER (status = 'running') AS running, min(updated_at) AS oldest FROM samples JOIN m USING (stage) GROUP BY lane""", "samples"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    lane = F.when(F.col("stage").isin("author", "refine"), "write").when(F.col("stage") == "review", "judge").when(F.col("stage") == "build", "make").otherwise("store")
    return view(spark, sf, "samples").groupBy(lane.alias("lane")).agg(agg.count_where(F.col("status") == "ready").alias("ready"), agg.count_where(F.col("status") == "running").alias("running"), F.min("updated_at").alias("oldest"))


@query("agg_hourly_rate", oracle("""
, a AS (SELECT campaign_id, count(*) AS n, date_diff('second', max(ts), TIMESTAMP '2024-01-31') AS age FROM ledger WHERE kind = 'purchase' GROUP BY campaign_id)
SELECT campaign_id, n, CASE WHEN least(3600.0::DOUBLE, age::DOUBLE) >= 60 AND n > 0 THEN n * 3600 / least(3600.0::DOUBLE, age::DOUBLE) END AS per_hour FROM a""", "ledger"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    last = F.unix_timestamp(F.lit("2024-01-31").cast("timestamp")) - F.unix_timestamp(F.max("ts"))
    a = view(spark, sf, "ledger").filter("kind = 'purchase'").groupBy("campaign_id").agg(F.count("*").alias("n"), last.alias("age"))
    return a.select("campaign_id", "n", agg.hourly_rate(F.col("n"), F.col("age").cast("double")).alias("per_hour"))


@query("agg_pool_occupancy", oracle("SELECT pool, count(*) FILTER (occupancy) AS occupied, count(*) FILTER (occupancy AND status = 'outcome_unknown') AS unknown, count(*) FILTER (occupancy) - count(*) FILTER (occupancy AND status = 'outcome_unknown') AS effective FROM attempts GROUP BY pool", "attempts"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    n = agg.conditional_sums(view(spark, sf, "attempts"), ["pool"], occupied=F.col("occupancy"), unknown=F.col("occupancy") & (F.col("status") == "outcome_unknown"))
    return n.withColumn("effective", F.col("occupied") - F.col("unknown"))


@query("agg_order_statistics", """
WITH r AS (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY value) - 1 AS k, count(*) OVER (PARTITION BY event_type) AS n FROM events WHERE value IS NOT NULL)
SELECT event_type, max(CASE WHEN k = least(n - 1, CAST(floor(0.5 * n) AS BIGINT)) THEN value END) AS median, max(CASE WHEN k = least(n - 1, CAST(floor(0.95 * n) AS BIGINT)) THEN value END) AS p95, max(value) AS most FROM r GROUP BY event_type""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    ranks = [agg.nearest_rank(e, ["event_type"], "value", share, name) for share, name in ((0.5, "median"), (0.95, "p95"))]
    return ranks[0].join(ranks[1], "event_type").join(e.groupBy("event_type").agg(F.max("value").alias("most")), "event_type")


@query("agg_ordered_digest", "SELECT o_custkey, sha256(string_agg(concat(o_orderkey, ':', o_orderstatus), '' ORDER BY o_orderkey)) AS digest FROM orders GROUP BY o_custkey")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return agg.ordered_digest(table(spark, sf, "orders"), ["o_custkey"], ["o_orderkey"], F.concat_ws(":", "o_orderkey", "o_orderstatus"))


@query("agg_distinct_lineages", oracle("SELECT campaign_id, count(DISTINCT lineage) AS lineages, count(*) AS n FROM samples GROUP BY campaign_id", "samples"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "samples").groupBy("campaign_id").agg(F.countDistinct("lineage").alias("lineages"), F.count("*").alias("n"))


@query("agg_minute_window_share", oracle("""
SELECT event_id, count(*) OVER w AS n, count(*) FILTER (kind = 'error') OVER w AS failed FROM ledger WINDOW w AS (PARTITION BY campaign_id ORDER BY ts RANGE BETWEEN INTERVAL 3600 SECOND PRECEDING AND CURRENT ROW)""", "ledger"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return agg.last_minutes(view(spark, sf, "ledger"), ["campaign_id"], "ts", 3600, n=F.count("*"), failed=F.count(F.when(F.col("kind") == "error", 1))).select("event_id", "n", "failed")


@query("agg_inventory", """
SELECT lang, count(*) AS files, count(DISTINCT source) AS sources, count(*) FILTER (n_chars < 200) AS short, count(*) FILTER (text LIKE '%Copyright%') AS licensed, min(n_chars) AS least, max(n_chars) AS most, sum(n_chars)::BIGINT AS chars FROM documents GROUP BY lang""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").groupBy("lang").agg(F.count("*").alias("files"), F.countDistinct("source").alias("sources"), agg.count_where(F.col("n_chars") < 200).alias("short"),
        agg.count_where(F.col("text").contains("Copyright")).alias("licensed"), F.min("n_chars").alias("least"), F.max("n_chars").alias("most"), F.sum("n_chars").alias("chars"))


# --- order, rank, window


@query("ord_page", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey > 1000 ORDER BY o_orderkey LIMIT 101")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return ranking.page(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), "o_orderkey", 1000, 500)


@query("ord_ready_queue", oracle("SELECT sample_id, stage, updated_at FROM samples WHERE status = 'ready' ORDER BY CASE WHEN stage = 'review' THEN 0 ELSE 1 END, updated_at, sample_id LIMIT 64", "samples"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "samples").filter("status = 'ready'").orderBy(F.when(F.col("stage") == "review", 0).otherwise(1), "updated_at", "sample_id").limit(64).select("sample_id", "stage", "updated_at")


@query("ord_neediest_family", oracle("""
, f AS (SELECT campaign_id, family_id, count(*) FILTER (status = 'accepted') AS accepted, count(*) FILTER (status = 'running') AS active FROM samples GROUP BY campaign_id, family_id)
SELECT campaign_id, arg_max(family_id, ROW((greatest(0, 60 - accepted) - active) / 60, -active, family_id)) AS family_id FROM f GROUP BY campaign_id""", "samples"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    f = agg.conditional_sums(view(spark, sf, "samples"), ["campaign_id", "family_id"], accepted=F.col("status") == "accepted", active=F.col("status") == "running")
    need = (F.greatest(F.lit(0), 60 - F.col("accepted")) - F.col("active")) / 60
    return ranking.best_by(f, ["campaign_id"], "family_id", [need.alias("need"), (-F.col("active")).alias("idle"), F.col("family_id")])


@query("ord_least_used_seed", oracle("""
, f AS (SELECT campaign_id, family_id, seed_id, count(*) FILTER (status IN ('accepted', 'running')) AS used, count(*) AS planned FROM samples GROUP BY campaign_id, family_id, seed_id)
SELECT campaign_id, family_id, arg_min(seed_id, ROW(used, planned, seed_id)) AS seed_id FROM f GROUP BY campaign_id, family_id""", "samples"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    f = agg.conditional_sums(view(spark, sf, "samples"), ["campaign_id", "family_id", "seed_id"], used=F.col("status").isin("accepted", "running"), planned=F.lit(True))
    return ranking.best_by(f, ["campaign_id", "family_id"], "seed_id", [F.col("used"), F.col("planned"), F.col("seed_id")], least=True)


@query("win_seeded_sample", oracle("""
SELECT scene_type, sample_id, rank FROM (SELECT scene_type, sample_id, row_number() OVER (PARTITION BY scene_type ORDER BY sha256(concat('17:', sample_id, ':', revision)), sample_id, revision)::INT AS rank FROM samples) WHERE rank <= 20""", "samples"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return ranking.seeded_rank(view(spark, sf, "samples"), ["scene_type"], "17", ["sample_id", "revision"]).filter("rank <= 20").select("scene_type", "sample_id", "rank")


@query("win_round_robin", oracle("""
, r AS (SELECT scene_type, stage, sample_id, row_number() OVER (PARTITION BY scene_type, stage ORDER BY sha256(concat('5:', sample_id, ':', revision)), sample_id, revision)::INT AS rank FROM samples)
SELECT scene_type, stage, sample_id, rank FROM r ORDER BY rank, scene_type, stage LIMIT 40""", "samples"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    ranked = ranking.seeded_rank(view(spark, sf, "samples"), ["scene_type", "stage"], "5", ["sample_id", "revision"])
    return ranking.round_robin(ranked.select("scene_type", "stage", "sample_id", "rank"), ["scene_type", "stage"], 40)


@query("win_failure_streak", oracle("""
, i AS (SELECT event_id, campaign_id, ts, kind, sum(CASE WHEN kind <> 'error' THEN 1 ELSE 0 END) OVER (PARTITION BY campaign_id ORDER BY ts, event_id) AS g FROM ledger)
SELECT event_id, campaign_id, count(*) FILTER (kind = 'error') OVER (PARTITION BY campaign_id, g ORDER BY ts, event_id) AS streak FROM i""", "ledger"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return ranking.streaks(view(spark, sf, "ledger"), ["campaign_id"], ["ts", "event_id"], F.col("kind") != "error").select("event_id", "campaign_id", "streak")


@query("win_same_error_streak", oracle("""
, i AS (SELECT event_id, sample_id, ts, kind, CASE WHEN kind = lag(kind) OVER w THEN 0 ELSE 1 END AS new FROM ledger WINDOW w AS (PARTITION BY sample_id ORDER BY ts, event_id)),
g AS (SELECT *, sum(new) OVER (PARTITION BY sample_id ORDER BY ts, event_id) AS g FROM i)
SELECT event_id, sample_id, row_number() OVER (PARTITION BY sample_id, g ORDER BY ts, event_id)::INT AS streak FROM g""", "ledger"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return ranking.same_streak(view(spark, sf, "ledger"), ["sample_id"], ["ts", "event_id"], "kind").select("event_id", "sample_id", "streak")


@query("win_mode_quota", oracle(f"""
, l AS (SELECT mode, (20 + 10 * i)::INT AS most FROM (VALUES {MODES}) t(mode, i))
SELECT mode, sample_id, rank FROM (SELECT s.mode, sample_id, most, row_number() OVER (PARTITION BY s.mode ORDER BY sample_id, revision)::INT AS rank FROM samples s JOIN l ON s.mode = l.mode WHERE status = 'accepted') WHERE rank <= most""", "samples"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    limits = spark.createDataFrame([(m, 20 + 10 * i) for i, m in enumerate(fn.MODES)], "mode string, most int")
    return ranking.quota(view(spark, sf, "samples").filter("status = 'accepted'"), ["mode"], ["sample_id", "revision"], limits, "most").select("mode", "sample_id", "rank")


@query("win_first_then_repeats", oracle("""
, f AS (SELECT campaign_id, reason, sample_id, row_number() OVER (PARTITION BY campaign_id, reason ORDER BY sample_id) AS n FROM samples WHERE reason IS NOT NULL)
SELECT campaign_id, reason, sample_id, row_number() OVER (PARTITION BY campaign_id ORDER BY CASE WHEN n > 1 THEN 1 ELSE 0 END, sample_id)::INT AS place FROM f""", "samples"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return ranking.first_then_repeats(view(spark, sf, "samples").filter("reason IS NOT NULL"), ["campaign_id"], "reason", "sample_id").select("campaign_id", "reason", "sample_id", "place")


@query("win_rotating_preference", oracle("SELECT campaign_id, sample_id, (row_number() OVER (PARTITION BY campaign_id ORDER BY sample_id) - 1)::INT AS round, CASE WHEN (row_number() OVER (PARTITION BY campaign_id ORDER BY sample_id) - 1) % 8 = 7 THEN -1 ELSE (row_number() OVER (PARTITION BY campaign_id ORDER BY sample_id) - 1) % 7 END::INT AS slot FROM samples", "samples"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    s = view(spark, sf, "samples").withColumn("round", F.row_number().over(W.partitionBy("campaign_id").orderBy("sample_id")) - 1)
    return s.select("campaign_id", "sample_id", "round", F.when(F.col("round") % 8 == 7, -1).otherwise(F.col("round") % 7).alias("slot"))


@query("win_bounded_shards")
def _(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("source", "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("size"))
    return ranking.bounded_shards(docs, "source", ["doc_id"], "size", 64, 200_000)


# --- quotas


@query("pln_apportion", oracle("""
, w AS (SELECT campaign_id, target, family_id, (family_id * 7 + campaign_id) % 11 - 1 AS weight FROM campaigns, families),
q AS (SELECT campaign_id, target, family_id, target * greatest(0.0::DOUBLE, weight::DOUBLE) / sum(greatest(0.0::DOUBLE, weight::DOUBLE)) OVER (PARTITION BY campaign_id) AS q FROM w),
r AS (SELECT *, floor(q) AS f, row_number() OVER (PARTITION BY campaign_id ORDER BY q - floor(q) DESC, family_id) AS n, target - sum(floor(q)) OVER (PARTITION BY campaign_id) AS rest FROM q)
SELECT campaign_id, family_id, (f + CASE WHEN n <= rest THEN 1 ELSE 0 END)::BIGINT AS quota FROM r""", "campaigns", "families"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    c, f = view(spark, sf, "campaigns"), view(spark, sf, "families")
    grid = c.select("campaign_id", "target", F.explode(F.sequence(F.lit(0), F.lit(24))).alias("family_id")).join(f.select("family_id"), "family_id")
    weights = grid.withColumn("weight", (F.col("family_id") * 7 + F.col("campaign_id")) % 11 - 1)
    return quotas.apportion(weights, ["campaign_id"], "family_id", "weight", "target").withColumn("quota", F.col("quota").cast("long"))


@query("pln_mode_debts", oracle(f"""
, m AS (SELECT mode, (i + 1) * 500 AS target FROM (VALUES {MODES}) t(mode, i)),
s AS (SELECT mode, count(*) FILTER (status = 'accepted') AS accepted, count(*) FILTER (status = 'provisional_pass') AS provisional FROM samples WHERE mode IS NOT NULL GROUP BY mode)
SELECT mode, target, coalesce(accepted, 0) AS accepted, coalesce(provisional, 0) AS provisional, greatest(0, target - coalesce(accepted, 0)) AS debt, greatest(0, target - coalesce(accepted, 0) - coalesce(provisional, 0)) AS candidate_debt
FROM m LEFT JOIN s USING (mode)""", "samples"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    targets = spark.createDataFrame([(m, (i + 1) * 500) for i, m in enumerate(fn.MODES)], "mode string, target int")
    stats = agg.conditional_sums(view(spark, sf, "samples").filter("mode IS NOT NULL"), ["mode"], accepted=F.col("status") == "accepted", provisional=F.col("status") == "provisional_pass")
    return quotas.debts(targets, stats, ["mode"])


# --- functions


@query("fn_stable_ids", "SELECT o_orderkey, substr(sha256(concat('task:', o_orderkey, ':', o_custkey)), 1, 24) AS task_id, concat(o_orderkey, '-r', lpad(CAST(o_custkey % 100 AS VARCHAR), 4, '0')) AS asset_id FROM orders")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select("o_orderkey", fn.stable_id("task", F.col("o_orderkey"), F.col("o_custkey")).alias("task_id"), fn.asset_id(F.col("o_orderkey"), F.col("o_custkey") % 100).alias("asset_id"))


@query("fn_block_state", """
WITH s AS (SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN concat(replace(p_name, ' ', '_'), '[waterlogged=false,axis=x]') WHEN 1 THEN replace(p_name, ' ', '_') WHEN 2 THEN concat('mod:', replace(p_name, ' ', '_'), '[b=1,a=2]') WHEN 3 THEN p_name ELSE concat(replace(p_name, ' ', '_'), '[axis=') END AS state FROM part),
f AS (SELECT p_partkey, state, CASE WHEN contains(regexp_extract(state, '^[^\\[]*'), ':') THEN state ELSE concat('minecraft:', state) END AS full_ FROM s)
SELECT p_partkey, CASE WHEN regexp_full_match(full_, '[a-z0-9_.-]+:[a-z0-9_./-]+(\\[[a-z0-9_]+=[a-z0-9_.-]+(,[a-z0-9_]+=[a-z0-9_.-]+)*\\])?')
  THEN concat(regexp_extract(full_, '^[^\\[]*'), CASE WHEN contains(full_, '[') THEN concat('[', array_to_string(list_sort(string_split(regexp_extract(full_, '\\[([^\\]]*)\\]$', 1), ',')), ','), ']') ELSE '' END) END AS state,
  replace(split_part(state, '[', 1), 'minecraft:', '') AS material FROM f""".replace("\\\\", "\\"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    name, k = F.replace(F.col("p_name"), F.lit(" "), F.lit("_")), F.col("p_partkey") % 5
    state = (F.when(k == 0, F.concat(name, F.lit("[waterlogged=false,axis=x]"))).when(k == 1, name).when(k == 2, F.concat(F.lit("mod:"), name, F.lit("[b=1,a=2]"))).when(k == 3, F.col("p_name")).otherwise(F.concat(name, F.lit("[axis="))))
    return table(spark, sf, "part").select("p_partkey", state.alias("s")).select("p_partkey", fn.block_state(F.col("s")).alias("state"), fn.base_material(F.col("s")).alias("material"))


@query("fn_price_and_minutes", oracle("""
SELECT sample_id, attempt_no, part_id, CASE WHEN tokens >= 0 AND attempt_no * 100 >= 0 THEN tokens * 3 + attempt_no * 100 * 15 END AS price_micros, CAST(floor(epoch(started_at) / 60) * 60 AS BIGINT) AS minute FROM attempts""", "attempts"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "attempts").select("sample_id", "attempt_no", "part_id", fn.price_micros(F.col("tokens"), F.col("attempt_no") * 100, 3, 15).alias("price_micros"), fn.minute(F.unix_timestamp("started_at")).alias("minute"))


@query("fn_retry_and_errors", """
SELECT event_id, CASE WHEN event_id % 17 = 0 THEN 60.0::DOUBLE * (event_id % 60) WHEN event_id % 11 = 0 OR event_id % 13 = 0 OR event_type = 'error' THEN 5.0::DOUBLE
    ELSE least(3600.0::DOUBLE, greatest(0.0::DOUBLE, CASE WHEN event_type = 'click' THEN -value ELSE value END::DOUBLE)) END AS delay,
  CASE WHEN event_id % 600 = 429 THEN 'rate_limited' WHEN event_id % 600 IN (401, 403) THEN 'endpoint_auth' WHEN event_id % 600 = 402 THEN 'endpoint_quota'
    WHEN event_id % 600 BETWEEN 300 AND 399 OR event_id % 600 IN (400, 404, 422) THEN 'endpoint_configuration' WHEN event_id % 600 >= 500 THEN 'service_busy'
    WHEN event_id % 600 >= 300 THEN 'provider_error' END AS category FROM events""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    value, k = F.col("value").cast("string"), F.col("event_id")
    date = F.concat(F.lit("Thu, 01 Jan 2026 00:"), F.lpad((k % 60).cast("string"), 2, "0"), F.lit(":00 GMT"))
    header = F.when(k % 17 == 0, date).when(k % 11 == 0, "Infinity").when(k % 13 == 0, "NaN").when(F.col("event_type") == "error", F.concat(F.lit("x"), value)).when(F.col("event_type") == "click", (-F.col("value")).cast("string")).otherwise(value)
    return table(spark, sf, "events").select("event_id", fn.retry_delay(header, F.lit("2026-01-01 00:00:00+00:00").cast("timestamp")).alias("delay"), fn.error_category(k % 600).alias("category"))


@query("fn_composition_compliance", oracle(f"""
, r AS (SELECT * FROM (VALUES {MODES}) t(mode, i)),
o AS (SELECT s.sample_id, s.mode, a.i AS want, CASE WHEN s.sample_id % 7 = 0 THEN NULL ELSE b.mode END AS observed, b.i AS have,
  CASE s.sample_id % 6 WHEN 0 THEN 'unclear' WHEN 1 THEN 'absent' WHEN 2 THEN 'incidental' WHEN 3 THEN 'co_primary' ELSE 'dominant' END AS focus, s.sample_id % 13 = 0 AS extraneous
  FROM samples s JOIN r a ON s.mode = a.mode JOIN r b ON b.i = s.family_id % 4),
w AS (SELECT *, CASE WHEN focus = 'unclear' OR observed IS NULL THEN NULL WHEN focus IN ('absent', 'incidental') OR extraneous THEN FALSE ELSE have <= want AND (want > 1 OR focus = 'dominant') END AS allowed FROM o)
SELECT sample_id, allowed, CASE WHEN allowed IS NULL THEN NULL ELSE allowed AND observed = mode END AS complies FROM w""", "samples"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    seen = F.when(F.col("sample_id") % 7 != 0, F.element_at(F.array(*[F.lit(m) for m in fn.MODES]), (F.col("family_id") % 4 + 1).cast("int")))
    k = F.col("sample_id") % 6
    focus = F.when(k == 0, "unclear").when(k == 1, "absent").when(k == 2, "incidental").when(k == 3, "co_primary").otherwise("dominant")
    given = [F.col("mode"), F.col("observed"), F.col("focus"), F.col("extraneous")]
    s = view(spark, sf, "samples").filter("mode IS NOT NULL").select("sample_id", "mode", seen.alias("observed"), focus.alias("focus"), (F.col("sample_id") % 13 == 0).alias("extraneous"))
    return s.select("sample_id", fn.within_allowance(*given).alias("allowed"), fn.complies(*given).alias("complies"))


@query("fn_progress", oracle("""
SELECT c.campaign_id, count(s.sample_id) AS accepted, CASE WHEN c.target > 0 THEN least(100.0::DOUBLE, count(s.sample_id) / c.target * 100) ELSE 0.0 END AS progress
FROM campaigns c LEFT JOIN samples s ON s.campaign_id = c.campaign_id AND s.status = 'accepted' AND s.stage = 'review' GROUP BY c.campaign_id, c.target""", "campaigns", "samples"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    done = view(spark, sf, "samples").filter("status = 'accepted' AND stage = 'review'").groupBy("campaign_id").agg(F.count("*").alias("accepted"))
    c = view(spark, sf, "campaigns").join(done, "campaign_id", "left").withColumn("accepted", F.coalesce("accepted", F.lit(0)))
    return c.select("campaign_id", "accepted", fn.progress(F.col("accepted"), F.col("target")).alias("progress"))


@query("fn_half_even", "SELECT p_partkey, CAST(floor(round_even(p_retailprice / 8, 2) * 100 + 0.5) AS BIGINT) AS eighth FROM part")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select("p_partkey", F.floor(fn.half_even(F.col("p_retailprice") / 8, 2) * 100 + 0.5).cast("long").alias("eighth"))
