"""Queues, guards, evidence binding, cooldowns and the remaining small operators over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from tessel.functions import text as fn
from tessel.operators import aggregates as agg, geometry as geo, grids, ranking, relations as rel
from tessel.plans.registry import query
from tessel.plans.tables import table
from tessel.plans.views import oracle, parts, view

KEY = "sample_id"
SPACE = "6ba7b811-9dad-11d1-80b4-00c04fd430c8"


@query("src_command_queue", oracle("SELECT event_id, campaign_id, kind FROM ledger WHERE status = 'ready' ORDER BY ts, event_id LIMIT 100", "ledger"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "ledger").filter("status = 'ready'").orderBy("ts", "event_id").limit(100).select("event_id", "campaign_id", "kind")


@query("snk_registered_artifacts", f"""
WITH h AS (SELECT page_id, url, sha1('\\x6b\\xa7\\xb8\\x11\\x9d\\xad\\x11\\xd1\\x80\\xb4\\x00\\xc0\\x4f\\xd4\\x30\\xc8'::BLOB || encode(url)) AS h FROM pages WHERE url IS NOT NULL),
u AS (SELECT page_id, url, concat(substr(h, 1, 8), '-', substr(h, 9, 4), '-5', substr(h, 14, 3), '-', substr('89ab', (CAST(concat('0x', substr(h, 17, 1)) AS INT) % 4) + 1, 1), substr(h, 18, 3), '-', substr(h, 21, 12)) AS artifact_id FROM h)
SELECT artifact_id, min(page_id) AS page_id, count(*) AS uses FROM u GROUP BY artifact_id""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages").filter("url IS NOT NULL").select("page_id", fn.uuid5(SPACE, F.col("url")).alias("artifact_id"))
    return pages.groupBy("artifact_id").agg(F.min("page_id").alias("page_id"), F.count("*").alias("uses"))


@query("snk_newest_features", oracle("SELECT part_id, cost, sample_id FROM (SELECT *, row_number() OVER (PARTITION BY part_id ORDER BY started_at DESC, sample_id DESC, attempt_no DESC, endpoint_id DESC, cost DESC NULLS LAST) AS n FROM attempts) WHERE n = 1", "attempts"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    w = W.partitionBy("part_id").orderBy(*[F.desc(c) for c in ("started_at", "sample_id", "attempt_no", "endpoint_id")], F.desc_nulls_last("cost"))
    return view(spark, sf, "attempts").withColumn("n", F.row_number().over(w)).filter("n = 1").select("part_id", "cost", "sample_id")


@query("fil_release_eligible", oracle("SELECT sample_id, mode FROM samples WHERE (status = 'accepted' OR (status = 'provisional_pass' AND stage = 'archive')) AND NOT coalesce(reason = 'visual', FALSE) AND (mode IN ('pure_target', 'contextual') OR scene_type = 'natural')", "samples"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    s = view(spark, sf, "samples")
    allowed = (F.col("status") == "accepted") | ((F.col("status") == "provisional_pass") & (F.col("stage") == "archive"))
    return s.filter(allowed & ~F.coalesce(F.col("reason") == "visual", F.lit(False)) & (F.coalesce(F.col("mode").isin("pure_target", "contextual"), F.lit(False)) | (F.col("scene_type") == "natural"))).select(KEY, "mode")


@query("fil_backup_guard", oracle("""
SELECT c.campaign_id, c.state = 'running' AS running_campaign, coalesce(s.n, 0) AS leased, coalesce(s.n, 0) = 0 AND c.state <> 'running' AS may_back_up
FROM campaigns c LEFT JOIN (SELECT campaign_id, count(*) AS n FROM samples WHERE status = 'running' AND stage = 'review' GROUP BY campaign_id) s USING (campaign_id)""", "campaigns", "samples"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    leased = view(spark, sf, "samples").filter("status = 'running' AND stage = 'review'").groupBy("campaign_id").agg(F.count("*").alias("leased"))
    c = view(spark, sf, "campaigns").join(leased, "campaign_id", "left").fillna(0, ["leased"])
    return c.select("campaign_id", (F.col("state") == "running").alias("running_campaign"), "leased", ((F.col("leased") == 0) & (F.col("state") != "running")).alias("may_back_up"))


@query("jn_missing_components", oracle("""
, o AS (SELECT sample_id, list(DISTINCT component_id) AS have FROM voxels GROUP BY sample_id)
SELECT sample_id, array_to_string(list_sort(list_filter([0, 1, 2, 3, 4, 5, 6, 7, sample_id % 11], lambda x: NOT list_contains(have, x))), ',') AS missing FROM o""".replace("[0, 1, 2, 3, 4, 5, 6, 7, sample_id % 11]", "list_distinct([0, 1, 2, 3, 4, 5, 6, 7, sample_id % 11])"), "voxels"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    have = view(spark, sf, "voxels").groupBy(KEY).agg(F.collect_set("component_id").alias("have"))
    wanted = F.array(*[F.lit(i).cast("long") for i in range(8)], F.col(KEY) % 11)
    return have.select(KEY, F.array_join(F.array_sort(F.array_except(wanted, "have")), ",").alias("missing"))


@query("jn_config_history", oracle("""
, h AS (SELECT DISTINCT campaign_id, stage, sha256(concat(stage, '/', campaign_id)) AS config_hash FROM samples), c AS (SELECT DISTINCT sha256(concat(stage, '/', campaign_id)) AS config_hash, stage AS body FROM samples WHERE stage <> 'build')
SELECT campaign_id, stage, body FROM h LEFT JOIN c USING (config_hash)""", "samples"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    mark = F.sha2(F.concat_ws("/", "stage", "campaign_id"), 256).alias("config_hash")
    s = view(spark, sf, "samples")
    snapshots = s.filter("stage <> 'build'").select(mark, F.col("stage").alias("body")).distinct()
    return s.select("campaign_id", "stage", mark).distinct().join(snapshots, "config_hash", "left").select("campaign_id", "stage", "body")


@query("agg_window_failure_share", oracle("""
, w AS (SELECT campaign_id, CAST(floor(epoch(ts) / 14400) AS BIGINT) AS window_no, count(*) AS results, count(*) FILTER (kind = 'error') AS failed FROM ledger GROUP BY campaign_id, CAST(floor(epoch(ts) / 14400) AS BIGINT))
SELECT campaign_id, window_no, results, CASE WHEN results >= 8 THEN failed / results END AS share FROM w""", "ledger"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    e = view(spark, sf, "ledger").groupBy("campaign_id", F.floor(F.unix_timestamp("ts") / 14400).alias("window_no")).agg(F.count("*").alias("results"), agg.count_where(F.col("kind") == "error").alias("failed"))
    return e.select("campaign_id", "window_no", "results", F.when(F.col("results") >= 8, F.col("failed") / F.col("results")).alias("share"))


@query("agg_scalar_caps", oracle("SELECT count(*) FILTER (occupancy) AS busy, count(*) FILTER (occupancy AND pool = 3) AS busy_pool, count(*) FILTER (cost IS NULL) AS unknown, count(DISTINCT pool) AS pools, coalesce(max(part_id), 0) AS high_water FROM attempts", "attempts"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    busy = F.col("occupancy")
    return view(spark, sf, "attempts").agg(agg.count_where(busy).alias("busy"), agg.count_where(busy & (F.col("pool") == 3)).alias("busy_pool"), agg.count_where(F.col("cost").isNull()).alias("unknown"), F.countDistinct("pool").alias("pools"), F.coalesce(F.max("part_id"), F.lit(0)).alias("high_water"))


@query("agg_provenance", oracle("""
SELECT endpoint_id, role, count(*) AS total, CASE WHEN count(cost) > 0 THEN sum(cost)::BIGINT END AS cost_known, count(*) FILTER (cost IS NULL) AS cost_unknown, CASE WHEN count(tokens) = count(*) THEN sum(tokens)::BIGINT END AS tokens, min(started_at) AS first_at, max(started_at) AS last_at FROM attempts GROUP BY endpoint_id, role""", "attempts"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "attempts").groupBy("endpoint_id", "role").agg(F.count("*").alias("total"), F.sum("cost").alias("cost_known"), agg.count_where(F.col("cost").isNull()).alias("cost_unknown"), agg.sum_or_null(F.col("tokens")).alias("tokens"), F.min("started_at").alias("first_at"), F.max("started_at").alias("last_at"))


@query("geo_measures_bound", oracle("""
, m AS (SELECT sample_id, component_id, count(*) AS n FROM voxels GROUP BY sample_id, component_id), d AS (SELECT sample_id, component_id, n + CASE WHEN (sample_id + component_id) % 13 = 0 THEN 1 ELSE 0 END AS n FROM m WHERE component_id <> 6 OR sample_id % 3 = 0)
SELECT coalesce(m.sample_id, d.sample_id) AS sample_id, coalesce(m.component_id, d.component_id) AS component_id, CASE WHEN d.n IS NULL THEN 'missing' ELSE 'altered' END AS finding FROM m LEFT JOIN d ON m.sample_id = d.sample_id AND m.component_id = d.component_id WHERE d.n IS NULL OR d.n <> m.n""", "voxels"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    m = view(spark, sf, "voxels").groupBy(KEY, "component_id").agg(F.count("*").alias("n"))
    declared = m.filter("component_id <> 6 OR sample_id % 3 = 0").withColumn("n", F.col("n") + F.when((F.col(KEY) + F.col("component_id")) % 13 == 0, 1).otherwise(0))
    both = m.join(declared.withColumnRenamed("n", "declared"), [KEY, "component_id"], "left")
    return both.filter("declared IS NULL OR declared <> n").select(KEY, "component_id", F.when(F.col("declared").isNull(), "missing").otherwise("altered").alias("finding"))


@query("geo_opening_intrusion", oracle("SELECT r.sample_id, r.room_id, count(v.x) AS n_inside FROM (SELECT sample_id, room_id, x0, x0 AS x1, y0, y1, z0, z1 FROM rooms) r LEFT JOIN voxels v ON v.sample_id = r.sample_id AND x BETWEEN x0 AND x1 AND y BETWEEN y0 AND y1 AND z BETWEEN z0 AND z1 AND material <> 2 GROUP BY r.sample_id, r.room_id", "rooms", "voxels"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return geo.opening_clear(view(spark, sf, "rooms").withColumn("x1", F.col("x0")), view(spark, sf, "voxels").filter("material <> 2"), KEY, "room_id", parts(spark, sf, "voxels"))


@query("geo_foundation_and_walls", oracle("""
, w AS (SELECT sample_id, z, count(*) AS n, max(y) - min(y) + 1 AS high, max(x) - min(x) + 1 AS wide, count(*) FILTER (material = 2) AS openings FROM voxels GROUP BY sample_id, z),
f AS (SELECT sample_id, count(*) FILTER (y = 0) / count(*) AS foundation_share FROM voxels GROUP BY sample_id)
SELECT f.sample_id, foundation_share > 0.2::DOUBLE AS heavy, count(*) FILTER (n >= 8 AND high >= 5 AND wide >= 8 AND openings = 0) AS flat_walls FROM f JOIN w USING (sample_id) GROUP BY f.sample_id, foundation_share""", "voxels"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    v = view(spark, sf, "voxels")
    walls = v.groupBy(KEY, "z").agg(F.count("*").alias("n"), (F.max("y") - F.min("y") + 1).alias("high"), (F.max("x") - F.min("x") + 1).alias("wide"), agg.count_where(F.col("material") == 2).alias("openings"), agg.count_where(F.col("y") == 0).alias("low"))
    flat = (F.col("n") >= 8) & (F.col("high") >= 5) & (F.col("wide") >= 8) & (F.col("openings") == 0)
    return walls.groupBy(KEY).agg((F.sum("low") / F.sum("n") > 0.2).alias("heavy"), agg.count_where(flat).alias("flat_walls"))


@query("geo_acceptance", oracle("""
, m AS (SELECT sample_id, count(*) AS n, count(DISTINCT component_id) AS parts, count(*) FILTER (component_id = 0) AS core, max(material) AS top FROM voxels GROUP BY sample_id)
SELECT sample_id, coalesce(n >= 70, FALSE) AND parts = 7 AND core > 5 AND top = 3 AND sample_id % 3 <> 0 AS accepted FROM m""", "voxels"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    m = view(spark, sf, "voxels").groupBy(KEY).agg(F.count("*").alias("n"), F.countDistinct("component_id").alias("parts"), agg.count_where(F.col("component_id") == 0).alias("core"), F.max("material").alias("top"))
    return m.select(KEY, (F.coalesce(F.col("n") >= 70, F.lit(False)) & (F.col("parts") == 7) & (F.col("core") > 5) & (F.col("top") == 3) & (F.col(KEY) % 3 != 0)).alias("accepted"))


@query("geo_nearest_main", oracle("""
, a AS (SELECT sample_id, x, y, z FROM voxels WHERE component_id = 0), b AS (SELECT sample_id, x, y, z FROM voxels WHERE component_id <> 0),
d AS (SELECT b.sample_id, b.x, b.y, b.z, min((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z)) AS gap FROM b JOIN a USING (sample_id) GROUP BY b.sample_id, b.x, b.y, b.z)
SELECT sample_id, max(gap)::BIGINT AS widest_gap, count(*) AS n FROM d GROUP BY sample_id""", "voxels"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    v = view(spark, sf, "voxels")
    near = grids.nearest_cells(v.filter("component_id <> 0"), v.filter("component_id = 0"), KEY, parts(spark, sf, "voxels"))
    return near.groupBy(KEY).agg(F.max("gap").alias("widest_gap"), F.count("*").alias("n"))


@query("led_family_cooldown", oracle("""
, f AS (SELECT sample_id % 32 AS family_id, count(*) FILTER (kind = 'error') AS failures, max(CASE WHEN kind = 'error' THEN ts END) AS last_failure FROM ledger WHERE ts >= TIMESTAMP '2024-01-28' GROUP BY sample_id % 32)
SELECT family_id, failures, NOT coalesce(failures >= 5 AND last_failure > TIMESTAMP '2024-01-30 12:00:00', FALSE) AS available FROM f""", "ledger"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    at = lambda s: F.lit(s).cast("timestamp")
    recent = view(spark, sf, "ledger").filter(F.col("ts") >= at("2024-01-28"))
    f = recent.groupBy((F.col(KEY) % 32).alias("family_id")).agg(agg.count_where(F.col("kind") == "error").alias("failures"), F.max(F.when(F.col("kind") == "error", F.col("ts"))).alias("last"))
    return f.select("family_id", "failures", (~F.coalesce((F.col("failures") >= 5) & (F.col("last") > at("2024-01-30 12:00:00")), F.lit(False))).alias("available"))


@query("led_requeue", oracle("""
SELECT sample_id, status AS was, CASE WHEN status = 'running' AND stage IN ('author', 'refine', 'review') THEN 'deferred' WHEN status = 'running' THEN 'ready' WHEN status = 'deferred' AND reason IS NULL THEN 'ready' END AS becomes FROM samples
WHERE status = 'running' OR (status = 'deferred' AND reason IS NULL)""", "samples"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    running = F.col("status") == "running"
    becomes = F.when(running & F.col("stage").isin("author", "refine", "review"), "deferred").when(running, "ready").when((F.col("status") == "deferred") & F.col("reason").isNull(), "ready")
    return view(spark, sf, "samples").select(KEY, F.col("status").alias("was"), becomes.alias("becomes")).filter("becomes IS NOT NULL")


@query("led_recent_ring", oracle("SELECT event_id, campaign_id FROM (SELECT event_id, campaign_id, row_number() OVER (PARTITION BY campaign_id ORDER BY ts DESC, event_id DESC) AS n FROM ledger) WHERE n <= 1024", "ledger"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    w = W.partitionBy("campaign_id").orderBy(F.desc("ts"), F.desc("event_id"))
    return view(spark, sf, "ledger").withColumn("n", F.row_number().over(w)).filter("n <= 1024").select("event_id", "campaign_id")


@query("pln_effective_cap", oracle("""
, b AS (SELECT campaign_id, count(*) AS backlog FROM samples WHERE status = 'ready' GROUP BY campaign_id)
SELECT c.campaign_id, least(5, c.api_cap, CASE WHEN coalesce(backlog, 0) > 300 THEN 4 ELSE 6 END)::BIGINT AS cap FROM campaigns c LEFT JOIN b USING (campaign_id)""", "campaigns", "samples"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    backlog = view(spark, sf, "samples").filter("status = 'ready'").groupBy("campaign_id").agg(F.count("*").alias("backlog"))
    c = view(spark, sf, "campaigns").join(backlog, "campaign_id", "left")
    return c.select("campaign_id", F.least(F.lit(5), "api_cap", F.when(F.coalesce("backlog", F.lit(0)) > 300, 4).otherwise(6)).cast("long").alias("cap"))


@query("pln_shortages", oracle("""
, l AS (SELECT mode, 100 * (CASE mode WHEN 'pure_target' THEN 4 WHEN 'light_context' THEN 5 WHEN 'contextual' THEN 10 ELSE 20 END) AS target FROM (SELECT DISTINCT mode FROM samples WHERE mode IS NOT NULL)), h AS (SELECT mode, count(*) AS available FROM samples WHERE status = 'accepted' GROUP BY mode)
SELECT mode, target, coalesce(available, 0) AS available FROM l LEFT JOIN h USING (mode) WHERE coalesce(available, 0) < target""", "samples"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    limits = spark.createDataFrame(list(zip(fn.MODES, (400, 500, 1000, 2000), strict=True)), "mode string, target int")
    return ranking.shortages(view(spark, sf, "samples").filter("status = 'accepted' AND mode IS NOT NULL").select("mode"), ["mode"], limits, "target")


@query("fn_tags_and_limits", oracle("""
SELECT sample_id, split_part(concat(stage, ':', coalesce(mode, '')), ':', 1) AS key, coalesce(mode, '') AS value, CASE mode WHEN 'pure_target' THEN 'context at most 10%, subject columns at least 80%' WHEN 'light_context' THEN 'context at most 25%, subject columns at least 60%' END AS limits FROM samples""", "samples"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    s = view(spark, sf, "samples").select(KEY, "mode", fn.tags_as_pairs(F.array(F.concat("stage", F.lit(":"), F.coalesce("mode", F.lit(""))))).alias("t"))
    return s.select(KEY, F.get("t", 0)["key"].alias("key"), F.get("t", 0)["value"].alias("value"), fn.limits_text(F.col("mode")).alias("limits"))


@query("fn_capacity_keys", """
SELECT s_suppkey, sha256(coalesce(CASE WHEN s_suppkey % 2 = 0 THEN s_name END, rtrim(concat('http://h/', s_suppkey, '//'), '/'))) AS capacity_key, CASE WHEN s_suppkey % 3 > 0 THEN concat('v1.', s_suppkey, '@sha256:', sha256(s_name)) END AS version FROM supplier""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    url = F.concat(F.lit("http://h/"), F.col("s_suppkey").cast("string"), F.lit("//"))
    version = F.concat(F.lit("v1."), F.col("s_suppkey").cast("string"))
    digest = F.when(F.col("s_suppkey") % 3 > 0, F.sha2("s_name", 256)).otherwise("bad")
    return table(spark, sf, "supplier").select("s_suppkey", fn.capacity_key(F.when(F.col("s_suppkey") % 2 == 0, F.col("s_name")), url).alias("capacity_key"), fn.version_record(version, digest).alias("version"))


@query("fn_fenced_sources", """
WITH c AS (SELECT conv_id, turn, CASE turn % 3 WHEN 0 THEN concat('```python', chr(10), text, chr(10), '```') WHEN 1 THEN text ELSE concat('```', chr(10), 'a', chr(10), '```', chr(10), '```', chr(10), 'b', chr(10), '```') END AS content FROM conversations WHERE text IS NOT NULL AND NOT contains(text, '`'))
SELECT conv_id, turn, CASE WHEN turn % 3 = 0 THEN sha256(substr(content, 11, length(content) - 14)) END AS source FROM c""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("turn") % 3
    content = F.when(k == 0, F.concat(F.lit("```python\n"), "text", F.lit("\n```"))).when(k == 1, F.col("text")).otherwise("```\na\n```\n```\nb\n```")
    rows = table(spark, sf, "conversations").filter("text IS NOT NULL AND NOT contains(text, '`')")
    return rows.select("conv_id", "turn", F.sha2(fn.fenced_source(content), 256).alias("source"))


@query("set_component_equality", oracle("""
, p AS (SELECT DISTINCT sample_id, component_id FROM voxels), d AS (SELECT DISTINCT sample_id, component_id FROM voxels WHERE NOT (component_id = 3 AND sample_id % 7 = 0) UNION SELECT DISTINCT sample_id, 9 FROM voxels WHERE sample_id % 11 = 0)
SELECT sample_id, component_id, 'left' AS side FROM (SELECT * FROM p EXCEPT SELECT * FROM d) UNION ALL SELECT sample_id, component_id, 'right' FROM (SELECT * FROM d EXCEPT SELECT * FROM p)""", "voxels"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    p = view(spark, sf, "voxels").select(KEY, "component_id").distinct()
    extra = p.select(KEY).distinct().filter("sample_id % 11 = 0").withColumn("component_id", F.lit(9).cast("long"))
    return rel.set_difference(p, p.filter("NOT (component_id = 3 AND sample_id % 7 = 0)").unionByName(extra))
