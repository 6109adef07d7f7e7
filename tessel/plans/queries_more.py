"""Further geometry, ledger, planning and function queries over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from tessel.functions import text as fn
from tessel.operators import aggregates as agg, geometry as geo, grids, ledger, quota as quotas, ranking
from tessel.plans.registry import query
from tessel.plans.tables import table
from tessel.plans.views import oracle, parts, view

KEY = "sample_id"


@query("geo_canonical_faults", oracle("""
, c AS (SELECT sample_id, x, y, z, count(*) AS n, count(*) FILTER (material = 3 AND y = 0) AS s FROM (SELECT sample_id, x, y, z, material FROM voxels UNION ALL SELECT sample_id, x, y, z, material FROM voxels WHERE z = 9 AND y = 5) GROUP BY sample_id, x, y, z),
f AS (SELECT sample_id, count(*) FILTER (n > 1) AS repeated_cell, sum(s) AS bad_state, greatest(0, sum(n) - 90) AS too_many_cells FROM c GROUP BY sample_id)
SELECT sample_id, rule, n::BIGINT AS n FROM (SELECT sample_id, 'repeated_cell' AS rule, repeated_cell AS n FROM f UNION ALL SELECT sample_id, 'bad_state', bad_state FROM f UNION ALL SELECT sample_id, 'too_many_cells', too_many_cells FROM f) WHERE n > 0""", "voxels"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    v = view(spark, sf, "voxels").select(KEY, "x", "y", "z", "material")
    twice = v.unionByName(v.filter("z = 9 AND y = 5"))
    return geo.canonical_faults(twice, KEY, F.when(~((F.col("material") == 3) & (F.col("y") == 0)), F.col("material")), 90)


@query("geo_palette", oracle("SELECT sample_id, material, (row_number() OVER (PARTITION BY sample_id ORDER BY material) - 1)::INT AS index FROM (SELECT DISTINCT sample_id, material FROM voxels)", "voxels"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return geo.palette(view(spark, sf, "voxels"), KEY, "material")


@query("geo_near_key", oracle("""
, q AS (SELECT DISTINCT sample_id, least(3, (x - min(x) OVER w) * 4 // (max(x) OVER w - min(x) OVER w + 1)) AS x, least(3, (y - min(y) OVER w) * 4 // (max(y) OVER w - min(y) OVER w + 1)) AS y, least(3, (z - min(z) OVER w) * 4 // (max(z) OVER w - min(z) OVER w + 1)) AS z FROM voxels WINDOW w AS (PARTITION BY sample_id)),
n AS (SELECT sample_id, x - min(x) OVER w AS x, y - min(y) OVER w AS y, z - min(z) OVER w AS z FROM q WINDOW w AS (PARTITION BY sample_id)),
h AS (SELECT sample_id, sha256(string_agg(concat(x, ',', y, ',', z), ';' ORDER BY x, y, z)) AS shape FROM n GROUP BY sample_id),
d AS (SELECT sample_id, count(*) AS n, list_sort([max(x) - min(x) + 1, max(y) - min(y) + 1, max(z) - min(z) + 1]) AS dims FROM voxels GROUP BY sample_id)
SELECT sample_id, sha256(concat(shape, '|', n, '|', array_to_string(dims, ','))) AS near_key FROM h JOIN d USING (sample_id)""", "voxels"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    v = view(spark, sf, "voxels")
    dims = v.groupBy(KEY).agg(F.count("*").alias("n_voxels"), *[(F.max(a) - F.min(a) + 1).alias(f"d{a}") for a in geo.AXES])
    return geo.near_key(geo.shape_hash(geo.quantised(v, KEY, 4), KEY, parts=parts(spark, sf, "voxels")).drop("n_voxels").join(dims, KEY), KEY, "shape")


@query("geo_duplicate_decision", """
WITH a AS (SELECT p_partkey, concat(p_name, '/', p_size) AS exact, CASE WHEN p_partkey % 3 = 0 THEN p_brand END AS lineage, concat(p_type, '/', p_size, '/', p_brand) AS upright, p_retailprice FROM part),
f AS (SELECT *, first_value(p_partkey) OVER (PARTITION BY exact ORDER BY p_retailprice, p_partkey) AS e, first_value(p_partkey) OVER (PARTITION BY lineage ORDER BY p_retailprice, p_partkey) AS l, first_value(p_partkey) OVER (PARTITION BY upright ORDER BY p_retailprice, p_partkey) AS u FROM a),
g AS (SELECT p_partkey, CASE WHEN e <> p_partkey THEN e END AS e, CASE WHEN lineage IS NOT NULL AND l <> p_partkey THEN l END AS l, CASE WHEN u <> p_partkey THEN u END AS u FROM f)
SELECT p_partkey, CASE WHEN e IS NOT NULL THEN 'exact' WHEN l IS NOT NULL THEN 'lineage' WHEN u IS NOT NULL THEN 'upright' END AS rule, coalesce(e, l, u) AS original FROM g""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part").select("p_partkey", "p_retailprice", F.concat_ws("/", "p_name", "p_size").alias("exact"), F.when(F.col("p_partkey") % 3 == 0, F.col("p_brand")).alias("lineage"), F.concat_ws("/", "p_type", "p_size", "p_brand").alias("upright"))
    return geo.duplicate_decision(p, "p_partkey", [F.col("p_retailprice"), F.col("p_partkey")], ["exact", "lineage", "upright"])


@query("geo_walk_regions", oracle("SELECT 1", "voxels").replace("WITH voxels", "WITH RECURSIVE voxels").replace("SELECT 1", """
, f AS (SELECT sample_id, x, y, z, sample_id * 16777216 + x * 65536 + y * 256 + z AS code, NOT EXISTS (SELECT 1 FROM voxels n WHERE n.sample_id = v.sample_id AND n.x = v.x AND n.z = v.z AND n.y = v.y + 3) AS tall
  FROM voxels v WHERE NOT EXISTS (SELECT 1 FROM voxels n WHERE n.sample_id = v.sample_id AND n.x = v.x AND n.z = v.z AND n.y BETWEEN v.y + 1 AND v.y + 2)),
e AS (SELECT a.code AS a, b.code AS b FROM f a JOIN f b ON a.sample_id = b.sample_id AND abs(a.x - b.x) + abs(a.z - b.z) = 1 AND (a.y = b.y OR (b.y = a.y + 1 AND a.tall) OR (b.y = a.y - 1 AND b.tall))),
r AS (SELECT code AS node, code AS label FROM f UNION SELECT e.b, r.label FROM r JOIN e ON r.node = e.a),
l AS (SELECT node, min(label) AS region FROM r GROUP BY node)
SELECT sample_id, region, count(*) AS n FROM f JOIN l ON f.code = l.node GROUP BY sample_id, region"""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return grids.walk_regions(view(spark, sf, "voxels"), KEY, parts(spark, sf, "voxels")).groupBy(KEY, "region").agg(F.count("*").alias("n"))


@query("geo_parent_faults", """
WITH RECURSIVE t AS (SELECT p_partkey AS n, CASE WHEN p_partkey % 5 = 0 THEN NULL WHEN p_partkey % 97 = 1 THEN -p_partkey ELSE (p_partkey * 3 + 1) % 150 END AS p FROM part),
r AS (SELECT n, p, 1 AS k FROM t UNION ALL SELECT r.n, t.p, r.k + 1 FROM r JOIN t ON r.p = t.n WHERE r.k < 128)
SELECT n AS p_partkey, 'parent_missing' AS rule FROM t WHERE p IS NOT NULL AND p NOT IN (SELECT n FROM t)
UNION ALL SELECT n, 'parent_cycle' FROM r WHERE k = 128 AND p IS NOT NULL""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("p_partkey")
    parts = table(spark, sf, "part").select("p_partkey", F.when(k % 5 == 0, F.lit(None)).when(k % 97 == 1, -k).otherwise((k * 3 + 1) % 150).alias("parent"))
    return geo.parent_faults(parts, "p_partkey", "parent")


@query("geo_contract_minima", oracle("""
, m AS (SELECT sample_id, count(*)::DOUBLE AS voxels, count(DISTINCT material)::DOUBLE AS materials, count(*) FILTER (component_id = 0) / count(*) AS roof_share FROM voxels GROUP BY sample_id)
SELECT sample_id, 'voxels' AS rule, voxels AS actual, 72.0::DOUBLE AS required FROM m WHERE voxels < 72 UNION ALL SELECT sample_id, 'materials', materials, 4.0 FROM m WHERE materials < 4 UNION ALL SELECT sample_id, 'roof_share', roof_share, 0.15 FROM m WHERE roof_share < 0.15::DOUBLE""", "voxels"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    m = view(spark, sf, "voxels").groupBy(KEY).agg(F.count("*").alias("voxels"), F.countDistinct("material").alias("materials"), agg.rate(agg.count_where(F.col("component_id") == 0), F.count("*")).alias("roof_share"))
    return geo.violations(m, KEY, {"voxels": 72, "materials": 4, "roof_share": 0.15})


@query("geo_top_surface", oracle("SELECT sample_id, component_id, x, z, max(y) AS top FROM voxels GROUP BY sample_id, component_id, x, z", "voxels"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "voxels").groupBy(KEY, "component_id", "x", "z").agg(F.max("y").alias("top"))


@query("geo_ordered_blocks", oracle("SELECT sample_id, string_agg(concat(x, ',', y, ',', z, ':', material), ';' ORDER BY x, y, z) AS blocks FROM voxels GROUP BY sample_id", "voxels"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    rows = F.sort_array(F.collect_list(F.struct("x", "y", "z", "material")))
    return view(spark, sf, "voxels").groupBy(KEY).agg(F.array_join(F.transform(rows, lambda b: F.concat(F.concat_ws(",", b["x"], b["y"], b["z"]), F.lit(":"), b["material"].cast("string"))), ";").alias("blocks"))


@query("agg_tokens_last_days", oracle("""
SELECT sample_id, attempt_no, part_id, count(*) OVER w AS requests, coalesce(sum(tokens) OVER w, 0)::BIGINT AS tokens FROM attempts WINDOW w AS (PARTITION BY pool, role ORDER BY started_at RANGE BETWEEN INTERVAL 2 DAY PRECEDING AND CURRENT ROW)""", "attempts"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    w = W.partitionBy("pool", "role").orderBy(F.unix_micros(F.col("started_at").cast("timestamp"))).rangeBetween(-172_800_000_000, 0)
    return view(spark, sf, "attempts").select(KEY, "attempt_no", "part_id", F.count("*").over(w).alias("requests"), F.coalesce(F.sum("tokens").over(w), F.lit(0)).alias("tokens"))


@query("ord_last_attempts", oracle("""
SELECT sample_id, attempt_no, part_id, nth FROM (SELECT sample_id, attempt_no, part_id, row_number() OVER (PARTITION BY sample_id ORDER BY started_at DESC, attempt_no DESC, part_id DESC)::INT AS nth FROM attempts) WHERE nth <= 2""", "attempts"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    w = W.partitionBy(KEY).orderBy(F.desc("started_at"), F.desc("attempt_no"), F.desc("part_id"))
    return view(spark, sf, "attempts").withColumn("nth", F.row_number().over(w)).filter("nth <= 2").select(KEY, "attempt_no", "part_id", "nth")


@query("ord_example_caps", oracle("SELECT campaign_id, reason, count(*) AS n, array_to_string(list_slice(list_sort(list(sample_id)), 1, 8), ',') AS examples FROM samples WHERE reason IS NOT NULL GROUP BY campaign_id, reason", "samples"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    ranked = view(spark, sf, "samples").filter("reason IS NOT NULL").withColumn("k", F.row_number().over(W.partitionBy("campaign_id", "reason").orderBy(KEY)))
    return ranked.groupBy("campaign_id", "reason").agg(F.count("*").alias("n"), F.array_join(F.sort_array(F.collect_list(F.when(F.col("k") <= 8, F.col(KEY)))), ",").alias("examples"))


@query("win_sequence_numbers", oracle("SELECT sample_id, campaign_id, (row_number() OVER w - 1)::INT AS sequence, ((row_number() OVER w - 1) % 3)::INT AS pick FROM samples WINDOW w AS (PARTITION BY campaign_id ORDER BY updated_at, sample_id)", "samples"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    n = F.row_number().over(W.partitionBy("campaign_id").orderBy("updated_at", KEY)) - 1
    return view(spark, sf, "samples").select(KEY, "campaign_id", n.alias("sequence"), (n % 3).alias("pick"))


@query("led_chunk_fold", """
SELECT conv_id, string_agg(coalesce(text, ''), '' ORDER BY turn) AS content, max(turn) FILTER (role = 'assistant') AS usage, CASE WHEN count(*) FILTER (role = 'user') > 0 THEN arg_max(role, turn) END AS finish FROM conversations GROUP BY conv_id""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    chunks = table(spark, sf, "conversations").withColumns({"used": F.when(F.col("role") == "assistant", F.col("turn")), "finish": F.col("role")})
    return ledger.chunk_fold(chunks, "conv_id", "turn", "text", "used", "finish")


@query("led_receipt_faults", oracle("""
, k AS (SELECT sample_id, CASE kind WHEN 'signup' THEN 'reserved' WHEN 'click' THEN 'dispatched' WHEN 'purchase' THEN 'settled' END AS kind FROM ledger),
n AS (SELECT sample_id, count(*) FILTER (kind = 'reserved') AS r, count(*) FILTER (kind = 'dispatched') AS d, count(*) FILTER (kind = 'settled') AS s FROM k GROUP BY sample_id)
SELECT sample_id, CASE WHEN d > 1 THEN 'dispatched_twice' WHEN s > 0 AND d = 0 THEN 'settled_undispatched' ELSE 'unreserved' END AS fault FROM n WHERE d > 1 OR (s > 0 AND d = 0) OR (d > 0 AND r = 0)""", "ledger"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.when(F.col("kind") == "signup", "reserved").when(F.col("kind") == "click", "dispatched").when(F.col("kind") == "purchase", "settled")
    return ledger.receipt_faults(view(spark, sf, "ledger").withColumn("kind", kind), KEY, "kind")


@query("led_stop_rules", oracle("""
, s AS (SELECT campaign_id, count(*) FILTER (status = 'accepted') AS accepted, count(*) FILTER (status = 'rejected') AS rejected, count(*) AS tasks FROM samples GROUP BY campaign_id)
SELECT c.campaign_id, accepted, CASE WHEN accepted >= target * 4 THEN 'target_reached' WHEN tasks > 1800 THEN 'budget' WHEN accepted = 0 AND rejected > 50 THEN 'zero_yield' END AS stop_reason FROM campaigns c LEFT JOIN s USING (campaign_id)""", "campaigns", "samples"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    s = agg.conditional_sums(view(spark, sf, "samples"), ["campaign_id"], accepted=F.col("status") == "accepted", rejected=F.col("status") == "rejected", tasks=F.lit(True))
    rules = [("target_reached", F.col("accepted") >= F.col("target") * 4), ("budget", F.col("tasks") > 1800), ("zero_yield", (F.col("accepted") == 0) & (F.col("rejected") > 50))]
    return ledger.stop_reason(view(spark, sf, "campaigns").join(s, "campaign_id", "left"), rules).select("campaign_id", "accepted", "stop_reason")


@query("led_expired", oracle("SELECT sample_id, attempt_no, part_id FROM attempts WHERE occupancy AND started_at <= TIMESTAMP '1997-03-01'", "attempts"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return ledger.expired(view(spark, sf, "attempts"), "started_at", F.lit("1997-03-01").cast("timestamp"), "occupancy").select(KEY, "attempt_no", "part_id")


@query("led_retry_budget", oracle("""
, u AS (SELECT event_id, sample_id, coalesce(sum(CASE WHEN kind = 'error' THEN 1 ELSE 0 END) OVER (PARTITION BY sample_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS used FROM ledger)
SELECT event_id, sample_id, used FROM u WHERE used < 3""", "ledger"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return ledger.budget_left(view(spark, sf, "ledger"), [KEY], ["ts", "event_id"], F.col("kind") == "error", 3).select("event_id", KEY, "used")


@query("pln_two_level", oracle("""
, w AS (SELECT scene_type, CASE scene_type WHEN 'natural' THEN 3 WHEN 'architecture' THEN 2 ELSE 1 END::DOUBLE AS weight FROM (SELECT DISTINCT scene_type FROM families)),
a AS (SELECT scene_type, 1000 * weight / sum(weight) OVER () AS q FROM w),
b AS (SELECT scene_type, floor(q) + CASE WHEN row_number() OVER (ORDER BY q - floor(q) DESC, scene_type) <= 1000 - sum(floor(q)) OVER () THEN 1 ELSE 0 END AS total FROM a),
c AS (SELECT scene_type, family_id, total, total * 1.0::DOUBLE / count(*) OVER (PARTITION BY scene_type) AS q FROM families JOIN b USING (scene_type))
SELECT scene_type, family_id, (floor(q) + CASE WHEN row_number() OVER (PARTITION BY scene_type ORDER BY q - floor(q) DESC, family_id) <= total - sum(floor(q)) OVER (PARTITION BY scene_type) THEN 1 ELSE 0 END)::BIGINT AS quota FROM c""", "families"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    f = view(spark, sf, "families")
    weight = F.when(F.col("scene_type") == "natural", 3).when(F.col("scene_type") == "architecture", 2).otherwise(1)
    scenes = f.select("scene_type").distinct().select(F.lit("all").alias("g"), "scene_type", weight.alias("weight"), F.lit(1000).alias("total"))
    totals = quotas.apportion(scenes, ["g"], "scene_type", "weight", "total").select("scene_type", F.col("quota").alias("total"))
    members = f.join(totals, "scene_type").withColumn("weight", F.lit(1))
    return quotas.apportion(members, ["scene_type"], "family_id", "weight", "total").withColumn("quota", F.col("quota").cast("long"))


@query("pln_next_task", oracle("""
, s AS (SELECT campaign_id, family_id, mode, count(*) FILTER (status = 'accepted') AS accepted, count(*) FILTER (status = 'running') AS active FROM samples WHERE mode IS NOT NULL GROUP BY campaign_id, family_id, mode),
f AS (SELECT campaign_id, family_id, sum(accepted) AS accepted, sum(active) AS active FROM s GROUP BY campaign_id, family_id),
p AS (SELECT campaign_id, arg_max(family_id, ROW((greatest(0, 60 - accepted) - active) / 60, -active, family_id)) AS family_id FROM f GROUP BY campaign_id)
SELECT p.campaign_id, p.family_id, arg_max(s.mode, ROW((greatest(0, 20 - s.accepted) - s.active) / 20, s.mode)) AS mode FROM p JOIN s ON s.campaign_id = p.campaign_id AND s.family_id = p.family_id GROUP BY p.campaign_id, p.family_id""", "samples"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    s = agg.conditional_sums(view(spark, sf, "samples").filter("mode IS NOT NULL"), ["campaign_id", "family_id", "mode"], accepted=F.col("status") == "accepted", active=F.col("status") == "running")
    f = s.groupBy("campaign_id", "family_id").agg(F.sum("accepted").alias("accepted"), F.sum("active").alias("active"))
    need = lambda most: ((F.greatest(F.lit(0), most - F.col("accepted")) - F.col("active")) / most).alias("need")
    chosen = ranking.best_by(f, ["campaign_id"], "family_id", [need(60), (-F.col("active")).alias("idle"), F.col("family_id")])
    return ranking.best_by(s.join(chosen, ["campaign_id", "family_id"]), ["campaign_id", "family_id"], "mode", [need(20), F.col("mode")])


@query("fn_execution_state", """
SELECT event_id, CASE WHEN event_type IN ('not_sent', 'execution_unknown', 'terminated') THEN event_type WHEN event_type = 'purchase' THEN 'terminated' WHEN event_id % 3 = 0 THEN 'not_sent' ELSE 'execution_unknown' END AS state FROM events""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    category = F.when(F.col("event_id") % 3 == 0, "request").otherwise("server")
    return table(spark, sf, "events").select("event_id", fn.execution_state(F.col("event_type"), category, F.col("event_type") == "purchase").alias("state"))


@query("fn_instruction", """
SELECT p_partkey, CASE WHEN array_to_string(list_filter([p_name, CASE WHEN p_size > 25 THEN ' ' ELSE p_type END, CASE WHEN p_partkey % 2 = 0 THEN NULL ELSE p_brand END], lambda x: coalesce(trim(x), '') <> ''), '。') <> '' THEN array_to_string(list_filter([p_name, CASE WHEN p_size > 25 THEN ' ' ELSE p_type END, CASE WHEN p_partkey % 2 = 0 THEN NULL ELSE p_brand END], lambda x: coalesce(trim(x), '') <> ''), '。') ELSE 'none' END AS instruction FROM part""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    parts = [F.col("p_name"), F.when(F.col("p_size") > 25, " ").otherwise(F.col("p_type")), F.when(F.col("p_partkey") % 2 != 0, F.col("p_brand"))]
    return table(spark, sf, "part").select("p_partkey", fn.instruction(parts, F.lit("none")).alias("instruction"))


@query("fn_legal_modes", oracle("SELECT sample_id, mode IS NULL OR (mode IN ('pure_target', 'light_context', 'contextual', 'environment_rich') AND scene_type <> 'natural' AND (scene_type <> 'hybrid' OR mode IN ('contextual', 'environment_rich'))) AS legal FROM samples", "samples"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "samples").select(KEY, fn.legal_mode(F.col("scene_type"), F.col("mode")).alias("legal"))


@query("fn_qualified_profiles", oracle("""
, p AS (SELECT endpoint_id, count(*) AS reviewed, count(*) FILTER (status <> 'running') AS passed FROM attempts GROUP BY endpoint_id)
SELECT endpoint_id, coalesce(reviewed >= 100 AND passed / reviewed >= 0.7::DOUBLE AND endpoint_id % 4 <> 0, FALSE) AS qualified FROM p""", "attempts"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    p = view(spark, sf, "attempts").groupBy("endpoint_id").agg(F.count("*").alias("reviewed"), agg.count_where(F.col("status") != "running").alias("passed"))
    return p.select("endpoint_id", fn.qualified(F.col("reviewed"), F.col("passed"), F.when(F.col("endpoint_id") % 4 != 0, "h"), F.lit("h"), share=0.7).alias("qualified"))


@query("fn_rebased_paths", """
SELECT page_id, CASE WHEN url = 'http:' THEN '/root' WHEN starts_with(url, 'http:/') THEN concat('/root', substring(url, 6)) ELSE url END AS path FROM pages""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", fn.rebased(F.col("url"), "http:/", "/root/").alias("path"))


@query("fn_review_verdicts", """
WITH r AS (SELECT event_id, CASE event_type WHEN 'view' THEN 'pass' WHEN 'click' THEN 'fail' WHEN 'error' THEN 'gray' ELSE 'unsure' END AS v, event_id % 3 AS n FROM events)
SELECT event_id, CASE WHEN v = 'unsure' OR (v = 'fail' AND n = 0) THEN NULL WHEN v = 'pass' AND n > 0 THEN 'gray' ELSE v END AS verdict, n::INT AS n_issues, CASE WHEN v = 'unsure' THEN 'verdict' WHEN v = 'fail' AND n = 0 THEN 'fail_without_issue' END AS fault FROM r""")
def _(spark: SparkSession, sf: str) -> DataFrame:
    v = F.when(F.col("event_type") == "view", "pass").when(F.col("event_type") == "click", "fail").when(F.col("event_type") == "error", "gray").otherwise("unsure")
    issues = F.array_repeat(F.lit("seen"), (F.col("event_id") % 3).cast("int"))
    body = F.to_json(F.struct(v.alias("verdict"), issues.alias("issues")))
    return table(spark, sf, "events").select("event_id", fn.review_verdict(body).alias("r")).select("event_id", "r.*")
