"""Voxel geometry over the views of the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tessel.operators import geometry as geo, grids
from tessel.operators.binary_hashes import binary_hashes
from tessel.plans.registry import query
from tessel.plans.views import oracle, parts, view

KEY = "sample_id"


def _texts(rotations: list) -> str:
    """SQL for the texts of a sample's cells under the rotations, one row each."""
    parts = []
    for i, rotation in enumerate(rotations):
        moved = ", ".join(f"{s} * {geo.AXES[a]} AS {n}" for n, (a, s) in zip(geo.AXES, rotation, strict=True))
        parts.append(f"SELECT {i} AS r, sample_id, {moved} FROM voxels")
    return f"""
, t AS ({' UNION ALL '.join(parts)}),
n AS (SELECT r, sample_id, x - min(x) OVER w AS x, y - min(y) OVER w AS y, z - min(z) OVER w AS z FROM t WINDOW w AS (PARTITION BY r, sample_id)),
c AS (SELECT r, sample_id, count(*) AS n, string_agg(concat(x, ',', y, ',', z), ';' ORDER BY x, y, z) AS s FROM n GROUP BY r, sample_id)
SELECT sample_id, max(n)::INT AS n_voxels, sha256(min(s)) AS shape FROM c GROUP BY sample_id"""


@query("geo_translation_hash", oracle(_texts([((0, 1), (1, 1), (2, 1))]), "voxels"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return geo.shape_hash(view(spark, sf, "voxels"), KEY, parts=parts(spark, sf, "voxels"))


@query("geo_upright_hash", oracle(_texts(geo.UPRIGHT), "voxels"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return geo.shape_hash(view(spark, sf, "voxels"), KEY, geo.UPRIGHT, parts(spark, sf, "voxels"))


@query("geo_cube_hash", oracle(_texts(geo.CUBE), "voxels"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return geo.shape_hash(view(spark, sf, "voxels"), KEY, geo.CUBE, parts(spark, sf, "voxels"))


@query("geo_quantised_cells", oracle("""
SELECT sample_id, x, y, z, count(*) AS n FROM (SELECT DISTINCT sample_id,
  least(3, (x - min(x) OVER w) * 4 // (max(x) OVER w - min(x) OVER w + 1)) AS x, least(3, (y - min(y) OVER w) * 4 // (max(y) OVER w - min(y) OVER w + 1)) AS y,
  least(3, (z - min(z) OVER w) * 4 // (max(z) OVER w - min(z) OVER w + 1)) AS z FROM voxels WINDOW w AS (PARTITION BY sample_id)) GROUP BY sample_id, x, y, z""", "voxels"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return geo.quantised(view(spark, sf, "voxels"), KEY, 4).groupBy(KEY, *geo.AXES).agg(F.count("*").alias("n"))


@query("geo_component_measures", oracle("""
, m AS (SELECT sample_id, component_id, material, count(*) AS n, min(x) AS x0, min(y) AS y0, min(z) AS z0, max(x) AS x1, max(y) AS y1, max(z) AS z1 FROM voxels GROUP BY sample_id, component_id, material)
SELECT sample_id, component_id, sum(n)::BIGINT AS n_voxels, min(x0) AS x0, min(y0) AS y0, min(z0) AS z0, max(x1) AS x1, max(y1) AS y1, max(z1) AS z1, string_agg(concat(material, ':', n), ',' ORDER BY material) AS materials
FROM m GROUP BY sample_id, component_id""", "voxels"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return geo.components_measured(view(spark, sf, "voxels"), [KEY, "component_id"], "material")


@query("geo_composition", oracle("""
, k AS (SELECT *, CASE WHEN component_id < 2 THEN 'structure' WHEN component_id < 4 THEN 'attached' WHEN component_id < 6 THEN 'environment' ELSE 'unknown' END AS kind FROM voxels),
b AS (SELECT *, min(CASE WHEN kind = 'structure' THEN x END) OVER w AS x0, max(CASE WHEN kind = 'structure' THEN x END) OVER w AS x1, min(CASE WHEN kind = 'structure' THEN z END) OVER w AS z0, max(CASE WHEN kind = 'structure' THEN z END) OVER w AS z1 FROM k WINDOW w AS (PARTITION BY sample_id)),
p AS (SELECT sample_id, x, z, kind, CASE WHEN kind = 'environment' THEN 'environment' WHEN kind = 'structure' OR (kind = 'attached' AND coalesce(x BETWEEN x0 - 2 AND x1 + 2 AND z BETWEEN z0 - 2 AND z1 + 2, FALSE)) THEN 'subject' ELSE 'unclassified' END AS part FROM b),
s AS (SELECT sample_id, count(*) FILTER (part = 'subject') AS subject, count(*) FILTER (part = 'environment') AS environment, count(*) FILTER (part = 'unclassified') AS unclassified,
  count(DISTINCT x * 1000 + z) AS scene_columns, count(DISTINCT CASE WHEN part = 'subject' THEN x * 1000 + z END) AS subject_columns, count(*) FILTER (kind = 'structure') = 0 AS subject_missing FROM p GROUP BY sample_id)
SELECT *, (environment + unclassified) / (subject + environment + unclassified) AS context_fraction, subject_columns / scene_columns AS footprint_fraction,
  (environment + unclassified) / (subject + environment + unclassified) > 0.4::DOUBLE AS context_violation, subject_columns / scene_columns < 0.6::DOUBLE AS extent_violation FROM s""", "voxels"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col("component_id")
    kind = F.when(c < 2, "structure").when(c < 4, "attached").when(c < 6, "environment").otherwise("unknown")
    return geo.composition(view(spark, sf, "voxels"), KEY, kind, 0.4, 0.6)


@query("geo_neighbour_counts", oracle("""
SELECT v.sample_id, v.x, v.y, v.z, count(n.x) AS touching FROM voxels v LEFT JOIN voxels n ON v.sample_id = n.sample_id AND abs(v.x - n.x) + abs(v.y - n.y) + abs(v.z - n.z) = 1 GROUP BY v.sample_id, v.x, v.y, v.z""", "voxels"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return geo.neighbours(view(spark, sf, "voxels"), KEY, [(1, 0, 0), (-1, 0, 0), (0, 1, 0), (0, -1, 0), (0, 0, 1), (0, 0, -1)], "touching")


@query("geo_visible_faces", oracle("""
, f AS (SELECT v.*, 'x' AS face FROM voxels v WHERE NOT EXISTS (SELECT 1 FROM voxels n WHERE n.sample_id = v.sample_id AND n.x = v.x + 1 AND n.y = v.y AND n.z = v.z)
  UNION ALL SELECT v.*, 'z' FROM voxels v WHERE NOT EXISTS (SELECT 1 FROM voxels n WHERE n.sample_id = v.sample_id AND n.x = v.x AND n.y = v.y AND n.z = v.z + 1)
  UNION ALL SELECT v.*, 'y' FROM voxels v WHERE NOT EXISTS (SELECT 1 FROM voxels n WHERE n.sample_id = v.sample_id AND n.x = v.x AND n.y = v.y + 1 AND n.z = v.z))
SELECT sample_id, x, y, z, face, x - z AS u, x + z - 2 * y AS v, x + y + z AS depth FROM f""", "voxels"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return geo.visible_faces(view(spark, sf, "voxels"), KEY)


@query("geo_walkable", oracle("""
SELECT sample_id, x, y, z FROM voxels v WHERE y < 253 AND NOT EXISTS (SELECT 1 FROM voxels n WHERE n.sample_id = v.sample_id AND n.x = v.x AND n.z = v.z AND n.y BETWEEN v.y + 1 AND v.y + 2)""", "voxels"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return geo.walkable(view(spark, sf, "voxels"), KEY)


#: SQL for the bodies of all cells: l (node, body) and s (sample_id, body, n, main).
BODIES = """
, c AS (SELECT sample_id, x, y, z, component_id, sample_id * 16777216 + x * 65536 + y * 256 + z AS code FROM voxels),
e AS (SELECT a.code AS a, b.code AS b FROM c a JOIN c b ON a.sample_id = b.sample_id AND abs(a.x - b.x) <= 1 AND abs(a.y - b.y) <= 1 AND abs(a.z - b.z) <= 1),
r AS (SELECT code AS node, code AS label FROM c UNION SELECT e.b, min(r.label) FROM r JOIN e ON r.node = e.a GROUP BY e.b),
l AS (SELECT node, min(label) AS body FROM r GROUP BY node),
s AS (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY n DESC, body) = 1 AS main FROM (SELECT sample_id, body, count(*) AS n FROM c JOIN l ON c.code = l.node GROUP BY sample_id, body))"""


def _recursive(body: str) -> str:
    return oracle(body, "voxels").replace("WITH voxels", "WITH RECURSIVE voxels", 1)


@query("geo_bodies", _recursive(BODIES + " SELECT sample_id, body, n, main FROM s"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return grids.body_sizes(view(spark, sf, "voxels"), KEY, parts(spark, sf, "voxels"))


@query("geo_detached_groups", _recursive(BODIES + """
, b AS (SELECT c.sample_id, s.body, s.n, s.main, c.code, c.x, c.y, c.z, c.component_id FROM c JOIN l ON c.code = l.node JOIN s ON l.body = s.body),
g AS (SELECT sample_id, body, max(n) AS n, min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1, min(z) AS z0, max(z) AS z1, string_agg(DISTINCT component_id::VARCHAR, ',' ORDER BY component_id::VARCHAR) AS owners FROM b WHERE NOT main GROUP BY sample_id, body),
p AS (SELECT a.body, a.x, a.y, a.z, m.x AS mx, m.y AS my, m.z AS mz, (a.x - m.x) * (a.x - m.x) + (a.y - m.y) * (a.y - m.y) + (a.z - m.z) * (a.z - m.z) AS gap,
  row_number() OVER (PARTITION BY a.body ORDER BY (a.x - m.x) * (a.x - m.x) + (a.y - m.y) * (a.y - m.y) + (a.z - m.z) * (a.z - m.z), a.code, m.code) AS k FROM b a JOIN b m ON a.sample_id = m.sample_id AND m.main AND NOT a.main)
SELECT g.*, gap::BIGINT AS gap, x, y, z, mx, my, mz FROM g JOIN p ON g.body = p.body AND k = 1"""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return grids.detached_groups(view(spark, sf, "voxels"), KEY, "component_id", parts(spark, sf, "voxels")).withColumn("owners", F.array_join(F.col("owners").cast("array<string>"), ","))


@query("geo_footprint_groups", oracle("SELECT 1", "voxels").replace("WITH voxels", "WITH RECURSIVE voxels").replace("SELECT 1", """
, c AS (SELECT DISTINCT sample_id, x, z, sample_id * 16777216 + x * 65536 + z * 256 AS code FROM voxels WHERE component_id = 5),
e AS (SELECT a.code AS a, b.code AS b FROM c a JOIN c b ON a.sample_id = b.sample_id AND abs(a.x - b.x) <= 1 AND abs(a.z - b.z) <= 1),
r AS (SELECT code AS node, code AS label FROM c UNION SELECT e.b, r.label FROM r JOIN e ON r.node = e.a),
l AS (SELECT node, min(label) AS body FROM r GROUP BY node)
SELECT sample_id, count(DISTINCT body) AS n_groups FROM c JOIN l ON c.code = l.node GROUP BY sample_id HAVING count(DISTINCT body) > 1"""))
def _(spark: SparkSession, sf: str) -> DataFrame:
    labelled = geo.bodies(view(spark, sf, "voxels").filter("component_id = 5"), KEY, axes=("x", "z"))
    return labelled.groupBy(KEY).agg(F.countDistinct("body").alias("n_groups")).filter("n_groups > 1")


@query("drw_strokes_to_voxels", oracle("""
, a AS (SELECT sample_id, seq, material, y0, y1, z0, z1, unnest(range(x0, x1 + 1)) AS x FROM strokes),
b AS (SELECT sample_id, seq, material, z0, z1, x, unnest(range(y0, y1 + 1)) AS y FROM a),
c AS (SELECT sample_id, seq, material, x, y, unnest(range(z0, z1 + 1)) AS z FROM b)
SELECT sample_id, x, y, z, material FROM (SELECT sample_id, x, y, z, material, row_number() OVER (PARTITION BY sample_id, x, y, z ORDER BY seq DESC) AS n FROM c) WHERE n = 1 AND material IS NOT NULL""", "strokes"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return geo.strokes_to_voxels(view(spark, sf, "strokes"), KEY, "seq", "material")


@query("geo_window_backing", oracle("""
, o AS (SELECT sample_id, x, y, z FROM voxels WHERE material = 2),
h AS (SELECT o.sample_id, o.x, o.y, o.z, s.side, v.z AS vz, v.material, abs(v.z - o.z) AS step, row_number() OVER (PARTITION BY o.sample_id, o.x, o.y, o.z, s.side ORDER BY abs(v.z - o.z)) AS n
  FROM o, (VALUES (1), (-1)) s(side), voxels v WHERE v.sample_id = o.sample_id AND v.x = o.x AND v.y = o.y AND (v.z - o.z) * s.side BETWEEN 1 AND 4)
SELECT sample_id, x, y, z, side, step, material <> 2 AS blocks FROM h WHERE n = 1""", "voxels"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    v = view(spark, sf, "voxels")
    return geo.window_rays(v.filter("material = 2"), v, KEY, 4, F.col("material") != 2)


@query("geo_room_checks", oracle("""
, i AS (SELECT r.sample_id, r.room_id, count(v.x) AS n FROM rooms r LEFT JOIN voxels v ON v.sample_id = r.sample_id AND x BETWEEN x0 AND x1 AND y BETWEEN y0 AND y1 AND z BETWEEN z0 AND z1 GROUP BY r.sample_id, r.room_id),
f AS (SELECT r.sample_id, r.room_id, count(v.x) AS n FROM rooms r LEFT JOIN voxels v ON v.sample_id = r.sample_id AND x BETWEEN x0 AND x1 AND y = y0 - 1 AND z BETWEEN z0 AND z1 GROUP BY r.sample_id, r.room_id)
SELECT r.sample_id, r.room_id, i.n AS n_inside, f.n AS n_floor, 1 - i.n / ((x1 - x0 + 1) * (y1 - y0 + 1) * (z1 - z0 + 1)) >= 0.85::DOUBLE AS air_ok, f.n / ((x1 - x0 + 1) * (z1 - z0 + 1)) >= 0.6::DOUBLE AS floor_ok
FROM rooms r JOIN i USING (sample_id, room_id) JOIN f USING (sample_id, room_id)""", "rooms", "voxels"))
def _(spark: SparkSession, sf: str) -> DataFrame:
    return geo.room_checks(view(spark, sf, "rooms"), view(spark, sf, "voxels"), KEY, "room_id", parts=parts(spark, sf, "voxels"))


@query("geo_binary_hashes")
def _(spark: SparkSession, sf: str) -> DataFrame:
    return binary_hashes(view(spark, sf, "voxels"), KEY, "material", "voxels.v1", "occupancy.v1", "occupancy.rotation.v1", parts(spark, sf, "voxels"))
