"""Sparse voxel geometry: a voxel is a row (sample, x, y, z, ...), and a missing row is air.

All operators group and join by sample, so that one partitioning by sample serves a whole chain of them.
"""

from __future__ import annotations

import functools
import hashlib
from itertools import permutations, product

import numpy as np
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tessel.operators.graph import connected_components
from tessel.operators.grids import Tables, by_sample, cells_in_boxes, least_turns
from tessel.plans.stages import written

AXES = ("x", "y", "z")


def _signed(order: tuple[int, ...], signs: tuple[int, ...]) -> int:
    inversions = sum(order[i] > order[j] for i in range(3) for j in range(i + 1, 3))
    return (-1) ** inversions * signs[0] * signs[1] * signs[2]


#: Proper rotations of the cube as (source axis, sign) for each target axis; the upright ones leave y as it is.
CUBE = [tuple(zip(o, s, strict=True)) for o in permutations(range(3)) for s in product((-1, 1), repeat=3) if _signed(o, s) == 1]
UPRIGHT = [r for r in CUBE if r[1] == (1, 1)]


def normalised(voxels: DataFrame, key: list[str]) -> DataFrame:
    """Coordinates moved so that each group's least are 0."""
    w = W.partitionBy(*key)
    return voxels.withColumns({a: F.col(a) - F.min(a).over(w) for a in AXES})


@functools.cache
def _text_ranks(width: int) -> tuple[np.ndarray, ...]:
    """Ranks of the numbers below ``width`` as texts, by what follows them: x, y, z, and z of the last cell."""
    rank = lambda end: np.argsort(sorted(range(width), key=lambda v: f"{v}{end}"))
    return rank(","), rank(","), rank(";"), rank("")


def shape_hash(voxels: DataFrame, key: str, rotations: list | None = None, parts: int | None = None) -> DataFrame:
    """One hash of the occupied cells per sample, the same after a shift, or after any of the rotations too.

    The hash is of a text of the sorted cells; under rotations, of the least such text. Texts are compared by the ranks of their
    numbers, and only the least is written out. Rows without a sample or a coordinate are no cells.
    """
    turns = rotations or [((0, 1), (1, 1), (2, 1))]

    def work(t: Tables) -> dict[str, np.ndarray]:
        t = t["v"]
        order = np.lexsort((t["z"], t["y"], t["x"], t["key"]))
        rows = np.stack([t[c][order] for c in ("key", *AXES)])
        rows = rows[:, np.append(True, (np.diff(rows) != 0).any(axis=0))]
        (x, y, z), start = least_turns(rows[0], rows[1:], turns, _text_ranks)
        texts = [f"{a},{b},{c}" for a, b, c in zip(x.tolist(), y.tolist(), z.tolist(), strict=True)]
        ends = np.append(start[1:], len(texts))
        shapes = [hashlib.sha256(";".join(texts[i:j]).encode()).hexdigest() for i, j in zip(start.tolist(), ends.tolist(), strict=True)]
        return {"key": rows[0][start], "n_voxels": ends - start, "shape": shapes}

    cells = voxels.select(key, *AXES).dropna(subset=list(AXES))
    return by_sample(key, {"v": cells}, work, f"key {dict(voxels.dtypes)[key]}, n_voxels int, shape string", parts).withColumnRenamed("key", key)


def quantised(voxels: DataFrame, key: str, bins: int = 16) -> DataFrame:
    """Distinct cells of a coarse grid laid over each sample's extent."""
    if not 2 <= bins <= 64:
        raise ValueError("bins must lie in 2..64")
    w = W.partitionBy(key)
    low, high = {a: F.min(a).over(w) for a in AXES}, {a: F.max(a).over(w) for a in AXES}
    cell = {a: F.least(F.lit(bins - 1), F.floor((F.col(a) - low[a]) * bins / (high[a] - low[a] + 1))) for a in AXES}
    return voxels.withColumns(cell).select(key, *AXES).distinct()


def components_measured(voxels: DataFrame, keys: list[str], material: str) -> DataFrame:
    """Per component: voxels, bounding box, materials in order, and their counts as text."""
    by_material = voxels.groupBy(*keys, material).agg(F.count("*").alias("n"), *[F.min(a).alias(f"{a}0") for a in AXES], *[F.max(a).alias(f"{a}1") for a in AXES])
    return by_material.groupBy(*keys).agg(
        F.sum("n").alias("n_voxels"), *[F.min(f"{a}0").alias(f"{a}0") for a in AXES], *[F.max(f"{a}1").alias(f"{a}1") for a in AXES],
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(material, "n"))), lambda s: F.concat_ws(":", s[material], s["n"])), ",").alias("materials"),
    )


#: Fixed value: how far attached parts may lie outside the structure's extent, along x and z.
MARGIN = 2


def composition(voxels: DataFrame, key: str, kind: Column, max_context: float, min_footprint: float) -> DataFrame:
    """Subject and context of each sample, in voxels and in columns of its footprint.

    ``kind`` says structure, attached or environment, anything else being unclassified. Attached voxels belong to the
    subject only near the structure's extent along x and z; height does not matter.
    """
    w = W.partitionBy(key)
    v = voxels.withColumn("__k", kind)
    core = lambda c: F.when(F.col("__k") == "structure", F.col(c))
    near = F.lit(True)
    for a in ("x", "z"):
        near &= F.coalesce((F.col(a) >= F.min(core(a)).over(w) - MARGIN) & (F.col(a) <= F.max(core(a)).over(w) + MARGIN), F.lit(False))
    part = F.when(F.col("__k") == "environment", "environment").when((F.col("__k") == "structure") | ((F.col("__k") == "attached") & near), "subject").otherwise("unclassified")
    v = v.withColumn("__p", part).withColumn("__s", F.col("__k") == "structure")
    columns = v.groupBy(key, "x", "z").agg(
        *[F.count(F.when(F.col("__p") == p, 1)).alias(p) for p in ("subject", "environment", "unclassified")], F.count(F.when(F.col("__s"), 1)).alias("__core"))
    out = columns.groupBy(key).agg(
        *[F.sum(p).alias(p) for p in ("subject", "environment", "unclassified")], F.sum("__core").alias("__core"),
        F.count("*").alias("scene_columns"), F.count(F.when(F.col("subject") > 0, 1)).alias("subject_columns"))
    context = (F.col("environment") + F.col("unclassified")) / (F.col("subject") + F.col("environment") + F.col("unclassified"))
    footprint = F.col("subject_columns") / F.col("scene_columns")
    return out.withColumns({
        "context_fraction": context, "footprint_fraction": footprint, "subject_missing": F.col("__core") == 0,
        "context_violation": context > max_context, "extent_violation": footprint < min_footprint,
    }).drop("__core")


def neighbours(voxels: DataFrame, key: str, offsets: list[tuple[int, int, int]], name: str) -> DataFrame:
    """Each voxel with the number of occupied cells among its neighbours at ``offsets``."""
    pushed = _pushed(voxels.select(key, *AXES).distinct(), key, [((0, 0, 0), -1), *[(o, 1) for o in offsets]])
    met = pushed.groupBy(key, *AXES).agg(F.count(F.when(F.col("mark") < 0, 1)).alias("own"), F.count(F.when(F.col("mark") > 0, 1)).alias(name))
    return met.filter("own > 0").drop("own")


def _pushed(cells: DataFrame, key: str, steps: list[tuple[tuple[int, int, int], int]]) -> DataFrame:
    """The cells moved by each step, with its mark, so that cells and neighbours meet in one grouping.

    The step that comes first stays; elsewhere a missing sample or coordinate meets nothing.
    """
    listed = F.explode(F.array(*[F.struct(*[F.lit(d).alias(f"d{a}") for a, d in zip(AXES, o, strict=True)], F.lit(mark).alias("mark")) for o, mark in steps])).alias("o")
    given = F.col(key).isNotNull()
    for a in AXES:
        given &= F.col(a).isNotNull()
    moved = cells.select(key, *AXES, listed).filter(given | (F.col("o.mark") == steps[0][1]))
    return moved.select(key, *[(F.col(a) + F.col(f"o.d{a}")).alias(a) for a in AXES], F.col("o.mark").alias("mark"))


def visible_faces(voxels: DataFrame, key: str) -> DataFrame:
    """Faces towards +x, +z and +y whose neighbour is air, with their place in an isometric view and their depth."""
    pushed = _pushed(voxels, key, [((0, 0, 0), 1), ((-1, 0, 0), 2), ((0, 0, -1), 4), ((0, -1, 0), 8)])
    met = pushed.groupBy(key, *AXES).agg(F.bit_or("mark").alias("m")).filter("m & 1 > 0")
    open_ = F.array_compact(F.array(*[F.when(F.col("m").bitwiseAND(mark) == 0, face) for face, mark in (("x", 2), ("z", 4), ("y", 8))]))
    all_ = met.select(key, *AXES, F.explode(open_).alias("face"))
    return all_.withColumns({"u": F.col("x") - F.col("z"), "v": F.col("x") + F.col("z") - 2 * F.col("y"), "depth": F.col("x") + F.col("y") + F.col("z")})


def walkable(voxels: DataFrame, key: str, height: int = 253) -> DataFrame:
    """Cells on which one can stand: solid, with two cells of air above."""
    pushed = _pushed(voxels, key, [((0, 0, 0), 1), ((0, -1, 0), 2), ((0, -2, 0), 4)])
    return pushed.groupBy(key, *AXES).agg(F.bit_or("mark").alias("m")).filter((F.col("m") == 1) & (F.col("y") < height)).drop("m")


def bodies(voxels: DataFrame, key: str, reach: int = 1, axes: tuple[str, ...] = AXES) -> DataFrame:
    """Connected bodies (neighbours up to ``reach`` apart along every axis): key, cell, body (its least cell code).

    Half of the offsets give every edge once. Cells are coded as one number per sample, coordinates lying in 0..255.
    """
    code = F.col(key) * (1 << 24)
    for i, a in enumerate(axes):
        code += F.col(a) * (1 << (8 * (2 - i)))
    cells = voxels.select(key, *axes).distinct()
    offsets = [o for o in product(range(-reach, reach + 1), repeat=len(axes)) if o > (0,) * len(axes)]
    steps = F.explode(F.array(*[F.struct(*[F.lit(d).alias(f"d{a}") for a, d in zip(axes, o, strict=True)]) for o in offsets])).alias("o")
    moved = cells.withColumn("a", code).select(key, "a", *axes, steps).select(key, "a", *[(F.col(c) + F.col(f"o.d{c}")).alias(c) for c in axes])
    coded = written(cells.withColumn("b", code), "cells")
    edges = moved.join(coded, [key, *axes]).select("a", "b")
    labels = connected_components(edges.union(coded.select(F.col("b").alias("a"), "b")), "a", "b")
    return coded.join(labels, coded.b == labels.node).select(key, *axes, F.col("component").alias("body"))


def body_sizes(labelled: DataFrame, key: str) -> DataFrame:
    """Bodies of each sample, the largest being the main one (the least code among equals)."""
    sizes = labelled.groupBy(key, "body").agg(F.count("*").alias("n"))
    return sizes.withColumn("main", F.row_number().over(W.partitionBy(key).orderBy(F.desc("n"), "body")) == 1)


def strokes_to_voxels(strokes: DataFrame, key: str, seq: str, material: str) -> DataFrame:
    """Cells after all box strokes in order: the last stroke on a cell wins, and one without material erases it."""
    cells = strokes
    for a in AXES:
        cells = cells.withColumn(a, F.explode(F.sequence(F.col(f"{a}0"), F.col(f"{a}1"))))
    last = cells.groupBy(key, *AXES).agg(F.max_by(material, seq).alias(material))
    return last.filter(F.col(material).isNotNull())


def window_rays(openings: DataFrame, voxels: DataFrame, key: str, steps: int, blocking: Column) -> DataFrame:
    """First occupied cell along +z and -z of each opening, up to ``steps`` away, and whether it blocks."""
    rays = openings.select(key, *AXES, F.explode(F.array(F.lit(1), F.lit(-1))).alias("side")).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(steps))))
    rays = rays.withColumn("__z", F.col("z") + F.col("side") * F.col("step"))
    seen = voxels.select(F.col(key), F.col("x"), F.col("y"), F.col("z").alias("__z"), blocking.alias("__b"))
    hits = rays.join(seen, [key, "x", "y", "__z"]).groupBy(key, *AXES, "side").agg(F.min(F.struct("step", "__b")).alias("h"))
    return hits.select(key, *AXES, "side", F.col("h.step").alias("step"), F.col("h.__b").alias("blocks"))


def opening_clear(boxes: DataFrame, voxels: DataFrame, key: str, box_id: str, parts: int | None = None) -> DataFrame:
    """Occupied cells inside each box, by tables of sums: no cell meets a box."""
    return cells_in_boxes(voxels, boxes, key, box_id, parts)


def room_checks(boxes: DataFrame, voxels: DataFrame, key: str, box_id: str, least_air: float = 0.85, least_floor: float = 0.6, parts: int | None = None) -> DataFrame:
    """Air share of each room and the covered share of the layer below it, against their least values."""
    size = lambda a: F.col(f"{a}1") - F.col(f"{a}0") + 1
    air = opening_clear(boxes, voxels, key, box_id, parts)
    floors = boxes.withColumns({"y0": F.col("y0") - 1, "y1": F.col("y0") - 1})
    cover = opening_clear(floors, voxels, key, box_id, parts).withColumnRenamed("n_inside", "n_floor")
    out = boxes.join(air, [key, box_id]).join(cover, [key, box_id])
    out = out.withColumns({"air_share": 1 - F.col("n_inside") / (size("x") * size("y") * size("z")), "floor_share": F.col("n_floor") / (size("x") * size("z"))})
    return out.select(key, box_id, "n_inside", "n_floor", (F.col("air_share") >= least_air).alias("air_ok"), (F.col("floor_share") >= least_floor).alias("floor_ok"))


def canonical_faults(voxels: DataFrame, key: str, state: Column, most: int = 600_000) -> DataFrame:
    """Findings (key, rule, n) of samples that cannot be canonicalised: bounds, repeated cells, bad states, too many cells."""
    outside = F.lit(False)
    for a in AXES:
        outside |= (F.col(a) < 0) | (F.col(a) > 255) | F.col(a).isNull()
    per_cell = voxels.withColumns({"__o": outside, "__s": state.isNull()}).groupBy(key, *AXES).agg(F.count("*").alias("n"), F.count(F.when(F.col("__o"), 1)).alias("o"), F.count(F.when(F.col("__s"), 1)).alias("s"))
    sums = per_cell.groupBy(key).agg(F.sum("o").alias("out_of_bounds"), F.count(F.when(F.col("n") > 1, 1)).alias("repeated_cell"), F.sum("s").alias("bad_state"), F.greatest(F.lit(0), F.sum("n") - most).alias("too_many_cells"))
    rules = ["out_of_bounds", "repeated_cell", "bad_state", "too_many_cells"]
    return sums.unpivot([key], rules, "rule", "n").filter("n > 0")


def palette(voxels: DataFrame, key: str, value: str) -> DataFrame:
    """Distinct values of each sample in order, numbered from 0."""
    return voxels.select(key, value).distinct().withColumn("index", F.row_number().over(W.partitionBy(key).orderBy(value)) - 1)


def near_key(shapes: DataFrame, key: str, coarse: str) -> DataFrame:
    """Candidate key for comparison: coarse hash, voxels, and the extents in order."""
    dims = F.array_join(F.array_sort(F.array("dx", "dy", "dz")), ",")
    return shapes.select(key, F.sha2(F.concat_ws("|", coarse, "n_voxels", dims), 256).alias("near_key"))


def duplicate_decision(assets: DataFrame, key: str, order: list[Column], cascade: list[str]) -> DataFrame:
    """For each asset, the first rule of the cascade by which an earlier asset equals it, and that asset.

    Every rule is a grouped first row: rows of a key are ordered once, and compared with the first only.
    """
    found = assets
    for rule in cascade:
        w = W.partitionBy(rule).orderBy(*order)
        first = F.first(key).over(w.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
        found = found.withColumn(f"__{rule}", F.when(F.col(rule).isNotNull() & (first != F.col(key)), first))
    original = F.coalesce(*[F.col(f"__{r}") for r in cascade])
    rule = F.coalesce(*[F.when(F.col(f"__{r}").isNotNull(), F.lit(r)) for r in cascade])
    return found.select(key, rule.alias("rule"), original.alias("original"))


def parent_faults(parts: DataFrame, node: str, parent: str, depth: int = 64) -> DataFrame:
    """Nodes whose parent is missing, or whose chain of parents goes on for more than ``depth`` steps, as in a cycle.

    Chains are followed by doubling: each round's table leads twice as far.
    """
    up = written(parts.select(F.col(node).alias("n"), F.col(parent).alias("p")), "parents")
    known = up.select(F.col("n").alias("__k"))
    missing = up.filter("p IS NOT NULL").join(known, F.col("p") == F.col("__k"), "left_anti").select(F.col("n").alias(node), F.lit("parent_missing").alias("rule"))
    far, reach = up, 1
    while reach <= depth:
        next_ = far.select(F.col("n").alias("__n"), F.col("p").alias("__p"))
        far = written(far.join(next_, F.col("p") == F.col("__n"), "left").select("n", F.col("__p").alias("p")), "parents")
        reach *= 2
    return missing.unionByName(far.filter("p IS NOT NULL").select(F.col("n").alias(node), F.lit("parent_cycle").alias("rule")))


def violations(measured: DataFrame, key: str, minima: dict[str, float]) -> DataFrame:
    """Findings (key, rule, actual, required) where a measure is below its least value or unknown."""
    long = measured.select(key, *[F.col(m).cast("double").alias(m) for m in minima]).unpivot([key], list(minima), "rule", "actual")
    required = F.lit(None).cast("double")
    for m, least in minima.items():
        required = F.when(F.col("rule") == m, F.lit(float(least))).otherwise(required)
    return long.withColumn("required", required).filter("actual IS NULL OR actual < required")
