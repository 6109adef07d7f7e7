"""Exchanges of the sample views grow with the table."""

from __future__ import annotations

import re

import pytest

from tessel.plans import registry, stages

SMALL = "/root/testdata/sf0.001"
BY_SAMPLE = [
    "geo_visible_faces", "geo_detached_groups", "drw_strokes_to_voxels", "geo_composition", "geo_quantised_cells", "geo_component_measures", "geo_neighbour_counts",
    "geo_cube_hash", "geo_binary_hashes", "geo_bodies", "geo_walkable",
]


def final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", BY_SAMPLE)
def test_one_exchange_in_as_many_parts_as_rows_ask_for(spark, monkeypatch, name):
    monkeypatch.setattr(stages, "PART_ROWS", 500)
    plan = final_plan(registry.QUERIES[name](spark, SMALL))
    rows = spark.read.parquet(f"{SMALL}/lineitem.parquet").count()
    assert re.findall(r"Exchange hashpartitioning\(.*, (\d+)\), REPARTITION_BY_NUM", plan) == [str(-(-rows // 500))]
    assert len(re.findall(r"\bExchange ", plan)) == 1
