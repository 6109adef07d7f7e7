"""Reading and writing release files."""

from __future__ import annotations

import gzip
import json

import numpy as np
from pyspark.sql import functions as F

from tessel.sources import files


def _sample(name: str, state: str | None) -> dict:
    return {"sample_id": name, "components": [{"id": "c", "category": "roof"}], "blocks": [{"x": 1, "y": 2, "z": 3, "type": "stone", "block_state": state, "component_id": "c"}]}


def test_samples_and_mirrors(spark, tmp_path):
    for folder, other in (("a", "s"), ("b", "t")):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "sample.json").write_text(json.dumps(_sample(other, None)))
        (tmp_path / folder / "sample.json.gz").write_bytes(gzip.compress(json.dumps(_sample("s", None)).encode()))
    rows = files.samples(spark, f"{tmp_path}/*/*")
    assert rows.count() == 4
    assert [r.folder.rsplit("/", 1)[1] for r in files.disagreeing_mirrors(rows).collect()] == ["b"]
    assert {r.path.endswith(".gz") for r in files.prefer_compressed(rows).collect()} == {True}
    assert {r.state for r in files.voxels(rows).collect()} == {"stone"}


def test_arrays(spark, tmp_path):
    coords = np.array([[1, 2, 3], [4, 5, 6]], "<u2")
    index = np.array([0, 1], "<u4")
    np.savez_compressed(tmp_path / "good.npz", coords=coords, block_index=index, component_index=index)
    np.savez_compressed(tmp_path / "float.npz", coords=coords.astype(float), block_index=index, component_index=index)
    np.savez_compressed(tmp_path / "missing.npz", coords=coords, block_index=index)
    (tmp_path / "broken.npz").write_bytes(b"no archive")
    rows = files.arrays(spark, str(tmp_path)).collect()
    assert sorted((r.x, r.z, r.block_index) for r in rows if r.fault is None) == [(1, 3, 0), (4, 6, 1)]
    assert sorted(r.path.rsplit("/", 1)[1] for r in rows if r.fault) == ["broken.npz", "float.npz", "missing.npz"]


def test_tar_round_trip_is_deterministic(spark, tmp_path):
    members = spark.createDataFrame([(0, "b", b"2"), (0, "a", b"1"), (1, "c", b"3")], "shard int, name string, content binary")
    first, second = (sorted((r["shard"], bytes(r.content)) for r in files.tar_shards(m, "shard", "name", "content").collect()) for m in (members, members.orderBy("name")))
    assert first == second
    for shard, content in first:
        (tmp_path / f"{shard}.tar").write_bytes(content)
    got = files.tar_members(spark, str(tmp_path))
    assert sorted((r.name, r.size) for r in got.collect()) == [("a", 1), ("b", 1), ("c", 1)]
    assert got.filter(F.col("sha256") == F.sha2(F.lit("2").cast("binary"), 256)).first().name == "b"


def test_records_and_hashes(spark, tmp_path):
    df = spark.createDataFrame([(2, "y"), (1, "x")], "id int, v string")
    files.write_records(df, str(tmp_path / "out"), ["id"])
    assert [r.id for r in spark.read.json(str(tmp_path / "out")).orderBy("id").collect()] == [1, 2]
    assert files.hashed_files(spark, str(tmp_path / "out"), "*.json").count() > 0


def test_sse_events(spark):
    body = "data: {\"a\":1}\r\n\r\n: note\n\ndata: two\ndata: lines\n\ndata: [DONE]\n\ndata: late\n\n"
    rows = files.sse_events(spark.createDataFrame([(1, body), (2, None)], "k int, b string"), "k", "b").orderBy("event_no").collect()
    assert [r.data for r in rows] == ['{"a":1}', "two\nlines"]


def test_publish_is_idempotent_and_refuses_other_options(spark, tmp_path):
    import pytest

    df = spark.createDataFrame([(1, "x")], "id int, v string")
    target = str(tmp_path / "release")
    assert files.publish({"index": df}, target, {"n": "1"}) and not files.publish({"index": df}, target, {"n": "1"})
    assert spark.read.json(f"{target}/index").count() == 1
    with pytest.raises(FileExistsError):
        files.publish({"index": df}, target, {"n": "2"})
