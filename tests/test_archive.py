"""The archive: immutable revisions, crashes between journal and rename, verification, backup and restore."""

from __future__ import annotations

import hashlib
import json

import pytest

from tessel.sources import archive


def _files(spark, rows, parts=3):
    return spark.createDataFrame(rows, "asset_id string, revision int, name string, content binary").repartition(parts)


ROWS = [(f"a{k}", 1 + k % 2, name, f"{k} {name}".encode()) for k in range(20) for name in ("source.py", "previews/view_a.webp", "empty.txt")]
ROWS = [(a, r, n, b"" if n == "empty.txt" else c) for a, r, n, c in ROWS]


def _tree(folder):
    return {str(p.relative_to(folder)): p.read_bytes() for p in sorted(folder.rglob("*")) if p.is_file() and not p.name.startswith(".") and not p.name.endswith(".crc")}


def test_commit_id_follows_the_content_alone(spark, tmp_path):
    ids = []
    for k, parts in enumerate((1, 7)):
        root = f"file://{tmp_path}/r{k}"
        archive.archived(_files(spark, ROWS[:: -1 if k else 1], parts), root)
        (record,) = archive.pending(root)
        assert (record["files"], record["bytes"]) == (60, sum(len(c) for *_, c in ROWS))
        ids.append(record["commit_id"])
        got = {(r.asset_id, r.revision, r.name): (r.bytes, r.sha256) for r in archive.manifest(spark, root).collect()}
        assert got == {(a, r, n): (len(c), hashlib.sha256(c).hexdigest()) for a, r, n, c in ROWS}
        assert all((tmp_path / f"r{k}" / r.path).read_bytes() == {(a, v, n): c for a, v, n, c in ROWS}[r.asset_id, r.revision, r.name] for r in archive.manifest(spark, root).collect())
    assert ids[0] == ids[1]


def test_revisions_are_immutable(spark, tmp_path):
    root = str(tmp_path / "root")
    archive.archived(_files(spark, ROWS[:30]), root)
    before = _tree(tmp_path / "root")
    archive.archived(_files(spark, ROWS[:30]), root)  # the same again
    assert _tree(tmp_path / "root") == before
    archive.archived(_files(spark, ROWS), root)  # ten new assets
    assert archive.manifest(spark, root).count() == 60 and len(archive.pending(root)) == 2
    for changed in ([("a0", 1, "source.py", b"other")], [("a0", 1, "source.py", b"0 source.py")], [*((a, r, n, c) for a, r, n, c in ROWS if a == "a0"), ("a0", 1, "more.txt", b"x")]):
        with pytest.raises(ValueError, match="immutable"):
            archive.archived(_files(spark, changed), root)
    with pytest.raises(ValueError, match="given twice"):
        archive.archived(_files(spark, [("b", 1, "x", b"1"), ("b", 1, "x", b"1")]), root)
    archive.archived(_files(spark, []), root)
    assert archive.manifest(spark, root).count() == 60 and archive.faults(spark, root).count() == 0


@pytest.mark.parametrize("row", [("../a", 1, "x", b""), ("a", 0, "x", b""), ("a", 1, "x/../../y", b""), ("a", 1, "/x", b""), (None, 1, "x", b"")])
def test_unsafe_names_leave_nothing(spark, tmp_path, row):
    root = tmp_path / "root"
    with pytest.raises(Exception, match="no safe file"):
        archive.archived(_files(spark, [("ok", 1, "x", b"1"), row], 1), str(root))
    assert not _tree(root)


def test_crash_between_journal_and_rename(spark, tmp_path):
    whole, broken = str(tmp_path / "whole"), str(tmp_path / "broken")
    archive.archived(_files(spark, ROWS), whole)
    archive.archived(_files(spark, ROWS), broken)
    # as after a crash: the journal is written, the folder still in staging, and a task's folder left over
    (record,) = archive.pending(broken)
    final = next((tmp_path / "broken/assets").glob("*/*"))
    final.rename(tmp_path / "broken/staging" / record["commit_id"])
    assert archive.pending(broken) == [] and archive.manifest(spark, broken).count() == 0
    archive.archived(_files(spark, ROWS, 5), broken)
    assert [r["commit_id"] for r in archive.pending(broken)] == [record["commit_id"]]
    content = lambda root: {(r.asset_id, r.revision, r.name, r.sha256) for r in archive.manifest(spark, root).collect()}
    assert content(broken) == content(whole) and archive.faults(spark, broken).count() == 0
    assert archive.recover(broken) == []
    archive.acknowledge(broken, record["commit_id"])
    archive.acknowledge(broken, record["commit_id"])
    assert archive.pending(broken) == []
    with pytest.raises(ValueError):
        archive.acknowledge(broken, "../x")


def test_crash_before_the_journal(spark, tmp_path):
    """Folders gathered without a journal are made anew; a journal that does not match its folder is refused."""
    root = tmp_path / "root"
    archive.archived(_files(spark, ROWS), str(root))
    (record,) = archive.pending(str(root))
    half = root / "staging" / record["commit_id"]
    next((root / "assets").glob("*/*")).rename(half)
    (root / "commits" / f"{record['commit_id']}.json").unlink()
    next(half.glob("part-*/manifest.jsonl")).unlink()
    archive.archived(_files(spark, ROWS), str(root))
    assert archive.faults(spark, str(root)).count() == 0 and archive.manifest(spark, str(root)).count() == 60
    next((root / "assets").glob("*/*")).rename(half)
    next(half.glob("part-*/manifest.jsonl")).write_text("{}\n")
    with pytest.raises(ValueError, match="journal"):
        archive.recover(str(root))


def test_faults_are_found(spark, tmp_path):
    root = tmp_path / "root"
    archive.archived(_files(spark, ROWS), str(root))
    listed = {r.asset_id: r.path for r in archive.manifest(spark, str(root)).filter("name = 'source.py'").collect()}
    (root / listed["a1"]).unlink()
    (root / listed["a2"]).write_bytes(b"2 source.pX")
    (root / listed["a3"]).with_name("extra.txt").write_bytes(b"x")
    got = {r.path: r.fault for r in archive.faults(spark, str(root)).collect()}
    assert got == {listed["a1"]: "missing", listed["a2"]: "altered", listed["a3"].replace("source.py", "extra.txt"): "added"}
    lines = next((root / "assets").glob("*/*/part-*/manifest.jsonl"))
    lines.write_text(lines.read_text().replace('"revision":1', '"revision":2', 1))
    assert archive.faults(spark, str(root)).filter("path LIKE '%manifest.jsonl' AND fault = 'altered'").count() == 1


def test_backup_and_restore(spark, tmp_path):
    root, out, back = tmp_path / "root", tmp_path / "backup", tmp_path / "restored"
    archive.archived(_files(spark, ROWS), str(root))
    (root / "work").mkdir()
    (root / "work/a file.bin").write_bytes(b"w" * 3_000_000)
    (root / "elsewhere").mkdir()
    (root / "elsewhere/x").write_bytes(b"not taken")
    with pytest.raises(ValueError, match="running"):
        archive.backup(spark, str(root), str(out), busy=spark.sql("SELECT 1 AS campaign_id"))
    listed = archive.backup(spark, str(root), str(out), busy=spark.sql("SELECT 1 AS campaign_id WHERE FALSE"))
    assert {r.path for r in listed.collect()} == {p for p in _tree(root) if not p.startswith("elsewhere")}
    assert listed.filter("path = 'work/a file.bin'").first().kind == "a file" and listed.filter("fault = 'empty'").count() == 20
    assert archive.backup(spark, str(root), str(out)).count() == listed.count()  # there already
    receipt = archive.restore(spark, str(out), str(back))
    kept = _tree(back)
    assert json.loads(kept.pop("restore_receipt.json")) == receipt and kept == {p: c for p, c in _tree(root).items() if not p.startswith("elsewhere")}
    with pytest.raises(FileExistsError):
        archive.restore(spark, str(out), str(back))
    (out / "files/work/a file.bin").write_bytes(b"v" * 3_000_000)
    for refused in (lambda: archive.restore(spark, str(out), str(tmp_path / "again")), lambda: archive.backup(spark, str(root), str(out))):
        with pytest.raises(ValueError, match="damaged"):
            refused()
    assert not (tmp_path / "again").exists()


def test_links_and_unfinished_backups(spark, tmp_path):
    root = tmp_path / "root"
    archive.archived(_files(spark, ROWS), str(root))
    (root / "work").mkdir()
    (root / "work/link").symlink_to(root / "commits")
    (root / "work/file").symlink_to(next((root / "commits").iterdir()))
    with pytest.raises(ValueError, match="link"):
        archive.backup(spark, str(root), str(tmp_path / "b"))
    assert not (tmp_path / "b").exists()
    (tmp_path / "c.staging").mkdir()
    with pytest.raises(FileExistsError):
        archive.backup(spark, str(root), str(tmp_path / "c"))
