"""An archive of immutable files: a sink that commits in two phases, its journal, verification, backup and restore.

``root`` holds ``assets`` (what is committed), ``commits`` (the journal) and ``staging`` (what is not committed yet), in any store that
pyarrow and Spark both read and that renames folders at once.

Tasks write their files and a list of them below ``staging`` and tell the driver only sums: files, bytes and the sum of the files'
digests, from which the commit id is made, so that it depends on the content alone and not on how rows were dealt out. The driver
gathers the finished tasks' folders, writes the journal and then renames one folder. Lists of files stay with the tasks.
"""

from __future__ import annotations

import contextlib
import hashlib
import itertools
import json
import os
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

#: What the archive keeps about a file.
RECORD = "asset_id string, revision int, name string, bytes long, sha256 string"
#: Folders that a backup takes, as far as they are there.
ROOTS = ("assets", "runtimes", "releases", "runs", "commits", "work", "staging")
#: Fixed value: form of ids and of each part of a name.
SAFE = re.compile(r"[A-Za-z0-9][A-Za-z0-9._-]{0,127}")
CHUNK = 1 << 20
_LIST = "manifest.jsonl"


def store(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    return pafs.FileSystem.from_uri(re.sub("^file:/(?!/)", "file:///", path))


def _there(files: pafs.FileSystem, path: str) -> bool:
    return files.get_file_info(path).type != pafs.FileType.NotFound


def _children(files: pafs.FileSystem, path: str) -> list[str]:
    return sorted(x.path for x in files.get_file_info(pafs.FileSelector(path, allow_not_found=True)))


def _durable(files: pafs.FileSystem, path: str) -> None:
    """Local files and folders reach the disk; other stores see to it themselves."""
    if isinstance(files, pafs.LocalFileSystem):
        handle = os.open(path, os.O_RDONLY)
        try:
            os.fsync(handle)
        finally:
            os.close(handle)


def _put(files: pafs.FileSystem, path: str, content: bytes) -> None:
    """A whole file at once: beside it first, then renamed."""
    beside = f"{path}.{uuid.uuid4().hex}.tmp"
    with files.open_output_stream(beside) as f:
        f.write(content)
    _durable(files, beside)
    files.move(beside, path)


def _digest(files: pafs.FileSystem, path: str, copy_to: str | None = None) -> tuple[int, str]:
    """Bytes and sha256 of a file, read in chunks, and copied on the way if asked."""
    h, n = hashlib.sha256(), 0
    with contextlib.ExitStack() as held:
        source = held.enter_context(files.open_input_stream(path))
        target = held.enter_context(files.open_output_stream(copy_to)) if copy_to else None
        while chunk := source.read(CHUNK):
            h.update(chunk)
            n += len(chunk)
            if target:
                target.write(chunk)
    return n, h.hexdigest()


@dataclass
class _Part(WriterCommitMessage):
    """What a task tells the driver."""

    name: str
    files: int
    bytes: int
    total: int
    list_sha256: str


class _Writer(DataSourceArrowWriter):
    def __init__(self, root: str, job: str) -> None:
        self.root, self.job = root, job

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Part:
        files, root = store(self.root)
        task = TaskContext.get()
        part = f"part-{task.partitionId():05d}-{task.taskAttemptId()}"
        folder = f"{root}/staging/{self.job}/{part}"
        files.create_dir(folder)
        n = size = total = 0
        listed = hashlib.sha256()
        made: set[str] = set()
        with files.open_output_stream(f"{folder}/{_LIST}") as lines:
            for batch in iterator:
                for asset, revision, name, content in zip(*(batch.column(c) for c in ("asset_id", "revision", "name", "content"))):
                    asset, revision, name, content = asset.as_py(), revision.as_py(), name.as_py(), content.as_py() or b""
                    if not SAFE.fullmatch(asset or "") or not all(SAFE.fullmatch(x) for x in (name or "").split("/")) or not 1 <= (revision or 0) <= 999_999:
                        raise ValueError(f"no safe file: {asset!r}, {revision!r}, {name!r}")
                    path = f"{folder}/{asset}/v{revision:06d}/{name}"
                    parent = path.rpartition("/")[0]
                    if parent not in made:
                        files.create_dir(parent)
                        made = {parent}
                    with files.open_output_stream(path) as f:
                        f.write(content)
                    _durable(files, path)
                    record = {"asset_id": asset, "revision": revision, "name": name, "bytes": len(content), "sha256": hashlib.sha256(content).hexdigest()}
                    line = json.dumps(record, sort_keys=True, separators=(",", ":")).encode() + b"\n"
                    lines.write(line)
                    listed.update(line)
                    n, size, total = n + 1, size + len(content), total + int.from_bytes(hashlib.sha256(line).digest(), "big")
        return _Part(part, n, size, total % (1 << 256), listed.hexdigest())

    def commit(self, messages: list[_Part | None]) -> None:
        parts = sorted((m for m in messages if m is not None and m.files), key=lambda m: m.name)
        total = sum(m.total for m in parts) % (1 << 256)
        counts = {"files": sum(m.files for m in parts), "bytes": sum(m.bytes for m in parts)}
        commit_id = hashlib.sha256(f"{total:064x}:{counts['files']}:{counts['bytes']}".encode()).hexdigest()
        files, root = store(self.root)
        mine = f"{root}/staging/{self.job}"
        settle(self.root, commit_id)
        if parts and not _there(files, _final(root, commit_id)):
            ready = f"{root}/staging/{commit_id}"
            if _there(files, ready):  # gathered by a run that did not come to its journal
                files.delete_dir(ready)
            files.create_dir(ready)
            for m in parts:
                files.move(f"{mine}/{m.name}", f"{ready}/{m.name}")
            record = {"commit_id": commit_id, **counts, "parts": [{"name": m.name, "files": m.files, "list_sha256": m.list_sha256} for m in parts]}
            content = json.dumps(record, sort_keys=True, separators=(",", ":")).encode()
            _put(files, f"{ready}/commit.json", content)
            files.create_dir(f"{root}/commits")
            _put(files, f"{root}/commits/{commit_id}.json", content)
            settle(self.root, commit_id)
        files.delete_dir(mine)

    def abort(self, messages: list[_Part | None]) -> None:
        files, root = store(self.root)
        if _there(files, f"{root}/staging/{self.job}"):
            files.delete_dir(f"{root}/staging/{self.job}")


class ArchiveSource(DataSource):
    """The sink as a data source: option ``path`` is the archive's root."""

    @classmethod
    def name(cls) -> str:
        return "asset_archive"

    def writer(self, schema, overwrite: bool) -> _Writer:
        if overwrite:
            raise ValueError("an archive is only appended to")
        return _Writer(self.options["path"], f"job-{uuid.uuid4().hex}")


def _final(root: str, commit_id: str) -> str:
    return f"{root}/assets/{commit_id[:2]}/{commit_id}"


def settle(root_uri: str, commit_id: str) -> bool:
    """Finish a commit whose journal was written but whose folder was not renamed; whether there was one."""
    files, root = store(root_uri)
    journal, ready, final = f"{root}/commits/{commit_id}.json", f"{root}/staging/{commit_id}", _final(root, commit_id)
    if not _there(files, journal) or _there(files, final) or not _there(files, ready):
        return False
    record = json.loads(files.open_input_stream(journal).read())
    for part in record["parts"]:
        if _digest(files, f"{ready}/{part['name']}/{_LIST}")[1] != part["list_sha256"]:
            raise ValueError(f"commit {commit_id} does not match its journal")
    files.create_dir(final.rpartition("/")[0])
    files.move(ready, final)
    _durable(files, final.rpartition("/")[0])
    return True


def recover(root_uri: str) -> list[str]:
    """Settle all commits that a crash left between journal and rename; their ids."""
    files, root = store(root_uri)
    ids = [p.rpartition("/")[2].removesuffix(".json") for p in _children(files, f"{root}/commits") if p.endswith(".json")]
    return [i for i in ids if settle(root_uri, i)]


def pending(root_uri: str) -> list[dict]:
    """Journals of commits that are in place and not acknowledged yet, one for each write."""
    files, root = store(root_uri)
    records = [json.loads(files.open_input_stream(p).read()) for p in _children(files, f"{root}/commits") if p.endswith(".json")]
    return [r for r in records if _there(files, _final(root, r["commit_id"]))]


def acknowledge(root_uri: str, commit_id: str) -> None:
    """Forget a journal once its commit is applied; again does nothing."""
    if not re.fullmatch("[0-9a-f]{64}", commit_id):
        raise ValueError("no commit id")
    files, root = store(root_uri)
    if _there(files, f"{root}/commits/{commit_id}.json"):
        files.delete_file(f"{root}/commits/{commit_id}.json")


def manifest(spark: SparkSession, root_uri: str) -> DataFrame:
    """Every archived file: asset_id, revision, name, bytes, sha256, path (relative to the root)."""
    files, root = store(root_uri)
    if not any(_children(files, p) for p in _children(files, f"{root}/assets")):
        return spark.createDataFrame([], f"{RECORD}, path string")
    rows = spark.read.schema(RECORD).json(f"{root_uri}/assets/*/*/*/{_LIST}").withColumn("__f", F.col("_metadata.file_path"))
    folder = F.regexp_extract("__f", f"(assets/[^/]+/[^/]+/[^/]+)/{re.escape(_LIST)}$", 1)
    return rows.withColumn("path", F.concat_ws("/", folder, "asset_id", F.format_string("v%06d", "revision"), "name")).drop("__f")


def archived(df: DataFrame, root_uri: str) -> None:
    """Archive the rows (asset_id, revision, name, content): each revision once and for ever.

    A revision that is there with the same files is left out; with other files, or a file given twice, it is refused. Null content is
    an empty file; no rows change nothing.
    """
    spark = df.sparkSession
    spark.dataSource.register(ArchiveSource)
    recover(root_uri)
    rows = df.select(F.col("asset_id").cast("string").alias("asset_id"), F.col("revision").cast("int").alias("revision"), F.col("name").cast("string").alias("name"), F.col("content").cast("binary").alias("content"))
    asset, file = ["asset_id", "revision"], ["asset_id", "revision", "name"]
    if twice := rows.groupBy(*file).count().filter("count > 1").first():
        raise ValueError(f"given twice: {tuple(twice)[:3]}")
    old = manifest(spark, root_uri)
    new = rows.select(*file, F.sha2(F.coalesce("content", F.lit(b"")), 256).alias("new"))
    common = new.select(*asset).intersect(old.select(*asset))
    both = new.join(common, asset, "left_semi").join(old.join(common, asset, "left_semi").select(*file, "sha256"), file, "full")
    if other := both.filter("NOT new <=> sha256").first():
        raise ValueError(f"immutable revision: {tuple(other)[:3]}")
    fresh = rows.join(old.select(*asset).distinct(), asset, "left_anti")
    fresh.write.format("asset_archive").option("path", root_uri).mode("append").save()


def file_records(spark: SparkSession, folder_uri: str, copy_to: str | None = None, below: tuple[str, ...] | None = None) -> DataFrame:
    """path (relative), kind (name before the first dot), bytes, sha256, fault of every file; read in chunks, and copied if asked.

    An empty file and a symbolic link are faults; links are not followed. With ``below`` only these folders are taken.
    """
    files, folder = store(folder_uri)
    tops = [x for x in ([f"{folder}/{x}" for x in below] if below else [folder]) if _there(files, x)]
    schema = "path string, kind string, bytes long, sha256 string, fault string"
    target = store(copy_to)[1] if copy_to else None

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, _ = store(folder_uri)
        for b in batches:
            for top in b.column(0).to_pylist():
                for some in itertools.batched(_listing(own, top), 1000):
                    yield pa.RecordBatch.from_arrays([pa.array(some, pa.string())], names=["path"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, _ = store(folder_uri)
        for b in batches:
            rows = []
            for path in b.column(0).to_pylist():
                name = path[len(folder) :].strip("/")
                if isinstance(own, pafs.LocalFileSystem) and os.path.islink(path):
                    rows.append((name, None, None, None, "link"))
                    continue
                if target:
                    own.create_dir(f"{target}/{name}".rpartition("/")[0])
                n, sha = _digest(own, path, f"{target}/{name}" if target else None)
                rows.append((name, name.rpartition("/")[2].partition(".")[0], n, sha, None if n else "empty"))
            kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)] if rows else [pa.nulls(0, k) for k in kinds], names=[x.split()[0] for x in schema.split(", ")])

    # the driver lists folders three levels deep at most; tasks list what lies below, and hash the files dealt out anew
    folders = spark.createDataFrame([(x,) for t in tops for x in _upper(files, t, 3)], "path string")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))  # said outright, as these rows are few bytes and stand for many
    return folders.repartition(n, "path").mapInArrow(listed, "path string").repartition(n, "path").mapInArrow(work, schema)


def _upper(files: pafs.FileSystem, path: str, levels: int) -> Iterator[str]:
    """Files above, and folders at, some levels below a folder; a link counts as a file."""
    linked = isinstance(files, pafs.LocalFileSystem) and os.path.islink(path)
    if linked or not levels or files.get_file_info(path).type == pafs.FileType.File:
        yield path
    else:
        for child in _children(files, path):
            yield from _upper(files, child, levels - 1)


def _listing(files: pafs.FileSystem, path: str) -> Iterator[str]:
    """The files below a folder, or the file itself; local links are listed and not followed."""
    if not isinstance(files, pafs.LocalFileSystem):
        info = files.get_file_info(path)
        yield from [path] if info.type == pafs.FileType.File else (x.path for x in files.get_file_info(pafs.FileSelector(path, recursive=True)) if x.type == pafs.FileType.File)
    elif os.path.islink(path) or os.path.isfile(path):
        yield path
    else:
        for current, folders, names in os.walk(path):
            yield from (f"{current}/{x}" for x in [*names, *(d for d in folders if os.path.islink(f"{current}/{d}"))])


def _against(actual: DataFrame, wanted: DataFrame) -> DataFrame:
    """path, fault (missing, added, altered) where the files differ from their records."""
    a, w = actual.select("path", F.col("bytes").alias("a"), F.col("sha256").alias("s")), wanted.select("path", "bytes", "sha256")
    fault = F.when(F.col("s").isNull(), "missing").when(F.col("sha256").isNull(), "added").when((F.col("a") != F.col("bytes")) | (F.col("s") != F.col("sha256")), "altered")
    return a.join(w, "path", "full").select("path", fault.alias("fault")).filter("fault IS NOT NULL")


def faults(spark: SparkSession, root_uri: str) -> DataFrame:
    """path, fault of archived files that are missing, altered or added, the lists of files included."""
    actual = file_records(spark, root_uri, below=("assets",))
    own = actual.filter(~F.col("path").rlike(rf"^assets/[^/]+/[^/]+/([^/]+/{re.escape(_LIST)}|commit\.json)$"))
    files, root = store(root_uri)
    commits = [c for p in _children(files, f"{root}/assets") for c in _children(files, p)]
    lists = [(f"{c[len(root) + 1:]}/{p['name']}/{_LIST}", p["list_sha256"]) for c in commits for p in json.loads(files.open_input_stream(f"{c}/commit.json").read())["parts"]]
    signed = spark.createDataFrame(lists, "path string, sha256 string")
    bad = signed.join(actual.select("path", F.col("sha256").alias("s")), "path", "left").filter("NOT s <=> sha256").select("path", F.when(F.col("s").isNull(), "missing").otherwise("altered").alias("fault"))
    return _against(own, manifest(spark, root_uri)).unionByName(bad)


def backup(spark: SparkSession, root_uri: str, output_uri: str, busy: DataFrame | None = None) -> DataFrame:
    """Copy the archive's folders, with a signed list of files; the list. Refused while ``busy`` has a row (running work).

    A backup that is there is verified and left as it is; a half-made one is refused, as are links.
    """
    files, output = store(output_uri)
    if _there(files, output):
        if bad := backup_faults(spark, output_uri).first():
            raise ValueError(f"backup is damaged: {tuple(bad)}")
        return _listed(spark, output_uri)
    if busy is not None and (row := busy.first()):
        raise ValueError(f"work is running: {row.asDict()}")
    staging = f"{output_uri}.staging"
    if _there(files, f"{output}.staging"):
        raise FileExistsError(f"{staging} was left unfinished")
    files.create_dir(f"{output}.staging/files")
    copied = file_records(spark, root_uri, copy_to=f"{staging}/files", below=ROOTS)
    copied.sort("path").write.json(f"{staging}/list")
    if bad := _listed(spark, output_uri, staging).filter("fault = 'link'").first():
        files.delete_dir(f"{output}.staging")
        raise ValueError(f"link in the archive: {bad.path}")
    if bad := backup_faults(spark, staging).first():
        raise ValueError(f"backup differs: {tuple(bad)}")
    files.move(f"{output}.staging", output)
    return _listed(spark, output_uri)


def _listed(spark: SparkSession, output_uri: str, where: str | None = None) -> DataFrame:
    return spark.read.schema("path string, kind string, bytes long, sha256 string, fault string").json(f"{where or output_uri}/list")


def backup_faults(spark: SparkSession, output_uri: str) -> DataFrame:
    """path, fault of files of a backup that differ from its list."""
    return _against(file_records(spark, f"{output_uri}/files"), _listed(spark, output_uri))


def restore(spark: SparkSession, output_uri: str, destination_uri: str) -> dict:
    """Put a verified backup into a new root; its receipt. A destination that exists is refused."""
    files, destination = store(destination_uri)
    if _there(files, destination):
        raise FileExistsError(f"{destination_uri} exists")
    if bad := backup_faults(spark, output_uri).first():
        raise ValueError(f"backup is damaged: {tuple(bad)}")
    files.create_dir(destination)
    summed = file_records(spark, f"{output_uri}/files", copy_to=destination_uri).agg(F.count("*").alias("files"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")).first()
    if bad := _against(file_records(spark, destination_uri), _listed(spark, output_uri)).first():
        raise ValueError(f"restored file differs: {tuple(bad)}")
    receipt = {"backup": output_uri, "files": summed.files, "bytes": summed.bytes}
    _put(files, f"{destination}/restore_receipt.json", json.dumps(receipt, sort_keys=True).encode())
    return receipt
