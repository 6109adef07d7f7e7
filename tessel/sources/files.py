"""Reading and writing release files: JSON samples, compressed arrays, tar shards, JSON lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

#: Schema of a sample file: its components and its occupied blocks.
SAMPLE = T.StructType([
    T.StructField("sample_id", T.StringType()), T.StructField("asset_type", T.StringType()),
    T.StructField("components", T.ArrayType(T.StructType([T.StructField("id", T.StringType()), T.StructField("category", T.StringType())]))),
    T.StructField("blocks", T.ArrayType(T.StructType([T.StructField(a, T.IntegerType()) for a in "xyz"] + [T.StructField(c, T.StringType()) for c in ("type", "block_state", "component_id")]))),
])
#: Bound on a decoded array archive, and on the voxels of one sample.
MOST_BYTES, MOST_VOXELS = 256 << 20, 600_000


def samples(spark: SparkSession, path: str) -> DataFrame:
    """Sample files, plain or gzip, one JSON document each; files that do not parse come as rows of nulls."""
    return spark.read.schema(SAMPLE).option("multiLine", True).option("mode", "PERMISSIVE").json(path).withColumn("path", F.col("_metadata.file_path"))


def voxels(sample_rows: DataFrame) -> DataFrame:
    """One row per block; the block state where given, else the plain type."""
    blocks = sample_rows.select("sample_id", F.explode("blocks").alias("b"))
    return blocks.select("sample_id", *[F.col(f"b.{a}").alias(a) for a in "xyz"], F.coalesce("b.block_state", "b.type").alias("state"), F.col("b.component_id").alias("component_id"))


def disagreeing_mirrors(sample_rows: DataFrame) -> DataFrame:
    """Folders whose sample files differ in content."""
    folder = F.regexp_replace("path", r"/[^/]*$", "")
    return sample_rows.groupBy(folder.alias("folder")).agg(F.count("*").alias("files"), F.countDistinct(F.xxhash64("sample_id", "components", "blocks")).alias("contents")).filter("contents > 1")


def prefer_compressed(files: DataFrame, path: str = "path") -> DataFrame:
    """One file per folder and stem, the compressed one first."""
    from pyspark.sql import Window as W

    stem = F.regexp_replace(path, r"\.gz$", "")
    return files.withColumn("__n", F.row_number().over(W.partitionBy(stem).orderBy(F.col(path).endswith(".gz").cast("int").desc(), path))).filter("__n = 1").drop("__n")


def hashed_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """path, length and sha256 of every file below ``path``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    return files.select("path", "length", F.sha2("content", 256).alias("sha256"))


def arrays(spark: SparkSession, path: str) -> DataFrame:
    """Voxels of compressed array archives: exactly coords (N by 3), block_index and component_index, all of whole numbers.

    Sizes in the headers are held against ``MOST_VOXELS`` before any array is unpacked; an archive that breaks a rule gives
    one row with its fault instead of voxels.
    """
    schema = "path string, x int, y int, z int, block_index int, component_index int, fault string"

    def decode(batches):
        import io
        import zipfile

        import numpy as np
        import pyarrow as pa

        names = {"coords.npy": 2, "block_index.npy": 1, "component_index.npy": 1}

        def read(content: bytes):
            with zipfile.ZipFile(io.BytesIO(content)) as z:
                if set(z.namelist()) != set(names) or sum(i.file_size for i in z.infolist()) > MOST_BYTES:
                    raise ValueError("members")
                found = {}
                for name, dims in names.items():
                    with z.open(name) as f:
                        version = np.lib.format.read_magic(f)
                        shape, _, kind = (np.lib.format.read_array_header_1_0 if version == (1, 0) else np.lib.format.read_array_header_2_0)(f)
                        if kind.kind not in "iu" or kind.itemsize > 8 or len(shape) != dims or shape[0] > MOST_VOXELS:
                            raise ValueError("header")
                    with z.open(name) as f:
                        found[name] = np.lib.format.read_array(f, allow_pickle=False)
            if found["coords.npy"].shape[1:] != (3,) or len({len(v) for v in found.values()}) != 1:
                raise ValueError("shape")
            return found

        for b in batches:
            for file, content in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                try:
                    a = read(content.as_py())
                    c, n = a["coords.npy"].astype(np.int32), len(a["coords.npy"])
                    columns = [[file] * n, c[:, 0], c[:, 1], c[:, 2], a["block_index.npy"].astype(np.int32), a["component_index.npy"].astype(np.int32), [None] * n]
                except (ValueError, zipfile.BadZipFile, EOFError, OSError) as e:
                    columns = [[file], *[[None]] * 5, [f"{type(e).__name__}: {e}"]]
                kinds = [pa.string(), *[pa.int32()] * 5, pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(columns, kinds, strict=True)], names=[f.split()[0] for f in schema.split(", ")])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.npz").option("recursiveFileLookup", True).load(path)
    return files.select("path", "content").mapInArrow(decode, schema)


def tar_members(spark: SparkSession, path: str) -> DataFrame:
    """(shard, name, size, sha256) of the regular members of tar shards."""
    schema = "shard string, name string, size long, sha256 string"

    def unpack(batches):
        import hashlib
        import io
        import tarfile

        import pyarrow as pa

        for b in batches:
            for file, content in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                rows = []
                with tarfile.open(fileobj=io.BytesIO(content.as_py())) as t:
                    for m in t:
                        if m.isfile():
                            data = t.extractfile(m).read()
                            rows.append((file, m.name, len(data), hashlib.sha256(data).hexdigest()))
                columns = list(zip(*rows, strict=True)) or [()] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.string(), pa.int64(), pa.string()), strict=True)], names=["shard", "name", "size", "sha256"])

    return spark.read.format("binaryFile").option("pathGlobFilter", "*.tar").load(path).select("path", "content").mapInArrow(unpack, schema)


def tar_shards(members: DataFrame, shard: str, name: str, content: str) -> DataFrame:
    """(shard, content) of one deterministic tar per shard: members in order of name, fixed headers.

    A shard's members are held together, so shards must be bounded before, as ``bounded_shards`` bounds them.
    """
    def pack(pdf):
        import io
        import tarfile

        import pandas as pd

        out = io.BytesIO()
        with tarfile.open(fileobj=out, mode="w", format=tarfile.USTAR_FORMAT) as t:
            for n, data in pdf.sort_values("name")[["name", "content"]].itertuples(index=False):
                info = tarfile.TarInfo(n)
                info.size, info.mode, info.mtime = len(data), 0o644, 0
                t.addfile(info, io.BytesIO(data))
        return pd.DataFrame({"shard": [pdf["shard"].iloc[0]], "content": [out.getvalue()]})

    rows = members.select(F.col(shard).cast("int").alias("shard"), F.col(name).alias("name"), F.col(content).cast("binary").alias("content"))
    return rows.groupBy("shard").applyInPandas(pack, "shard int, content binary")


def write_records(df: DataFrame, path: str, order: list[str], record: Column | None = None) -> None:
    """JSON lines in order; refuses to overwrite."""
    rows = df.orderBy(*order)
    (rows.select(record) if record is not None else rows).write.mode("errorifexists").json(path)


def sse_events(df: DataFrame, key: str, body: str) -> DataFrame:
    """Events of saved response streams: data lines joined per block, whatever the line ends, up to ``[DONE]``.

    One row per event, in order: key, event_no, data.
    """
    text = F.regexp_replace(F.coalesce(body, F.lit("")), "\r\n|\r", "\n")
    blocks = F.transform(F.split(text, "\n\n+"), lambda b: F.filter(F.split(b, "\n"), lambda x: x.startswith("data:")))
    data = F.filter(F.transform(blocks, lambda ls: F.array_join(F.transform(ls, lambda x: F.regexp_replace(x, "^data: ?", "")), "\n")), lambda d: d != "")
    whole = F.when(F.array_position(data, "[DONE]") > 0, F.slice(data, 1, F.greatest(F.lit(1), F.array_position(data, "[DONE]").cast("int")))).otherwise(data)
    return df.select(key, F.posexplode(whole).alias("event_no", "data")).filter(F.col("data") != "[DONE]")


def publish(parts: dict[str, DataFrame], target: str, options: dict[str, str]) -> bool:
    """Write the parts as JSON lines and let them appear at once: staging folder first, then a rename.

    Returns whether anything was written. A target published with the same options stays as it is; with others it is refused.
    """
    import json

    spark = next(iter(parts.values())).sparkSession
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(target)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    wanted = json.dumps(options, sort_keys=True)
    if fs.exists(path):
        had = spark.read.text(f"{target}/options").first()
        if had is None or had[0] != wanted:
            raise FileExistsError(f"{target} was published with other options")
        return False
    staging = jvm.org.apache.hadoop.fs.Path(f"{target}.staging")
    fs.delete(staging, True)
    for name, df in parts.items():
        df.write.json(f"{target}.staging/{name}")
    spark.createDataFrame([(wanted,)], "value string").coalesce(1).write.text(f"{target}.staging/options")
    if not fs.rename(staging, path):
        raise OSError(f"{target} could not be published")
    return True
