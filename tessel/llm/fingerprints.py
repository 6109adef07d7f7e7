"""Canonical exact document fingerprints.

The canonical form of a text is NFKC, case-folded, with white space folded to single blanks. Its digest is xxh3-128.
Documents are grouped by digest, and inside equal buckets the canonical bytes themselves are compared: texts of one bucket
that differ get an ordinal behind the digest, so that two fingerprints are equal exactly if the canonical texts are.
Only texts of buckets with two or more members travel for that comparison, and copies are merged before they do.

Defined cases: a null text is an empty one; empty texts are equal; very long texts are digested whole; repeated rows and
rows with equal ids are kept each, ordered by a hash of the text; null ids come last; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import hashlib
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window as W, functions as F

from tessel.plans.stages import sized, written

FULL_BITS = 128


def canonical(text: str) -> bytes:
    """NFKC, case folding, NFKC again (folding can undo it), white space to single blanks, none at the ends."""
    if not text.isascii():
        text = unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", text).casefold())
    else:
        text = text.lower()
    return " ".join(text.split()).encode()


def digest(content: bytes, bits: int = FULL_BITS) -> str:
    """Hexadecimal xxh3-128, or its upper ``bits`` (fewer only to provoke collisions in tests)."""
    return f"{xxhash.xxh3_128_intdigest(content) >> (FULL_BITS - bits):0{(bits + 3) // 4}x}"


def edited(text: str, following: str) -> str:
    """The last third of ``text`` (rounded down) replaced by as many first characters of ``following``, or all of them."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


ROW = "kind int, part int, doc_id long, raw long, next_id long, next_raw long, n_chars long, edited_sha256 string, digest string, edited_digest string, near_edited double, near_next double, text string"
FIELDS = [x.split() for x in ROW.split(", ")]
KINDS = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "double": pa.float64()}
DONE, LAST, HEAD = 0, 1, 2


def _pair(doc_id, raw, text: str, own: bytes, next_id, next_raw, following: str, then: bytes, part: int, bits: int) -> tuple:
    new = edited(text, following)
    new_own = own if new == text else canonical(new)
    return (DONE, part, doc_id, raw, next_id, next_raw, len(text), hashlib.sha256(new.encode()).hexdigest(), digest(own, bits), digest(new_own, bits), float(own == new_own), float(own == then), None)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(FIELDS)
    return pa.RecordBatch.from_arrays([pa.array(c, KINDS[k]) for c, (_, k) in zip(columns, FIELDS, strict=True)], names=[n for n, _ in FIELDS])


def with_next(docs: DataFrame, bits: int = FULL_BITS) -> DataFrame:
    """Digests of every document (doc_id, raw, text) and of its edit by the next one, in descending order of doc_id.

    Rows are range-partitioned and sorted; a partition's last document meets the head of the next partition afterwards, in a
    table with one row per partition.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        part = context.partitionId() if context else 0
        before = None
        for b in batches:
            out = []
            for doc_id, raw, value in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                text = value.as_py()
                own = canonical(text)
                if before is None:
                    out.append((HEAD, part, doc_id, raw, *[None] * 8, text))
                else:
                    out.append(_pair(*before, doc_id, raw, text, own, part, bits))
                before = doc_id, raw, text, own
            yield _batch(out)
        if before is not None:
            yield _batch([(LAST, part, before[0], before[1], *[None] * 8, before[2])])

    rows = written(docs.repartitionByRange(F.col("doc_id").desc_nulls_last()).sortWithinPartitions(F.col("doc_id").desc_nulls_last(), "raw", "text").mapInArrow(work, ROW), "pairs")

    by_part = W.orderBy("part")  # one head and one last row for each partition
    heads = rows.filter(F.col("kind") == HEAD).select("part", F.struct(F.col("doc_id").alias("next_id"), F.col("raw").alias("next_raw"), F.col("text").alias("following")).alias("head"))
    nexts = heads.select("part", F.coalesce(F.lead("head").over(by_part), F.first("head").over(by_part.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))).alias("head"))
    ends = rows.filter(F.col("kind") == LAST).select("part", "doc_id", "raw", "text").join(nexts, "part").select("part", "doc_id", "raw", "text", "head.*")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield _batch([_pair(r["doc_id"], r["raw"], r["text"], canonical(r["text"]), r["next_id"], r["next_raw"], r["following"], canonical(r["following"]), r["part"], bits) for r in b.to_pylist()])

    return rows.filter(F.col("kind") == DONE).unionByName(ends.mapInArrow(finish, ROW)).drop("kind", "part", "text")


def _canonical_udf(bits: int):
    @F.pandas_udf("digest string, content binary")
    def made(text, following):  # noqa: ANN001, ANN202
        import pandas as pd

        whole = [canonical(t if f is None else edited(t, f)) for t, f in zip(text, following, strict=True)]
        return pd.DataFrame({"digest": [digest(x, bits) for x in whole], "content": whole})

    return made


def compared(pairs: DataFrame, docs: DataFrame, bits: int = FULL_BITS) -> DataFrame:
    """Texts of shared buckets, compared byte by byte: (digest, content, ordinal, who) for buckets with differing contents.

    ``pairs`` are the written rows of ``with_next``. Usually empty.
    """
    both = pairs.select(F.explode(F.array("digest", "edited_digest")).alias("digest"))
    shared = written(both.groupBy("digest").count().filter("count > 1").select("digest"), "shared")
    few = sized(shared, 64)
    own = pairs.select("digest", "doc_id", "raw", F.lit(None).cast("long").alias("next_id"), F.lit(None).cast("long").alias("next_raw"), F.lit(False).alias("is_edit"))
    new = pairs.select(F.col("edited_digest").alias("digest"), "doc_id", "raw", "next_id", "next_raw", F.lit(True).alias("is_edit"))
    who = written(own.unionByName(new).join(few, "digest", "left_semi"), "members")
    wanted = written(who.select("doc_id", "raw").union(who.filter("is_edit").select("next_id", "next_raw")).dropDuplicates(), "wanted")
    texts = docs.join(sized(wanted, 48), [docs.doc_id.eqNullSafe(wanted.doc_id), docs.raw == wanted.raw], "left_semi").dropDuplicates(["doc_id", "raw"])
    a, b = texts.alias("a"), texts.alias("b")
    members = who.alias("w")
    at = lambda t, i, r: F.col(f"{t}.doc_id").eqNullSafe(F.col(f"w.{i}")) & (F.col(f"{t}.raw") == F.col(f"w.{r}"))
    fields = ["w.digest", "w.doc_id", "w.raw", "w.next_id", "w.next_raw", "w.is_edit"]
    joined = members.filter("NOT is_edit").join(a, at("a", "doc_id", "raw")).select(*fields, F.col("a.text").alias("text"), F.lit(None).cast("string").alias("following")).unionByName(
        members.filter("is_edit").join(a, at("a", "doc_id", "raw")).join(b, at("b", "next_id", "next_raw")).select(*fields, F.col("a.text").alias("text"), F.col("b.text").alias("following"))
    )
    return joined.withColumn("c", _canonical_udf(bits)("text", "following")).select("digest", F.col("c.content").alias("content"), "doc_id", "raw", "next_id", "next_raw", "is_edit")


def fingerprints(df: DataFrame, key: str, text: str, bits: int = FULL_BITS) -> DataFrame:
    """One row per input row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    Likeness of two exact fingerprints is 1 where they are equal, else 0.
    """
    docs = df.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("raw", F.xxhash64("text")).select("doc_id", "raw", "text")
    pairs = written(with_next(docs, bits), "digests")
    contents = compared(pairs, docs, bits)
    variants = contents.groupBy("digest", "content").count()  # compares bytes; copies merge before the shuffle
    mixed = written(variants.withColumn("n", F.count("*").over(W.partitionBy("digest"))).filter("n > 1").select("digest", "content", F.row_number().over(W.partitionBy("digest").orderBy("content")).alias("ordinal")), "mixed")
    out = pairs.withColumns({"fingerprint": F.col("digest"), "edited_fingerprint": F.col("edited_digest")})
    if not mixed.isEmpty():
        named = written(contents.join(mixed, ["digest", "content"]).select("doc_id", "raw", "next_id", "next_raw", "is_edit", "ordinal").dropDuplicates(), "named")
        for edit, name in ((False, "fingerprint"), (True, "edited_fingerprint")):
            n = named.filter(F.col("is_edit") == edit).alias("n")
            o = out.alias("o")
            on = F.col("o.doc_id").eqNullSafe(F.col("n.doc_id")) & (F.col("o.raw") == F.col("n.raw"))
            if edit:
                on &= F.col("o.next_id").eqNullSafe(F.col("n.next_id")) & (F.col("o.next_raw") == F.col("n.next_raw"))
            out = o.join(n, on, "left").select("o.*", "n.ordinal").withColumn(name, F.when(F.col("ordinal").isNull(), F.col(name)).otherwise(F.concat_ws("-", name, "ordinal"))).drop("ordinal")
    return out.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
