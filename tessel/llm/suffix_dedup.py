"""Removing repeated byte strings by longest-previous-factor arrays, kept to the suffixes that can repeat.

In the suffix array of all texts, the suffixes that share their first ``length`` bytes are neighbours, and such a suffix has a
longest previous factor (LPF) of ``length`` or more exactly if it isn't the first of them by position. A suffix array of the
whole corpus is never built; the order is needed only among suffixes that may share so many bytes, and those are found so:

1. Each text's windows of ``length`` bytes are put in runs that share an anchor, the block of least hash inside the window.
   Equal windows have equal anchors at equal distances. Anchors are counted over all texts; most occur once, and their windows
   are unique.
2. Runs of one anchor that cover the same bytes are aggregated before anything is sent: all but the first by position repeat
   whole, and only the first goes on.
3. What is left of an anchor goes to one group as bytes. There its suffixes are sorted, LCPs taken between neighbours, and the
   previous and next smaller positions give the LPF array (``suffix_order``).
4. An anchor with more than ``group_runs`` different covers is cut up first: its windows by their distance from the anchor, and
   the ranges by the core of bytes that all windows of the range share. Ranges that are still too many are cut again, at last
   into single windows, whose counts settle them. So no group grows with the corpus, and what repeats is aggregated each time.

Texts that occur more than once take part once, with their count. Hashes have 64 bits each for anchor, core and cover.

A kind of window counts bytes or words. With words, what goes are repeats of so many words, white space between them included,
however long the words are (see ``word_windows``).

``keep`` says what goes: "none" removes every byte covered by a string that also starts anywhere else; "first" keeps the
occurrence that comes first by (id, start), a string that overlaps its own copy keeping its first period.

Defined cases: a null or short text is kept as it is; repeated rows are copies of each other, of which "first" keeps one;
rows with equal ids and different texts are ordered by a hash of the text; very long texts are sliced; texts that are not
ASCII are treated as bytes; an empty table gives no rows; columns other than the two named are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from tessel.llm import suffix_order, windows, word_windows
from tessel.llm.arrow import named, slices, table
from tessel.plans.stages import BROADCAST_BYTES, forgotten, sized, written

LENGTH = 400
BLOCK = 200
#: A passage has more than 50 words.
PASSAGE_WORDS = 51
#: Different covers of an anchor that are sorted together.
GROUP_RUNS = 512
#: Rows that a task holds before it sends them on.
HELD = 4096

NO_ID = -(1 << 63)

RUNS = "doc_id long, raw long, anchor long, content long, start long, n long, lead long, weight long"
COVERS = "anchor long, doc_id long, raw long, start long, n long, cover binary"
SPANS = "doc_id long, raw long, start long, n long"


class Kind(NamedTuple):
    """Windows of ``length`` positions with anchors of ``block``; positions are bytes or words."""

    length: int = LENGTH
    block: int = BLOCK
    words: bool = False

    @property
    def least_bytes(self) -> int:
        return 2 * self.length - 1 if self.words else self.length

    def view(self, text: bytes) -> tuple[bytes, tuple[np.ndarray, np.ndarray] | None]:
        """The text that windows are taken from, and the edges of its positions unless they are bytes."""
        if not self.words:
            return text, None
        seen, begin, end = word_windows.view(text)
        return seen, (begin, end)

    def widths(self) -> list[int]:
        """Ranges of distances from the anchor in which a hot anchor's windows are cut, ever narrower."""
        out = [self.length - self.block + 1]
        while out[-1] > 1:
            out.append(-(-out[-1] // 8))
        return out[1:]


def runs(docs: DataFrame, kind: Kind) -> DataFrame:
    """The runs of all texts (doc_id, raw, text, weight), as in ``RUNS``."""
    of = (word_windows if kind.words else windows).window_runs

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, 2):
                text, start, n, anchor, content, lead = of([v.as_py().encode() for v in b.column(2)], kind.length, kind.block)
                row = pa.array(text)
                yield table([b.column(0).take(row), b.column(1).take(row), anchor, content, start, n, lead, b.column(3).take(row)], RUNS)

    return docs.select("doc_id", "raw", "text", "weight").mapInArrow(work, RUNS)


def _by_text(spans: DataFrame, docs: DataFrame) -> DataFrame:
    """``docs`` with the lists of their spans; the lists are sent whole only if they measure up to the limit."""
    lists = spans.groupBy("doc_id", "raw").agg(F.collect_list(F.struct(*[c for c in spans.columns if c not in ("doc_id", "raw")])).alias("spans"))
    rows = spans.count()
    return docs.join(F.broadcast(lists) if rows * 64 <= BROADCAST_BYTES else lists, ["doc_id", "raw"]).select("doc_id", "raw", "text", "spans")


def _pieces(hot: DataFrame, docs: DataFrame, kind: Kind, width: int) -> DataFrame:
    """The runs of anchors with too many covers, cut into ranges of ``width`` distances, as in ``RUNS``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, 2):
                out: list[tuple[int, ...]] = []
                for doc_id, raw, text, spans in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), b.column(3), strict=True):
                    seen, edges = kind.view(text.as_py().encode())
                    for run in spans.as_py():
                        out += [(doc_id, raw, *piece, run["weight"]) for piece in windows.pieces(seen, edges, run, kind.length, width)]
                        if len(out) >= HELD:
                            yield table(list(zip(*out, strict=True)), RUNS)
                            out = []
                if out:
                    yield table(list(zip(*out, strict=True)), RUNS)

    return _by_text(hot, docs).mapInArrow(work, RUNS)


def _covers(mixed: DataFrame, docs: DataFrame, kind: Kind) -> DataFrame:
    """One row per run: its anchor, its place and the bytes that its windows cover."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, 2):
                out: list[tuple] = []
                for doc_id, raw, text, spans in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), b.column(3), strict=True):
                    seen, edges = kind.view(text.as_py().encode())
                    for run in spans.as_py():
                        first, last = run["start"], run["start"] + run["n"] + kind.length - 2
                        a, z = (int(edges[0][first]), int(edges[1][last])) if edges else (first, last + 1)
                        out.append((run["anchor"], doc_id, raw, first, run["n"], seen[a:z]))
                        if len(out) >= HELD:
                            yield table(list(zip(*out, strict=True)), COVERS)
                            out = []
                if out:
                    yield table(list(zip(*out, strict=True)), COVERS)

    return _by_text(mixed, docs).mapInArrow(work, COVERS)


def _by_suffixes(covers: DataFrame, kind: Kind, keep: str) -> DataFrame:
    """Spans of window starts to remove, from the LPF array of each anchor's suffixes."""

    def found(rows: list[tuple]) -> Iterator[tuple[int, int, int, int]]:
        starts, ends = [], []
        for _, _, _, n, cover in rows:
            if kind.words:
                begin, end = word_windows.word_edges(cover)
                starts.append(begin[:n])
                ends.append(end[kind.length - 1 : kind.length - 1 + n])
            else:
                starts.append(np.arange(n))
                ends.append(np.arange(n) + kind.length)
        again = suffix_order.repeated([r[4] for r in rows], starts, ends, keep, kind.words)
        for (doc_id, raw, start, _, _), hit in zip(rows, again, strict=True):
            edges = np.flatnonzero(np.diff(np.concatenate(([False], hit, [False])).astype(np.int8))).tolist()
            yield from ((doc_id, raw, start + a, z - a) for a, z in zip(edges[::2], edges[1::2], strict=True))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows, out = None, [], []
        for whole in batches:
            for b in slices(whole, 5):
                for anchor, *row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    if anchor != now:
                        out += found(rows) if len(rows) > 1 else ()
                        now, rows = anchor, []
                        if len(out) >= HELD:
                            yield table(list(zip(*out, strict=True)), SPANS)
                            out = []
                    if not rows or rows[-1][:3] != row[:3]:  # a row that came twice is no copy of itself
                        rows.append(row)
        out += found(rows) if len(rows) > 1 else ()
        if out:
            yield table(list(zip(*out, strict=True)), SPANS)

    tasks = int(covers.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # sorting costs more than its bytes tell
    return covers.repartition(tasks, "anchor").sortWithinPartitions("anchor", "doc_id", "raw", "start").mapInArrow(work, SPANS)


def _spans_of(docs: DataFrame, once: DataFrame, kind: Kind, keep: str, group_runs: float) -> DataFrame:
    """Spans of window starts to remove in ``docs`` (doc_id, raw, text) by one kind of window, written.

    ``once`` are the same with one row a text and its weight. Later steps find their texts by (doc_id, raw) in ``docs``; rows that
    agree in both have a weight above one already, so that meeting them again changes nothing.
    """
    made = written(runs(once, kind), "runs")
    shared = written(made.groupBy("anchor").count().filter("count > 1").select("anchor"), "anchors")
    now = written(made.join(sized(shared, 16), "anchor"), "shared")
    forgotten([made, shared])
    used = [now]
    place = F.struct("doc_id", "raw", "start")
    parts = []
    for width in [*kind.widths(), None]:
        contents = written(now.groupBy("anchor", "content").agg(F.min(F.struct("doc_id", "raw", "start", "n", "lead")).alias("first"), F.sum("weight").alias("weight")), "contents")
        used.append(contents)
        many = contents.filter("weight > 1").select("anchor", "content", F.struct("first.doc_id", "first.raw", "first.start").alias("first"))
        whole = now.join(sized(many, 48), ["anchor", "content"])
        parts.append((whole if keep == "none" else whole.filter(place != F.col("first"))).select("doc_id", "raw", "start", "n"))
        if width is None:
            break
        varied = written(contents.groupBy("anchor").agg(F.count("*").alias("covers")).filter("covers > 1"), "varied")
        mixed = written(contents.join(sized(varied, 24), "anchor").select("first.*", "anchor", "weight", "covers"), "mixed")
        used += [varied, mixed]
        parts.append(_by_suffixes(_covers(mixed.filter(F.col("covers") <= group_runs).select("doc_id", "raw", "start", "n", "anchor"), docs, kind), kind, keep))
        hot = mixed.filter(F.col("covers") > group_runs).drop("covers")
        if hot.isEmpty():
            break
        now = written(_pieces(hot, docs, kind, width), "pieces")
        used.append(now)
    spans = parts[0]
    for part in parts[1:]:
        spans = spans.unionByName(part)
    spans = written(spans, "spans")
    forgotten(used)
    return spans


def _copies(docs: DataFrame) -> DataFrame:
    """Texts that occur more than once: raw, size, copies, first_id."""
    counted = docs.select("doc_id", "raw", F.octet_length("text").alias("size")).groupBy("raw", "size").agg(F.count("*").alias("copies"), F.min("doc_id").alias("first_id"))
    return written(counted.filter("copies > 1"), "copies")


def keyed(df: DataFrame, key: str, text: str) -> DataFrame:
    """``df`` as (doc_id, raw, text), a null id being NO_ID so that joins find it."""
    out = df.select(F.coalesce(F.col(key).cast("long"), F.lit(NO_ID)).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return out.select("doc_id", F.xxhash64("text").alias("raw"), "text")


def repeated_spans(docs: DataFrame, kinds: list[Kind], keep: str = "none", group_runs: float = GROUP_RUNS) -> tuple[DataFrame, DataFrame]:
    """(spans of window starts to remove in ``docs`` (doc_id, raw, text) by kind, texts that occur more than once).

    Spans leave out those texts' further copies, whose windows all repeat the first copy's.
    """
    if keep not in ("none", "first"):
        raise ValueError(keep)
    docs = docs.filter(F.octet_length("text") >= min(k.least_bytes for k in kinds))
    copies = _copies(docs)
    seen = sized(copies.select("raw", "first_id", "copies"), 32)
    once = docs.join(seen, "raw", "left").filter("copies IS NULL OR doc_id = first_id").withColumn("weight", F.coalesce("copies", F.lit(1)))
    spans = None
    for number, kind in enumerate(kinds):
        own = _spans_of(docs, once, kind, keep, group_runs).withColumn("kind", F.lit(number))
        spans = own if spans is None else spans.unionByName(own)
    return spans, copies


def merged(starts: list[int], sizes: list[int], length: int) -> list[tuple[int, int]]:
    """Maximal removed ranges of the windows at ``starts[i] .. starts[i] + sizes[i] - 1``."""
    out: list[list[int]] = []
    for a, n in sorted(zip(starts, sizes, strict=True)):
        end = a + n - 1 + length
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([a, end])
    return [(a, b) for a, b in out]


def marked(df: DataFrame, key: str, text: str, kinds: list[Kind], keep: str = "none", group_runs: float = GROUP_RUNS) -> DataFrame:
    """``df`` with __spans (kind and window starts to remove, or null) and __whole (a copy of a text that occurs elsewhere).

    With "none" all rows of a text that occurs more than once are such copies, with "first" all but one of the least id. Names
    that begin with two underscores are reserved.
    """
    spans, copies = repeated_spans(keyed(df, key, text), kinds, keep, group_runs)
    lists = spans.groupBy(F.col("doc_id").alias("__id"), F.col("raw").alias("__raw")).agg(F.collect_list(F.struct("kind", "start", "n")).alias("__spans"))
    near = F.broadcast(lists) if spans.count() * 48 <= BROADCAST_BYTES else lists
    whole = F.coalesce(F.col(text), F.lit(""))
    out = df.withColumns({"__id": F.coalesce(F.col(key).cast("long"), F.lit(NO_ID)), "__raw": F.xxhash64(whole)}).join(near, ["__id", "__raw"], "left")
    repeated = copies.select(F.col("raw").alias("__raw"), F.col("size").alias("__size"), F.col("first_id").alias("__first"))
    out = out.join(sized(repeated, 40), "__raw", "left").withColumn("__whole", F.coalesce(F.octet_length(whole) == F.col("__size"), F.lit(False)))
    if keep == "first":
        out = _but_one(out)
    return out.drop("__size", "__first", "__nth")


def _but_one(out: DataFrame) -> DataFrame:
    """Spare one row of each repeated text: of those with the least id, the one numbered first."""
    own = F.col("__whole") & F.coalesce(F.col("__id") == F.col("__first"), F.lit(False))
    nth = F.row_number().over(W.partitionBy("__raw", "__id").orderBy("__raw"))  # copies with equal ids only
    both = out.filter(~own).withColumn("__nth", F.lit(2)).unionByName(out.filter(own).withColumn("__nth", nth))
    return both.withColumn("__whole", F.col("__whole") & (F.col("__nth") > 1))


def _ranges(content: bytes, spans: list[dict] | None, whole: bool, kind: Kind, number: int) -> list[tuple[int, int]]:
    """The byte ranges that one kind of window removes."""
    own = [s for s in spans or [] if s["kind"] == number]
    if not kind.words:
        return [(0, len(content))] if whole and len(content) >= kind.length else merged([s["start"] for s in own], [s["n"] for s in own], kind.length)
    if not own and not whole:
        return []
    begin, end = word_windows.word_edges(content)
    if whole:
        return [(0, len(content))] if len(begin) >= kind.length else []
    return [(int(begin[a]), int(end[b - 1])) for a, b in merged([s["start"] for s in own], [s["n"] for s in own], kind.length)]


def _kept(content: bytes, gone: list[tuple[int, int]]) -> bytes:
    """What is left of ``content`` without the ranges, which may overlap."""
    left, at = [], 0
    for a, z in sorted(gone):
        left.append(content[at : max(at, a)])
        at = max(at, z)
    left.append(content[at:])
    return b"".join(left)


def cut_report(df: DataFrame, key: str, text: str, keep: str = "none", length: int = LENGTH, block: int = BLOCK, words: bool = False, passage_words: int | None = None, group_runs: float = GROUP_RUNS) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    With ``passage_words``, also n_passages and n_passage_bytes: maximal runs of bytes inside repeated passages of so many words.
    Those are reported beside the removal, which goes by ``length`` alone.
    """
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    kinds = [Kind(length, block, words)]
    if passage_words:
        kinds.append(Kind(passage_words, passage_words // 2 + 1, True))
        schema += ", n_passages long, n_passage_bytes long"
    rows = marked(df.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")), "doc_id", "text", kinds, keep, group_runs)
    none = F.lit(0).cast("long")
    passages = [none.alias(c) for c in ("n_passages", "n_passage_bytes") if passage_words]
    plain = rows.filter("__spans IS NULL AND NOT __whole").select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), none.alias("n_removed"), none.alias("n_spans"), F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"), *passages)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in slices(batch, 1):
                out = []
                for doc_id, value, spans, whole in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                    content = value.as_py().encode()
                    gone, *more = (_ranges(content, spans, whole, kind, k) for k, kind in enumerate(kinds))
                    left = _kept(content, gone)
                    out.append((doc_id, len(content), len(content) - len(left), len(gone), hashlib.sha256(left).hexdigest(), *(x for p in more for x in (len(p), sum(z - a for a, z in p)))))
                yield table(list(zip(*out, strict=True)), schema)

    return plain.unionByName(rows.filter("__spans IS NOT NULL OR __whole").select("doc_id", "text", "__spans", "__whole").mapInArrow(work, schema))


def without_repeats(df: DataFrame, key: str, text: str, keep: str = "first", length: int = LENGTH, block: int = BLOCK, words: bool = False, passage_words: int | None = None, group_runs: float = GROUP_RUNS) -> DataFrame:
    """``df`` with the repeated bytes cut out of ``text``; characters cut in two go whole. Other columns stay.

    With ``passage_words``, repeated passages of so many words go too, whatever their length in bytes.
    """
    kinds = [Kind(length, block, words)]
    if passage_words:
        kinds.append(Kind(passage_words, passage_words // 2 + 1, True))

    @F.pandas_udf("string")
    def cut(texts: pd.Series, spans: pd.Series, whole: pd.Series) -> pd.Series:
        left = []
        for t, s, w in zip(texts, spans, whole, strict=True):
            content = (t or "").encode()
            gone = [r for k, kind in enumerate(kinds) for r in _ranges(content, None if s is None else list(s), w, kind, k)]
            left.append(_kept(content, gone).decode(errors="ignore"))
        return pd.Series(left, dtype=object)

    rows = marked(df, key, text, kinds, keep, group_runs)
    same = rows.filter("__spans IS NULL AND NOT __whole").select(*named(df))
    return same.unionByName(rows.filter("__spans IS NOT NULL OR __whole").withColumn(text, cut(text, "__spans", "__whole")).select(*named(df)))
