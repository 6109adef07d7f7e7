"""Exact n-gram Jaccard self-join with set-relation skipping, as classes of linked documents.

Sets are hashed word shingles. Equal sets are one set from the start. The others are joined by prefix lists: under one global
order of the shingles, two sets that are alike share a shingle in their first ``n - ceil(t n) + 1``. The order puts shingles
that many sets hold last, so that lists stay short.

Skipping in lists: a set of size n with a list's shingle at place p can share at most n - p shingles from there on, and so has
a largest partner, its cap (``caps``). Lists are sorted by size; members whose cap is below the list's least size, and blocks
whose caps end before another block's sizes begin, are skipped by their positions. A linked pair's first common shingle always
passes.

Answers from answers: each set is first compared with one pivot, the most typical set that its lists show. The pivot's answer
(overlap, and the shingles by which the two differ) is kept. Links make classes; pairs inside a class need no answer of their
own. For a pair whose sets have the same pivot, the answer is derived from the two kept ones: bounds on the overlap come from
the counts alone, and the exact overlap from the differences, without reading either set. What remains, and what sketches of the
sets leave possible, is compared in full, first the pair of another class with which a set shares most. No candidate is left out,
so that no link between classes is lost.

Pivot votes are one row per list entry. Sets that share half of their union with a pivot form a group with it; inside a group,
sketches of the sets are compared in blocks, and only what they leave possible becomes a pair. Lists make pairs of different groups
only, of entries that pass the caps. Groups and long lists are dealt out in chunks of bounded size, the largest class once each.

Defined cases: a null or blank text has no set and is alone in its class; a text shorter than a shingle has its whole word
sequence as one; very long texts are cut nowhere; repeated rows and equal ids fall into one class if their sets are alike;
null ids sort last; an empty table gives no rows; columns other than the two named are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tessel.llm.arrow import named, slices, table
from tessel.llm.windows import PLACE_BITS, Hashes, mixed
from tessel.operators.graph import connected_components
from tessel.plans.stages import forgotten, sized, written

WORDS = 5
#: Likeness as a percentage of the union.
PERCENT = 80
#: A shingle of so many sets within one batch, and of so many over all, is ordered behind those of fewer. This and the bound
#: on how many shingles are ordered so change what is compared, never the result.
COMMON_IN_BATCH, COMMON, MOST_COMMON = 8, 32, 1 << 20
#: Comparisons with one pivot that go to one task together.
GROUP_PAIRS = 128
#: Lists of up to so many members are compared together, longer ones each by itself.
SHORT_LIST = 12
#: Members of a list that are compared as one block, and that go to one task as one chunk.
LIST_BLOCK, CHUNK = 1024, 4096
#: Likeness (percent of the union) from which a kept answer holds the differences too.
KEPT_PERCENT = 50
#: Keys by which a task knows the sets that it has sent; beyond that it forgets them, and copies are dropped later.
REMEMBERED = 1 << 16
NO_ID = -(1 << 63)

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    solid = np.concatenate(([False], ~_SPACE[data], [False]))
    edges = np.flatnonzero(solid[1:] != solid[:-1])
    return edges[0::2], edges[1::2]


def _word(word: bytes) -> int:
    """The same hash as in ``_parts`` for any word that fits in a chunk."""
    if len(word) >= 1 << PLACE_BITS:
        return xxhash.xxh3_64_intdigest(word)
    return int(Hashes(np.frombuffer(word, np.uint8), 4).of(np.array([0]), np.array([len(word)]))[0])


def _parts(text: bytes, size: int) -> Iterator[np.ndarray]:
    """Word hashes of a text of any length, in parts cut between words."""
    at = 0
    while at < len(text):
        end = min(len(text), at + size)
        while end < len(text) and not _SPACE[text[end]]:
            end += 1
        if end - at >= 1 << PLACE_BITS:  # a huge word is among them
            yield np.array([_word(w) for w in text[at:end].split()], np.uint64)
        else:
            data = np.frombuffer(text, np.uint8, end - at, at)
            begin, stop = _words(data)
            yield Hashes(data, 4).of(begin, stop)
        at = end


def _word_hashes(texts: list[bytes], size: int = 1 << 18) -> Iterator[tuple[np.ndarray, list[int]]]:
    """(word hashes of some texts in a row, number of words of each); short texts are hashed together."""
    held: list[bytes] = []

    def together() -> tuple[np.ndarray, list[int]]:
        data = np.frombuffer(b" ".join(held), np.uint8)
        begin, stop = _words(data)
        ends = np.cumsum([len(x) + 1 for x in held])
        return Hashes(data, 4).of(begin, stop), np.diff(np.searchsorted(begin, ends), prepend=0).tolist()

    for text in texts:
        if held and sum(map(len, held)) + len(held) + len(text) > size:
            yield together()
            held = []
        if len(text) > size:
            parts = list(_parts(text, size))
            w = np.concatenate(parts)
            yield w, [len(w)]
        else:
            held.append(text)
    if held:
        yield together()


def shingle_sets(texts: list[str | None], words: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    factors = mixed(np.arange(11, 11 + words, dtype=np.uint64)) | np.uint64(1)
    out = []
    for w, counts in _word_hashes([(t or "").encode().lower() for t in texts]):  # lower of bytes: A-Z alone
        runs = max(0, len(w) - words + 1)
        h = w[:runs] * factors[0]
        for k in range(1, words):
            h += w[k : runs + k] * factors[k]
        h = mixed(h)
        at = 0
        for n in counts:
            if n >= words:
                s = np.sort(h[at : at + n - words + 1])
                out.append(s[np.append(True, s[1:] != s[:-1])])
            elif n:
                out.append(mixed(np.array([(w[at : at + n] * factors[:n]).sum(dtype=np.uint64) + np.uint64(n)], np.uint64)))
            else:
                out.append(w[:0])
            at += n
    return out


def set_key(s: np.ndarray) -> int:
    return int(np.array([xxhash.xxh3_64_intdigest(s.tobytes(), len(s))], np.uint64).view(np.int64)[0])


def needed(n: np.ndarray | int, percent: int) -> np.ndarray | int:
    """Least overlap of a set of size n with any set alike."""
    return -(-n * percent // 100)


def caps(size: np.ndarray, pos: np.ndarray, percent: int) -> np.ndarray:
    """The largest size of a set with which one can be alike if their first common shingle lies at ``pos``."""
    return ((100 + percent) * (size - pos) - percent * size) // percent


def sketch(s: np.ndarray) -> np.ndarray:
    """The parities of how many members fall on each of 2 n to 4 n bits, as 64-bit words.

    Where two sketches differ, so do the sets: they have at least so many members that are not common. A sketch of twice as
    many words is made as short as the other by adding its halves.
    """
    bits = 64 << max(0, int(len(s) - 1).bit_length() - 5)
    odd = (np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view(np.int64)


def survey(docs: DataFrame, words: int) -> DataFrame:
    """(kind 0: doc_id, key, size, sketch) for each row, and (kind 1: key, size) for shingles with their counts in a batch."""
    schema = "kind int, doc_id long, key long, size long, sketch array<long>"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            held: dict[int, np.ndarray] = {}
            for b in slices(whole, 1):
                sets = shingle_sets(b.column(1).to_pylist(), words)
                keys = [set_key(s) if len(s) else None for s in sets]
                yield table([[0] * len(sets), b.column(0), keys, [len(s) for s in sets], [sketch(s) if len(s) else None for s in sets]], schema)
                held |= {k: s for k, s in zip(keys, sets, strict=True) if k is not None}
                if b.slice(len(b) - 1).equals(whole.slice(len(whole) - 1)) or sum(map(len, held.values())) > 1 << 20:
                    shingle, count = np.unique(np.concatenate([*held.values(), np.zeros(0, np.uint64)]), return_counts=True)
                    many = count >= COMMON_IN_BATCH
                    yield table([np.ones(many.sum(), np.int32), pa.nulls(int(many.sum()), pa.int64()), shingle[many].view(np.int64), count[many], pa.nulls(int(many.sum()), pa.list_(pa.int64()))], schema)
                    held = {}

    return docs.select("doc_id", "text").mapInArrow(work, schema)


ENTRIES = "token long, part int, size int, key long, pos int"


def prefixes(docs: DataFrame, common: tuple[np.ndarray, np.ndarray, np.ndarray], words: int, percent: int) -> DataFrame:
    """List entries of each distinct set, as in ``ENTRIES``; a set may come more than once.

    A list that is known to be long is dealt out in parts, numbered from 1; the others have part 0.
    """
    shared = docs.sparkSession.sparkContext.broadcast(common)  # bounded by MOST_COMMON

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, ranks, parts = shared.value
        seen: set[int] = set()
        for whole in batches:
            for b in slices(whole, 1):
                out: list[tuple[np.ndarray, ...]] = []
                for s in shingle_sets(b.column(1).to_pylist(), words):
                    if not len(s) or (key := set_key(s)) in seen:
                        continue
                    if len(seen) > REMEMBERED:
                        seen.clear()
                    seen.add(key)
                    order, part = s >> np.uint64(1), np.zeros(len(s), np.int32)
                    if len(tokens):
                        at = np.minimum(np.searchsorted(tokens, s), len(tokens) - 1)
                        known = tokens[at] == s
                        order = np.where(known, ranks[at], order)
                        part = np.where(known & (parts[at] > 1), 1 + key % parts[at], 0).astype(np.int32)
                    n = len(s) - needed(len(s), percent) + 1
                    first = np.argsort(order, kind="stable")[:n]
                    out.append((s[first], part[first], np.full(n, len(s), np.int32), np.full(n, key, np.int64), np.arange(n, dtype=np.int32)))
                if out:
                    token, part, size, key_, pos = (np.concatenate(x) for x in zip(*out, strict=True))
                    yield table([token.view(np.int64), part, size, key_, pos], ENTRIES)

    return docs.select("doc_id", "text").mapInArrow(work, ENTRIES)


def live_lists(entries: DataFrame) -> DataFrame:
    """Entries of lists with two sets or more, and of all lists in parts, each once."""
    names = [f.split()[0] for f in ENTRIES.split(", ")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: np.ndarray | None = None  # the last member of the list that may go on
        kind = np.dtype([(name, "i8") for name in [*names, "sent"]])
        for b in batches:
            rows = np.zeros(len(b), kind)
            for name in names:
                rows[name] = b.column(b.schema.get_field_index(name)).to_numpy(zero_copy_only=False)
            if rest is not None:
                rows = np.concatenate([rest, rows])
            if not len(rows):
                continue
            same_list = (rows["token"][1:] == rows["token"][:-1]) & (rows["part"][1:] == rows["part"][:-1])
            copy = np.append(False, same_list & (rows["key"][1:] == rows["key"][:-1]))
            rows, same_list = rows[~copy], None
            new = np.append(True, (rows["token"][1:] != rows["token"][:-1]) | (rows["part"][1:] != rows["part"][:-1]))
            group = np.cumsum(new) - 1
            many = (np.bincount(group)[group] > 1) | (rows["part"] > 0)
            out = many & (rows["sent"] == 0)
            if out.any():
                yield table([rows["token"][out], *(rows[c][out].astype(np.int32) if c != "key" else rows[c][out] for c in names[1:])], ENTRIES)
            rest = rows[-1:].copy()  # a single member is sent when a second one comes
            rest["sent"] = many[-1]

    return entries.repartition("token", "part").sortWithinPartitions("token", "part", "size", "key").mapInArrow(work, ENTRIES)


def fitting_pairs(size: np.ndarray, cap: np.ndarray, label: np.ndarray, side: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (x, y), x before y, of a list's pairs in different classes that the caps allow; members come by size.

    Members of one side do not meet, but those of side -1 do. Blocks that cannot hold a pair are skipped by their sizes and caps.
    """
    edges = [(at, min(at + LIST_BLOCK, len(size))) for at in range(0, len(size), LIST_BLOCK)]
    highest = [cap[a:z].max() for a, z in edges]
    only = [label[a] if (label[a:z] == label[a]).all() else None for a, z in edges]
    for j, (a, z) in enumerate(edges):
        for i, (b, e) in enumerate(edges[: j + 1]):
            if highest[i] < size[a] or highest[j] < size[b] or (only[i] is not None and only[i] == only[j]):
                continue
            fit = (size[b:e, None] <= cap[a:z]) & (cap[b:e, None] >= size[a:z]) & (label[b:e, None] != label[a:z])
            fit &= (side[b:e, None] != side[a:z]) | (side[a:z] == -1)
            p, q = np.nonzero(np.triu(fit, 1) if i == j else fit)
            if len(p):
                yield p + b, q + a


PAIRS = "x long, y long, nx int, ny int"


def list_pairs(lists: DataFrame) -> DataFrame:
    """``PAIRS`` of different classes from lists (token, a, b, side, size, cap, key, label), once for each shared entry."""

    def made(rows: np.ndarray, x: np.ndarray, y: np.ndarray) -> pa.RecordBatch:
        size, key = rows[1], rows[3]
        turned = (size[x] == size[y]) & (key[x] > key[y])
        x, y = np.where(turned, y, x), np.where(turned, x, y)
        return table([key[x], key[y], size[x].astype(np.int32), size[y].astype(np.int32)], PAIRS)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: np.ndarray | None = None  # token, a, b and the members of the list that may go on; chunks bound it
        for last, b in _with_last(batches):
            if b is not None and len(b):
                rows = np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in b.columns])
                rest = rows if rest is None else np.concatenate([rest, rows], axis=1)
            if rest is None or not rest.shape[1]:
                continue
            begin = np.flatnonzero(np.append(True, (rest[:3, 1:] != rest[:3, :-1]).any(axis=0)))
            if not last:
                now, rest = rest[3:, : begin[-1]], rest[:, begin[-1] :]
                begin = begin[:-1]
            else:
                now, rest = rest[3:], None
            length = np.diff(np.append(begin, now.shape[1]))
            short = length <= SHORT_LIST
            group = np.repeat(np.where(short, np.arange(len(length)), -1), length)
            side, size, cap, _, label = now
            for k in range(1, SHORT_LIST):  # short lists all at once: members k places apart
                x = np.flatnonzero((group[k:] == group[:-k]) & (group[k:] >= 0))
                y = x + k
                fit = (size[x] <= cap[y]) & (size[y] <= cap[x]) & (label[x] != label[y]) & ((side[x] != side[y]) | (side[x] == -1))
                if fit.any():
                    yield made(now, x[fit], y[fit])
            for g in np.flatnonzero(~short).tolist():
                own = now[:, begin[g] : begin[g] + length[g]]
                for x, y in fitting_pairs(own[1], own[2], own[4], own[0]):
                    yield made(own, x, y)

    order = ["token", "a", "b", "size", "cap", "key"]
    return lists.repartition("token", "a", "b").sortWithinPartitions(*order).select("token", "a", "b", "side", "size", "cap", "key", "label").mapInArrow(work, PAIRS)


def _with_last(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, pa.RecordBatch | None]]:
    for b in batches:
        yield False, b
    yield True, None


def _folded(sketches: list[np.ndarray]) -> tuple[np.ndarray, dict[int, np.ndarray]]:
    """(words of each sketch, for each number of words the sketches of so many or more, folded to it, by place)."""
    width = np.array([len(x) for x in sketches])
    out: dict[int, np.ndarray] = {}
    longer: np.ndarray | None = None
    for w in sorted(set(width.tolist()), reverse=True):
        made = np.zeros((len(sketches), w), np.int64)
        if longer is not None:
            parts = longer.reshape(len(sketches), -1, w)
            made = np.bitwise_xor.reduce(parts, axis=1)
        own = np.flatnonzero(width == w)
        made[own] = np.stack([sketches[i] for i in own])
        out[w] = longer = made
    return width, out


def most_shared(size: np.ndarray, sketches: list[np.ndarray]) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """A function from places (x, y) to bounds on the overlap of these sets, by how far their sketches differ."""
    width, folded = _folded(sketches)

    def bound(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        least, apart = np.minimum(width[x], width[y]), np.zeros(len(x), np.int64)
        for w in np.unique(least).tolist():
            at = np.flatnonzero(least == w)
            step = max(1, (1 << 19) // w)
            for k in range(0, len(at), step):
                some = at[k : k + step]
                apart[some] = np.bitwise_count((folded[w][x[some]] ^ folded[w][y[some]]).view(np.uint64)).sum(axis=1, dtype=np.int64)
        return np.minimum((size[x] + size[y] - apart) // 2, np.minimum(size[x], size[y]))

    return bound


def group_pairs(members: DataFrame, percent: int, chunk: int = CHUNK) -> DataFrame:
    """``PAIRS`` of different classes inside groups that sketches leave possible, with the most that the two can share as c.

    ``members`` (token, size, key, pos 0, label, sketch) has each set of a group once. The pairs are compared in blocks inside
    tasks; a pair becomes a row only where its sketches allow a link, so that a large group of sets that are like one pivot but
    not linked to each other makes few rows. Chunks bound a task as in ``cross_pairs``.
    """
    schema = f"{PAIRS}, c long"

    def work(part: pa.Table) -> pa.Table:
        part = part.sort_by([("size", "ascending"), ("key", "ascending")])
        side, size, cap, key, label = (part.column(c).to_numpy().astype(np.int64) for c in ("side", "size", "cap", "key", "label"))
        bound = most_shared(size, [np.asarray(x.values) for x in part.column("sketch")])
        out = [(np.zeros(0, np.int64),) * 5]
        for x, y in fitting_pairs(size, cap, label, side):
            both = bound(x, y)
            able = (100 + percent) * both >= percent * (size[x] + size[y])
            out.append((key[x[able]], key[y[able]], size[x[able]], size[y[able]], both[able]))
        x, y, nx, ny, c = (np.concatenate(z) for z in zip(*out, strict=True))
        return pa.Table.from_batches([table([x, y, nx.astype(np.int32), ny.astype(np.int32), c], schema)])

    return dealt(members, percent, chunk, "sketch").groupBy("token", "a", "b").applyInArrow(work, schema)


def cross_pairs(known: DataFrame, percent: int, chunk: int = CHUNK) -> DataFrame:
    """Distinct ``PAIRS`` of sets in different classes that some list entry allows, with the number c of such entries."""
    return list_pairs(dealt(known, percent, chunk)).groupBy("x", "y", "nx", "ny").agg(F.count("*").alias("c"))


def dealt(known: DataFrame, percent: int, chunk: int, *more: str) -> DataFrame:
    """Members of lists (token, a, b, side, size, cap, key, label) for those that compare them.

    ``known`` are list entries with labels. Lists of one class, and members whose cap lies below the list's least size, go first.
    A list of more than ``chunk`` members is dealt out: those of its largest class by chunks, which the others all meet, and the
    others among themselves by pairs of chunks.
    """
    shown = ["size", "cap", "key", "label", *more]
    entries = known.withColumn("cap", _cap(percent))
    classes = entries.groupBy("token", "label").agg(F.count("*").alias("n"), F.min("size").alias("least"))
    lists = classes.groupBy("token").agg(F.sum("n").alias("n"), F.min("least").alias("least"), F.count("*").alias("labels"), F.max(F.struct("n", "label")).alias("main"))
    lists = written(lists.filter("labels > 1").select("token", "n", "least", F.col("main.label").alias("main"), F.col("main.n").alias("n_main")), "open")
    entries = entries.join(sized(lists, 40), "token").filter("cap >= least")
    plain = entries.filter(F.col("n") <= chunk).select("token", F.lit(0).alias("a"), F.lit(0).alias("b"), F.lit(-1).alias("side"), *shown)
    long_ = entries.filter(F.col("n") > chunk).withColumn("mains", F.ceil(F.col("n_main") / chunk).cast("int")).withColumn("others", F.greatest(F.lit(1), F.ceil((F.col("n") - F.col("n_main")) / chunk)).cast("int"))
    of_main = F.array(F.struct(F.lit(-1).alias("a"), F.pmod(F.xxhash64("key"), "mains").cast("int").alias("b"), F.lit(0).alias("side")))
    own = F.pmod(F.xxhash64("key"), "others").cast("int")
    meets = F.transform(F.sequence(F.lit(0), F.col("mains") - 1), lambda c: F.struct(F.lit(-1).alias("a"), c.alias("b"), F.lit(1).alias("side")))
    among = F.transform(F.sequence(F.lit(0), F.col("others") - 1), lambda c: F.struct(F.least(own, c).alias("a"), F.greatest(own, c).alias("b"), F.when(own == c, -1).otherwise(own).alias("side")))
    spread = long_.withColumn("to", F.explode(F.when(F.col("label") == F.col("main"), of_main).otherwise(F.concat(meets, among)))).select("token", "to.a", "to.b", "to.side", *shown)
    return plain.unionByName(spread)


def _cap(percent: int) -> Column:
    """``caps`` of list entries (size, pos)."""
    return F.floor(((100 + percent) * (F.col("size") - F.col("pos")) - percent * F.col("size")) / percent).cast("int")


class Answers:
    """Exact answers for pairs of sets, read again from the documents by one id for each set."""

    SCHEMA = "x long, y long, nx int, ny int, both int, added array<long>, missing array<long>"

    def __init__(self, docs: DataFrame, rows: DataFrame, words: int) -> None:
        self.docs, self.words = docs, words
        found = rows.filter("key IS NOT NULL").groupBy("key").agg(F.min(F.coalesce("doc_id", F.lit(NO_ID))).alias("id"), F.any_value("size").cast("int").alias("size"), F.any_value("sketch").alias("sketch"))
        self.where = written(found, "places")

    def possible(self, pairs: DataFrame, percent: int) -> DataFrame:
        """``pairs`` (x, y, nx, ny, ...) without those whose sketches differ too much for so high a likeness."""
        a, b = (self.where.select(F.col("key").alias(side), F.col("sketch").alias(f"s{side}")) for side in "xy")
        halves = lambda long_, short: F.zip_with(F.slice(long_, 1, F.size(short)), F.slice(long_, F.size(short) + 1, F.size(short)), lambda p, q: p.bitwiseXOR(q))
        x = F.when(F.size("sx") == 2 * F.size("sy"), halves(F.col("sx"), F.col("sy"))).otherwise(F.col("sx"))
        y = F.when(F.size("sy") == 2 * F.size("sx"), halves(F.col("sy"), F.col("sx"))).otherwise(F.col("sy"))
        apart = F.aggregate(F.zip_with("ax", "ay", lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda n, v: n + v)
        both = pairs.join(a, "x").join(b, "y").withColumn("ax", x).withColumn("ay", y).withColumn("apart", F.when(F.size("ax") == F.size("ay"), apart).otherwise(0))
        return both.filter((100 + percent) * F.floor((F.col("nx") + F.col("ny") - F.col("apart")) / 2) >= percent * (F.col("nx") + F.col("ny"))).select(*pairs.columns)

    def _sets(self, keys: DataFrame) -> DataFrame:
        """(key, content) of the wanted keys; a set comes once for each row that repeats its id and text."""
        ids = written(keys.distinct().join(self.where, "key"), "ids")
        texts = self.docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), "text").join(sized(ids, 32), "id").select("key", "text")
        words = self.words

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for b in slices(whole, 1):
                    sets = shingle_sets(b.column(1).to_pylist(), words)
                    own = [(k, s.tobytes()) for k, s in zip(b.column(0).to_pylist(), sets, strict=True) if len(s) and set_key(s) == k]
                    if own:
                        yield table(list(zip(*own, strict=True)), "key long, content binary")

        return texts.mapInArrow(work, "key long, content binary")

    def of(self, pairs: DataFrame, label: str, differences: bool = False) -> DataFrame:
        """``SCHEMA`` for the pairs (x, y), written. Pairs of one y are dealt out in groups of bounded size.

        With ``differences``, the shingles of x that y lacks and those of y that x lacks are kept where the two are similar.
        """
        pairs = written(pairs.select("x", "y"), "compare")
        if pairs.isEmpty():
            return self.docs.sparkSession.createDataFrame([], self.SCHEMA)
        groups = pairs.groupBy("y").agg(F.ceil(F.count("*") / GROUP_PAIRS).cast("int").alias("parts"))
        wanted = pairs.join(groups, "y").select(F.col("x").alias("key"), "y", F.pmod(F.xxhash64("x"), F.col("parts")).cast("int").alias("part"), F.lit(1).alias("kind"))
        pivots = groups.select(F.col("y").alias("key"), "y", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("kind"))
        wanted = written(wanted.unionByName(pivots), "wanted")
        sent = self._sets(wanted.select("key")).join(sized(wanted, 32), "key").select("y", "part", "kind", "key", "content")
        schema = self.SCHEMA

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            now, pivot, last = None, np.zeros(0, np.uint64), None
            for whole in batches:
                for b in slices(whole, 4):
                    out = []
                    for y, part, kind, key, content in zip(*(b.column(i).to_pylist() for i in range(4)), b.column(4), strict=True):
                        if kind == 0:
                            if now != (y, part):
                                now, pivot = (y, part), np.frombuffer(content.as_py(), np.uint64)
                        elif (now, key) != last:
                            last = now, key
                            own = np.frombuffer(content.as_py(), np.uint64)
                            shared = pivot[np.minimum(np.searchsorted(pivot, own), len(pivot) - 1)] == own
                            both = int(shared.sum())
                            added = missing = None
                            if differences and 100 * both >= KEPT_PERCENT * (len(own) + len(pivot) - both):
                                added = own[~shared].view(np.int64)
                                missing = np.setdiff1d(pivot, own, assume_unique=True).view(np.int64)
                            out.append((key, y, len(own), len(pivot), both, added, missing))
                    if out:
                        yield table(list(zip(*out, strict=True)), schema)

        done = written(sent.repartition("y", "part").sortWithinPartitions("y", "part", "kind", "key").mapInArrow(work, schema), label)
        forgotten([pairs, wanted])
        return done


def _linked(both: str, percent: int) -> Column:
    return 100 * F.col(both) >= percent * (F.col("nx") + F.col("ny") - F.col(both))


def derived(pairs: DataFrame, answers: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """(pairs that are linked, pairs whose answer is not settled), from answers that the two sets of a pair got from one pivot.

    With o shared with the pivot of size m: two sets share at least ox + oy - m, and at most min(ox, oy) and what both can have
    beside the pivot. Between these, the overlap is m less what either misses of the pivot, plus what both add to it.
    """
    kept = answers.filter("added IS NOT NULL")

    def of(side: str) -> DataFrame:
        return kept.select(F.col("x").alias(side), F.col("y").alias(f"p{side}"), F.col("ny").alias("m" + side), F.col("both").alias(f"o{side}"), F.col("added").alias(f"a{side}"), F.col("missing").alias(f"d{side}"))

    counts = pairs.join(of("x").drop("ax", "dx"), "x", "left").join(of("y").drop("ay", "dy", "my"), "y", "left")
    alike = F.coalesce(F.col("px") == F.col("py"), F.lit(False))
    counts = counts.withColumn("least", F.when(alike, F.col("ox") + F.col("oy") - F.col("mx")).otherwise(0)).withColumn("most", F.when(alike, F.least("ox", "oy") + F.least(F.col("nx") - F.col("ox"), F.col("ny") - F.col("oy"))).otherwise(F.least("nx", "ny")))
    counts = written(counts.filter(_linked("most", percent)).select("x", "y", "nx", "ny", "c", "least", alike.alias("alike")), "bounds")
    near = counts.filter("alike").filter(~_linked("least", percent))
    exact = near.join(of("x"), "x").join(of("y").drop("my"), "y")
    both = F.col("mx") - F.size(F.array_union("dx", "dy")) + F.size(F.array_intersect("ax", "ay"))
    links = counts.filter("alike").filter(_linked("least", percent)).select("x", "y").unionByName(exact.withColumn("both", both).filter(_linked("both", percent)).select("x", "y"))
    return written(links, "derived"), counts.filter("NOT alike").select("x", "y", "nx", "ny", "c")


def _with_lists(entries: DataFrame, lists: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``entries`` with what ``lists`` makes of the entries of each token; tokens of which it makes nothing go.

    One exchange by token serves both the lists and the join. Lists in parts stay where they are: there are few of them, as each
    has more than ``CHUNK`` members, and what is made of them is sent to their parts.
    """
    plain, hot = entries.filter("part = 0").drop("part").repartition("token"), entries.filter("part > 0").drop("part")
    of_hot = sized(written(lists(hot), "hot"), 120)
    return plain.join(lists(plain).hint("merge"), "token").unionByName(hot.join(of_hot, "token"))


def _leads(entries: DataFrame) -> DataFrame:
    """For tokens of several classes: the most typical entry (pivot), and the most typical one of another class (second)."""
    classes = entries.groupBy("token", "label").agg(F.max(F.struct("typical", "size", "key", "cap", "label", "pos")).alias("best"))
    nth = F.row_number().over(W.partitionBy("token").orderBy(F.desc("best")))
    both = classes.withColumn("nth", nth).filter("nth <= 2").groupBy("token").agg(F.max("best").alias("pivot"), F.min("best").alias("second"), F.count("*").alias("n"))
    return both.filter("n = 2").drop("n")


def set_classes(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """(rows (doc_id, key, size), classes (key, class) of the sets that are linked to others)."""
    found = written(survey(docs, words), "survey")
    rows = found.filter("kind = 0").select("doc_id", "key", "size")
    often = found.filter("kind = 1").groupBy("key").agg(F.sum("size").alias("n")).filter(F.col("n") >= COMMON).orderBy(F.desc("n"), "key").limit(MOST_COMMON).toArrow()
    token, n = often["key"].to_numpy().view(np.uint64), often["n"].to_numpy()
    rank = np.empty(len(token), np.uint64)
    rank[np.lexsort((token, n))] = np.arange(len(token), dtype=np.uint64) | np.uint64(1 << 63)
    by_token = np.argsort(token)
    live = written(live_lists(prefixes(docs, (token[by_token], rank[by_token], -(-n[by_token] // CHUNK)), words, percent)), "lists")
    answers = Answers(docs, found.filter("kind = 0"), words)
    least = lambda n: F.ceil(F.col(n) * percent / 100)
    typical = live.groupBy("key", "size").agg(F.count("*").alias("n")).select("key", (F.col("n") / (F.col("size") - least("size") + 1)).alias("typical"))
    typical = written(typical, "typical")
    entries = written(live.join(sized(typical, 32), "key").withColumn("cap", _cap(percent)), "entries")
    forgotten([live, typical])

    def best(votes: DataFrame, likeness: int) -> DataFrame:
        """For each set, the pivot (x, y) with which it shares most entries that leave it a chance of so high a likeness."""
        counted = votes.groupBy("key", "size", "pivot.key", "pivot.size").agg(F.count("*").alias("c"), F.max(F.expr("cap >= pivot.size AND pivot.cap >= size")).alias("fits")).toDF("x", "nx", "y", "ny", "c", "fits")
        chance = F.col("c") + F.greatest(least("nx"), least("ny")) - 1
        counted = counted.filter("fits").filter((100 + likeness) * chance >= likeness * (F.col("nx") + F.col("ny")))
        return counted.groupBy("x", "nx").agg(F.max_by(F.struct("y", "ny"), F.struct("c", "y")).alias("to")).select("x", "nx", "to.y", "to.ny")

    # first each set against the most typical set that its lists show
    entry = F.struct("typical", "size", "key", "cap")
    votes = _with_lists(entries, lambda e: e.groupBy("token").agg(F.max(entry).alias("pivot"))).filter(entry != F.col("pivot"))
    first = answers.of(answers.possible(best(votes, KEPT_PERCENT), KEPT_PERCENT), "answers", differences=True)
    labels = _roots(first.filter(_linked("both", percent)).select("x", "y"))
    groups = _roots(first.filter(_linked("both", KEPT_PERCENT)).select("x", "y"))

    # then against the most typical set of another class
    own = entries.join(labels, entries.key == labels.x, "left").withColumn("label", F.coalesce("root", "key"))
    known = written(own.select("token", "part", "size", "key", "pos", "cap", "typical", "label"), "labelled")
    forgotten([entries])
    split = written(_with_lists(known, _leads), "split")
    forgotten([known])
    votes = split.withColumn("pivot", F.when(F.col("label") == F.col("pivot.label"), F.col("second")).otherwise(F.col("pivot")))
    asked = first.select("x", "y")
    second = answers.of(answers.possible(best(votes, percent), percent).join(asked, ["x", "y"], "left_anti"), "answers")
    links = second.filter(_linked("both", percent)).select("x", "y")
    labels, groups = _tied(labels, links), _tied(groups, links)
    asked = asked.unionByName(second.select("x", "y"))
    asked = asked.unionByName(asked.select(F.col("y").alias("x"), F.col("x").alias("y")))

    # then pairs of different classes: those inside a group around a pivot that sketches leave possible, and those of different
    # groups that the lists allow; from answers, nearest pairs, the rest
    known = written(split.select("token", "size", "key", "pos").join(groups, F.col("key") == groups.x, "left").select("token", "size", "key", "pos", F.coalesce("root", "key").alias("label")), "labelled")
    forgotten([split])
    grouped = groups.select(F.col("x").alias("key"), F.col("root").alias("token")).join(labels.select(F.col("x").alias("key"), F.col("root").alias("label")), "key", "left")
    grouped = written(grouped.select("key", "token", F.coalesce("label", "key").alias("label"), F.lit(0).alias("pos")).join(answers.where.select("key", "size", "sketch"), "key"), "grouped")
    pairs = written(group_pairs(grouped, percent).unionByName(cross_pairs(known, percent)).join(asked, ["x", "y"], "left_anti"), "pairs")
    forgotten([known, grouped])
    links, rest = derived(pairs, first, percent)
    labels = _tied(labels, links)
    rest = written(_labelled(answers.possible(rest, percent), labels, "c").filter("lx != ly").select("x", "y", "c"), "rest")
    forgotten([pairs])
    of_x = rest.groupBy("x").agg(F.max_by("y", F.struct("c", "y")).alias("y"))
    of_y = rest.groupBy("y").agg(F.max_by("x", F.struct("c", "x")).alias("x")).select("x", "y")
    near = written(of_x.union(of_y).distinct(), "near")
    labels = _tied(labels, answers.of(near, "answers").filter(_linked("both", percent)).select("x", "y"))
    rest = _labelled(rest.join(near, ["x", "y"], "left_anti"), labels).filter("lx != ly")
    labels = _tied(labels, answers.of(rest, "answers").filter(_linked("both", percent)).select("x", "y"))
    return rows, labels.select(F.col("x").alias("key"), F.col("root").alias("class"))


def _labelled(pairs: DataFrame, labels: DataFrame, *more: str) -> DataFrame:
    """Pairs (x, y) with the classes lx, ly of both."""
    a, b = labels.select(F.col("x").alias("xa"), F.col("root").alias("ra")), labels.select(F.col("x").alias("xb"), F.col("root").alias("rb"))
    return pairs.join(a, F.col("x") == F.col("xa"), "left").join(b, F.col("y") == F.col("xb"), "left").select("x", "y", *more, F.coalesce("ra", "x").alias("lx"), F.coalesce("rb", "y").alias("ly"))


def _tied(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The classes (x, root) after further links: only the classes are tied, not their members."""
    links = written(_labelled(links, labels), "links")
    if links.isEmpty():
        return labels
    tied = connected_components(links.filter("lx != ly").select("lx", "ly").distinct(), "lx", "ly")
    tied = written(tied, "tied")
    every = labels.unionByName(links.select(F.explode(F.array(F.struct(F.col("x"), F.col("lx").alias("root")), F.struct(F.col("y").alias("x"), F.col("ly").alias("root")))).alias("s")).select("s.*")).distinct()
    return written(every.join(tied, every.root == tied.node, "left").select("x", F.coalesce("component", "root").alias("root")), "labels")


def _roots(links: DataFrame) -> DataFrame:
    """(x, root) for links that lead each x to one y without going round: parents are doubled until they stay."""
    now = written(links.select("x", F.col("y").alias("root")), "roots")
    while True:
        up = now.select(F.col("x").alias("__x"), F.col("root").alias("__up"))
        now = written(now.join(up, F.col("root") == F.col("__x"), "left").select("x", F.coalesce("__up", "root").alias("root"), F.col("__up").isNotNull().alias("moved")), "roots")
        if now.filter("moved").isEmpty():
            return now.select("x", "root").union(now.select(F.col("root").alias("x"), "root").distinct())
        now = now.drop("moved")


def _named(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """(set_key, class, component_id) of each set."""
    sets = rows.filter("key IS NOT NULL").groupBy("key").agg(F.min("doc_id").alias("least"))
    named = written(sets.join(classes, "key", "left").withColumn("class", F.coalesce("class", "key")), "named")
    least = named.groupBy("class").agg(F.min("least").alias("component_id"))
    return written(named.join(least, "class").select(F.col("key").alias("set_key"), "class", "component_id"), "components")


def components(df: DataFrame, key: str, text: str, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id (least id reachable by links, its own included)."""
    rows, classes = set_classes(df.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")), words, percent)
    named = _named(rows, classes)
    joined = rows.join(named, rows.key == named.set_key, "left")
    return joined.select("doc_id", F.col("size").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def one_of_each(df: DataFrame, key: str, text: str, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows of ``df`` that stay when each class keeps one: that of the least id. Rows without a set all stay.

    Ids that occur once are settled by id; rows with repeated or null ids by their sets.
    """
    rows, classes = set_classes(df.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")), words, percent)
    known = _named(rows, classes)
    repeated = sized(written(rows.groupBy(F.col("doc_id").alias("__id")).count().filter("count > 1 OR __id IS NULL").select("__id"), "repeated"), 24)
    losers = rows.join(known, rows.key == known.set_key).filter("component_id IS NULL OR doc_id != component_id").select(F.col("doc_id").alias("__id"))
    losers = sized(written(losers.filter("__id IS NOT NULL").distinct(), "losers"), 24)
    same = F.col(key).cast("long").eqNullSafe(F.col("__id"))
    settled = df.join(repeated, same, "left_anti").join(losers, same, "left_anti")

    @F.pandas_udf("long")
    def keys(texts: pd.Series) -> pd.Series:
        return pd.Series([set_key(s) if len(s) else None for s in shingle_sets([t or "" for t in texts], words)], dtype="Int64")

    classes_ = known.select(F.col("set_key").alias("__set"), F.col("class").alias("__class"), F.col("component_id").alias("__component"))
    open_ = df.join(repeated, same, "left_semi").withColumn("__key", keys(text)).join(classes_, F.col("__key") == F.col("__set"), "left")
    first = open_.filter(F.col("__class").isNotNull() & F.col(key).cast("long").eqNullSafe(F.col("__component"))).dropDuplicates(["__class"])
    return settled.unionByName(open_.filter("__class IS NULL").select(*named(df))).unionByName(first.select(*named(df)))
