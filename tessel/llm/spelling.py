"""Groups of spelling variants: words that differ by one letter, found with bit-sliced position indexes.

An index holds, for each position and letter, the set of its words with that letter there, as the bits of one integer. A word is
matched with all of them at once: going through its letters, the set that agrees so far and the three sets with one error (a letter
replaced, one more, one less) move on together by a few operations on whole sets, with the positions of the last two shifted by one.

The vocabulary is dealt out so that no index grows with it. Of two words at distance one, the shorter having m letters, either the
first m // 2 letters agree or the last m - m // 2 do. So a word of n letters stands in the blocks of its first and of its last half,
once for m = n and once for m = n - 1. A block of more than ``INDEX_WORDS`` words is dealt by hash to several indexes, and every word
of the block asks each of them, streaming by; what comes back is one row a word and index, never a pair. A pair that both blocks show
is taken from the first half's only.

Occurrences are counted inside the tasks before anything is shuffled. Forms point to words of at least five times the occurrences, so
chains are short; they are followed by doubling.

Defined cases: a null or empty text has no words; a null key reads as an empty string in the misspelling rule; repeated rows count
each; an empty table gives no words; other columns are not read.
"""

from __future__ import annotations

import itertools
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tessel.llm import arrow
from tessel.plans.stages import forgotten, sized, written

#: Code points that a word needs at least, and occurrences.
LEAST_LETTERS, LEAST_TIMES = 6, 5
#: A word's form has at least so many times its occurrences.
FORM_TIMES = 5
#: One run in so many is taken as misspelt: a code point of it goes.
MISSPELT_ONE_IN = 199
#: Words in one index, about.
INDEX_WORDS = 1 << 13
#: Distinct words that a task counts before it passes them on.
COUNTED_WORDS = 1 << 17

RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def word_of(key: int | None, run: str) -> str:
    """The word that a lower-cased run of a document stands for."""
    return _word(zlib.crc32(f"{'' if key is None else key}:".encode()), run)


def _word(prefix: int, run: str) -> str:
    h = zlib.crc32(run.encode(), prefix)
    if h % MISSPELT_ONE_IN:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def counted(df: DataFrame, key: str, text: str) -> DataFrame:
    """word, n: the words of all texts with their occurrences, as many letters and times as they may have."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()
        for b in batches:
            for part in arrow.slices(b, 1):
                for k, value in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    prefix = zlib.crc32(f"{'' if k is None else k}:".encode())
                    lower = (value or "").translate(_LOWER)
                    runs = Counter(RUN.findall(lower) if len(lower) < 1 << 20 else (m[0] for m in RUN.finditer(lower)))
                    for run, n in runs.items():
                        held[_word(prefix, run)] += n
                    if len(held) >= COUNTED_WORDS:
                        yield pa.RecordBatch.from_pydict({"word": pa.array(held.keys(), pa.string()), "n": pa.array(held.values(), pa.int64())})
                        held = Counter()
        yield pa.RecordBatch.from_pydict({"word": pa.array(held.keys(), pa.string()), "n": pa.array(held.values(), pa.int64())})

    parts = df.select(df[key].cast("long").alias("key"), df[text].alias("text")).mapInArrow(work, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


class Index:
    """Bit-sliced position index over words given best first: bit k of the set (position, letter) tells that word k has it there."""

    def __init__(self, words: list[str]) -> None:
        self.words, size = words, (len(words) + 7) // 8
        slices: dict[tuple[int, str], bytearray] = {}
        lengths: dict[int, bytearray] = {}
        for k, word in enumerate(words):
            byte, bit = k >> 3, 1 << (k & 7)
            lengths.setdefault(len(word), bytearray(size))[byte] |= bit
            for at in enumerate(word):
                if at not in slices:
                    slices[at] = bytearray(size)
                slices[at][byte] |= bit
        self.slices = {at: int.from_bytes(x, "little") for at, x in slices.items()}
        self.lengths = {n: int.from_bytes(x, "little") for n, x in lengths.items()}
        self.all = (1 << len(words)) - 1

    def near(self, word: str, half: int) -> tuple[int, int, int, int]:
        """Sets of words at distance one: as long as ``word``, longer, shorter; and those that share its first ``half`` letters."""
        at, same, replaced, more, less, shared = self.slices.get, self.all, 0, 0, 0, self.all
        for i, c in enumerate(word):
            if i == half:
                shared = same
            here = at((i, c), 0)
            replaced = replaced & here | same & ~here
            more = (more | same) & at((i + 1, c), 0)
            less = less & at((i - 1, c), 0) | same
            same &= here
        n, of = len(word), self.lengths.get
        return replaced & of(n, 0), (more | same) & of(n + 1, 0), less & of(n - 1, 0), shared


def _entries(vocabulary: DataFrame) -> DataFrame:
    """word, n, block: side (0 first half, 1 last half), m letters of the shorter word, and the half itself."""
    n = F.char_length("word")
    half = lambda m: F.floor(m / 2).cast("int")
    ends = [lambda m: F.substring(F.col("word"), F.lit(1), half(m)), lambda m: F.right(F.col("word"), m - half(m))]
    places = [F.when(m >= LEAST_LETTERS, F.struct(F.lit(side).alias("side"), m.alias("m"), end(m).alias("half"))) for m in (n, n - 1) for side, end in enumerate(ends)]
    return vocabulary.select("word", "n", F.explode(F.array_compact(F.array(*places))).alias("block")).select("word", "n", "block.*")


def neighbours(vocabulary: DataFrame, index_words: int = INDEX_WORDS) -> DataFrame:
    """word, n_near, best (its near word of largest n, ties smallest), best_n; words without near ones are left out."""
    block = ["side", "m", "half"]
    entries = _entries(vocabulary)
    large = written(entries.groupBy(*block).count().filter(F.col("count") > index_words).withColumn("indexes", F.ceil(F.col("count") / index_words).cast("int")).drop("count"), "large-blocks")
    dealt = entries.join(sized(large, 128), block, "left")
    # kind 0 stands in an index, 2 asks one, 1 does both; the asking rows of a block come after its index
    own = F.struct(F.when(F.col("indexes").isNull(), 1).otherwise(0).alias("kind"), F.coalesce(F.pmod(F.xxhash64("word"), F.col("indexes")), F.lit(0)).cast("int").alias("part"))
    asking = F.transform(F.sequence(F.lit(0), F.col("indexes") - 1), lambda p: F.struct(F.lit(2).alias("kind"), p.alias("part")))
    dealt = dealt.select("word", "n", *block, F.explode(F.when(F.col("indexes").isNull(), F.array(own)).otherwise(F.concat(F.array(own), asking))).alias("role")).select(*block, "role.part", "role.kind", "word", "n")
    keys = [*block, "part"]
    schema = "word string, n_near long, best string, best_n long"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held, index, times, out = None, [], None, {}, []

        def found(word: str) -> None:
            half = current[1] // 2
            as_long, longer, shorter, shared = index.near(word, half)
            near = as_long | longer if len(word) == current[1] else shorter
            if current[0]:
                near &= ~shared
            if near:
                best = index.words[(near & -near).bit_length() - 1]
                out.append((word, near.bit_count(), best, times[best]))

        def built() -> None:
            nonlocal index, held, times
            ranked = sorted(held, key=lambda x: (-x[1], x[0]))
            index, times = Index([w for w, *_ in ranked]), {w: n for w, n, _ in ranked}

        def closed() -> None:
            nonlocal held, index
            if len(held) > 1 and held[0][2] == 1:
                built()
                for word, *_ in held:
                    found(word)
            held, index = [], None

        for b in batches:
            for side, m, half, part, kind, word, n in zip(*(c.to_pylist() for c in b.columns)):
                if (side, m, half, part) != current:
                    closed()
                    current = (side, m, half, part)
                if kind == 2:
                    if index is None:
                        built()
                    found(word)
                else:
                    held.append((word, n, kind))
            yield from _found(out)
            out.clear()
        closed()
        yield from _found(out)

    def _found(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        if rows:
            yield arrow.table(list(zip(*rows, strict=True)), schema)

    rows = dealt.repartition(*keys).sortWithinPartitions(*keys, "kind").mapInArrow(work, schema)
    first = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word")))
    return rows.groupBy("word").agg(F.sum("n_near").alias("n_near"), first.alias("first")).select("word", "n_near", F.col("first.word").alias("best"), (-F.col("first.n")).alias("best_n"))


def roots(forms: DataFrame) -> DataFrame:
    """word, root: from each word of ``forms`` (word, form) the last one that its forms lead to. Chains must end."""
    current = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = current.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = written(current.join(sized(ahead, 96), "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        on = moved.filter("moved").limit(1).count()
        forgotten([current])
        current = moved
        if not on:
            return current.select("word", "root")


def variants(df: DataFrame, key: str, text: str, index_words: int = INDEX_WORDS) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word with enough letters and occurrences."""
    vocabulary = written(counted(df, key, text).filter((F.col("n") >= LEAST_TIMES) & (F.char_length("word") >= LEAST_LETTERS)), "vocabulary")
    near = neighbours(vocabulary, index_words)
    formed = F.col("best_n") >= FORM_TIMES * F.col("n")
    judged = written(vocabulary.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(formed, F.col("best")).alias("form"), F.when(formed, F.col("best_n")).alias("form_n")), "forms")
    last = roots(judged.filter("form is not null"))
    return judged.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
