"""Quality rules with host verdicts (DataFrame functions only).

Each document gets base features and a base verdict from its own text. The failures are summed by host, the hosts' rates
are shrunk by a beta prior fitted to all hosts by the method of moments. A host whose shrunken rate stands out loses its other
documents too: its odds of failing must be ``HOST_ODDS`` times the prior mean's, and its rate ``HOST_ERRORS`` posterior standard
deviations above it. So a host can fall at any base rate, but neither by chance nor, however many documents it has, by a trifle.

Defined cases: a null or empty text has no words and fails the base rules; a null host is a host of its own; repeated rows
count each; very long texts are handled whole; an empty table gives no rows; names with two leading underscores are
reserved, any other extra column passes through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tessel.plans.stages import sized

SPACE = r"\x20\x09-\x0D"
FEATURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: A host is rejected when the odds of its shrunken rate are so many times those of the prior mean or more, and the rate is more
#: than so many posterior standard deviations above it.
HOST_ODDS, HOST_ERRORS = 2.0, 3.0


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once for the row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), f"[{SPACE}]+"), lambda w: w != "")


def _covered(hashes: Column, window: int) -> Column:
    """Positions inside windows whose hash occurs twice or more, from the sorted (hash, start) pairs."""
    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def starts(s: Column) -> Column:
        same = lambda a, b: F.get(s, a)["h"] == F.get(s, b)["h"]
        return F.sort_array(F.transform(
            F.filter(s, lambda x, i: F.coalesce(same(i, i - 1), F.lit(False)) | F.coalesce(same(i, i + 1), F.lit(False))),
            lambda x: x["i"],
        ))

    def length(at: Column) -> Column:
        return F.aggregate(at, F.struct(F.lit(0).alias("n"), F.lit(-window).alias("last")), lambda acc, i: F.struct((acc["n"] + F.least(F.lit(window), i - acc["last"])).alias("n"), i.alias("last")), lambda acc: acc["n"])

    return let(pairs, lambda s: length(starts(s)))


def repeat_words(words: Column, window: int = 5) -> Column:
    """Words in ``window``-word runs that occur twice or more in the text, the first occurrence included."""

    def of(h: Column) -> Column:
        runs = F.transform(F.sequence(F.lit(0), F.size(h) - window), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(window)]))
        counted = let(runs, lambda r: F.when(F.size(F.array_distinct(r)) == F.size(r), F.lit(0)).otherwise(_covered(r, window)))
        return F.when(F.size(h) > window, counted).otherwise(F.lit(0))

    return let(F.transform(words, lambda w: F.xxhash64(w)), of)


def base_features(df: DataFrame, text: str) -> DataFrame:
    """``df`` with FEATURES (long) and base_failed (boolean)."""
    whole = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda x: F.rlike(x, F.lit(f"[^{SPACE}]")))
    counts = let(words_of(F.col(text)), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.aggregate(w, F.lit(0).cast("long"), lambda a, x: a + F.char_length(x)).alias("word_chars"),
        repeat_words(w).cast("long").alias("n_repeat_words"),
    ))
    out = df.withColumns({
        "__c": counts,
        "n_symbols": F.char_length(F.regexp_replace(whole, r"[^#*$%&|<>]+", "")).cast("long"),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
    })
    out = out.withColumns({k: F.col("__c")[k] for k in ("n_words", "word_chars", "n_repeat_words")}).drop("__c")
    return out.withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))


def host_verdicts(judged: DataFrame, host: str, odds: float = HOST_ODDS, errors: float = HOST_ERRORS) -> DataFrame:
    """One row per host: host, n_docs, n_failed, shrunk_rate, host_failed.

    The prior's mean is the share of failures over all documents; its strength comes from the variance of the hosts' rates
    (equally weighted), held between 1 and 1000. With fewer than two hosts, or no variance, the strength is 1000.
    """
    return host_verdicts_of_counts(judged.groupBy(host, "base_failed").count(), host, odds, errors)


def host_verdicts_of_counts(counts: DataFrame, host: str, odds: float = HOST_ODDS, errors: float = HOST_ERRORS) -> DataFrame:
    """The same from rows (host, base_failed, count)."""
    hosts = counts.groupBy(F.col(host).alias("host")).agg(F.sum("count").alias("n_docs"), F.sum(F.when(F.col("base_failed"), F.col("count")).otherwise(0)).alias("n_failed"))
    prior = hosts.agg(
        (F.sum("n_failed") / F.sum("n_docs")).alias("m"),
        F.coalesce(F.var_samp(F.col("n_failed") / F.col("n_docs")), F.lit(0.0)).alias("v"),
    ).select("m", F.when(F.col("v") > 0, F.least(F.lit(1000.0), F.greatest(F.lit(1.0), F.col("m") * (1 - F.col("m")) / F.col("v") - 1))).otherwise(1000.0).alias("k"))
    rated = hosts.join(F.broadcast(prior)).withColumn("shrunk_rate", (F.col("n_failed") + F.col("m") * F.col("k")) / (F.col("n_docs") + F.col("k")))  # the prior is one row
    rate, mean = F.col("shrunk_rate"), F.col("m")
    far = rate * (1 - mean) >= odds * mean * (1 - rate)
    sure = rate - mean > errors * F.sqrt(rate * (1 - rate) / (F.col("n_docs") + F.col("k") + 1))
    return rated.select("host", "n_docs", "n_failed", "shrunk_rate", (far & sure).alias("host_failed"))


def with_verdicts(judged: DataFrame, verdicts: DataFrame, host: str) -> DataFrame:
    """``judged`` with kept (boolean); host verdicts are sent whole only if their counted size is small."""
    bad = sized(verdicts.filter("host_failed").select(F.col("host").alias("__host"), F.lit(True).alias("__bad")), 64)
    return judged.join(bad, F.col(host).eqNullSafe(F.col("__host")), "left").withColumn("kept", ~F.col("base_failed") & F.col("__bad").isNull()).drop("__host", "__bad")
