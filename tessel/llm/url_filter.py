"""URL verdicts: host and path rules, and logistic regression on hashed character n-grams (DataFrame functions only).

A small labelled URL table trains the model by gradient descent. Each step is one aggregation over that table; its result
is one number for each hash bucket, and sums are taken over integers so that no order of addition changes them. Scoring is
a projection over all pages with the weights as a literal.

Defined cases: a null url, or one without ``://``, has an empty host and path, no n-grams and the model's verdict on the
intercept alone; very long urls are handled whole; repeated rows are judged each; with no labelled urls, or labels of one
kind only, the model's verdict is that kind (allow if there are none); an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from tessel.plans.stages import written

#: (rule, verdict); a rule is a host and the start of a path.
RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block")]
BUCKETS = 8192
#: The model is fitted to at most so many labelled urls, those with the smallest hashes.
MAX_LABELLED = 4000
STEPS = 30
SCALE = 1 << 32


def split_url(df: DataFrame, url: str) -> DataFrame:
    """``df`` with host (A-Z lower-cased) and path."""
    at = F.instr(F.col(url), "://")
    rest = F.coalesce(F.when(at > 0, F.substring(F.col(url), at + F.lit(3), F.char_length(url))), F.lit(""))
    out = df.withColumn("__rest", rest).withColumn("__host", F.regexp_extract("__rest", r"^[^/?#]*", 0))
    after = F.substring(F.col("__rest"), F.char_length("__host") + F.lit(1), F.char_length("__rest"))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return out.withColumns({"host": F.translate("__host", upper, upper.lower()), "path": F.regexp_extract(after, r"^[^?#]*", 0)}).drop("__rest", "__host")


def with_rule(df: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """``df`` with rule and rule_verdict: of the longest rule that fits host and path, else null."""
    fits = F.lit(None).cast("string")
    verdict = F.lit(None).cast("string")
    for rule, says in sorted(rules, key=lambda r: len(r[0])):  # the longest is tried first, being outermost
        name, slash, start = rule.partition("/")
        fit = ((F.col("host") == name) | F.col("host").endswith("." + name)) & F.col("path").startswith(slash + start)
        fits, verdict = F.when(fit, F.lit(rule)).otherwise(fits), F.when(fit, F.lit(says)).otherwise(verdict)
    return df.withColumns({"rule": fits, "rule_verdict": verdict})


def grams(part: Column, sizes: tuple[int, ...] = (3, 4, 5, 6)) -> Column:
    """Hash buckets of the character n-grams of ``part``, marked at both ends."""

    def of_size(c: Column, n: int) -> Column:
        runs = F.transform(F.sequence(F.lit(0), F.size(c) - n), lambda i: F.pmod(F.xxhash64(*[F.get(c, i + k) for k in range(n)]), F.lit(BUCKETS)).cast("int"))
        return F.when(F.size(c) >= n, runs).otherwise(F.array().cast("array<int>"))

    def of(c: Column) -> Column:
        return F.concat(*[of_size(c, n) for n in sizes])

    return F.when(part == "", F.array().cast("array<int>")).otherwise(F.element_at(F.transform(F.array(F.split(F.concat(F.lit("^"), part, F.lit("$")), "")), of), 1))


def with_grams(df: DataFrame) -> DataFrame:
    return df.withColumn("grams", F.array_distinct(grams(F.concat("host", "path"))))


def score(weights: list[float]) -> Column:
    """Intercept plus the mean-root-scaled sum of the row's bucket weights; the last weight is the intercept."""
    table = F.split(F.lit(",".join(repr(w) for w in weights)), ",").cast("array<double>")  # folded to one literal
    total = F.aggregate("grams", F.lit(0.0), lambda a, g: a + F.get(table, g))
    return F.lit(weights[-1]) + total / F.sqrt(F.greatest(F.size("grams"), F.lit(1)))


def fit(labelled: DataFrame, steps: int = STEPS, rate: float = 8.0, decay: float = 1e-4) -> list[float]:
    """Weights from a bounded table (grams, y); BUCKETS + 1 numbers come back at each step."""
    kinds = {r["y"]: r["count"] for r in labelled.groupBy("y").count().collect()}
    rows = sum(kinds.values())
    weights = [0.0] * (BUCKETS + 1)
    if len(kinds) < 2:
        weights[-1] = -1.0 if kinds.get(0) else 1.0
        return weights
    speed = [0.0] * (BUCKETS + 1)
    for _ in range(steps):
        error = F.col("y") - 1 / (1 + F.exp(-score(weights)))
        share = error / F.sqrt(F.greatest(F.size("grams"), F.lit(1)))
        pull = (
            labelled.select(F.round(error * SCALE).cast("long").alias("e"), F.round(share * SCALE).cast("long").alias("s"), "grams")
            .select(F.explode(F.concat(F.transform("grams", lambda g: F.struct(g.alias("g"), F.col("s").alias("v"))), F.array(F.struct(F.lit(BUCKETS).alias("g"), F.col("e").alias("v"))))).alias("x"))
            .groupBy("x.g").agg(F.sum("x.v").alias("v"))
        )
        step = {r["g"]: r["v"] / SCALE / rows for r in pull.collect()}  # at most BUCKETS + 1 rows
        for g in range(BUCKETS + 1):
            speed[g] = 0.9 * speed[g] + step.get(g, 0.0) - decay * weights[g] * (g < BUCKETS)
            weights[g] += rate * speed[g]
    if not all(map(math.isfinite, weights)):
        raise ValueError("the fit diverged")
    return weights


def judged(df: DataFrame, key: str, url: str, rules: list[tuple[str, str]] = RULES, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """One row per input row: key, host, path, rule, verdict, score.

    The labelled table is made of the urls that a rule decides, ``max_labelled`` of them at most.
    """
    parsed = with_rule(split_url(df.select(F.col(key).alias("key"), F.col(url).alias("__url")), "__url"), rules)
    known = parsed.filter("rule is not null").select("host", "path", F.when(F.col("rule_verdict") == "allow", 1).otherwise(0).alias("y"))
    small = known.dropDuplicates().orderBy(F.xxhash64("host", "path"), "host", "path").limit(max_labelled)
    weights = fit(written(with_grams(small).select("grams", "y"), "urls"))
    scored = with_grams(parsed).withColumn("score", score(weights))
    return scored.select("key", "host", "path", "rule", F.coalesce("rule_verdict", F.when(F.col("score") >= 0, "allow").otherwise("block")).alias("verdict"), "score")
