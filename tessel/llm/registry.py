"""The queries of this subpackage, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tessel.llm import alignment, bpe, chat, fingerprints, jaccard_join, oracle, packing, quality, sharding, spelling, suffix_dedup, token_counts, url_filter, word_table
from tessel.plans.stages import written
from tessel.plans.tables import table


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"), "doc_id", "text")


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    conflict = "</s>[INST] ok [/INST]"
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(conflict).alias("text"))
    return chat.read_back(chat.formatted(rows.union(extra), "conv_id", "turn", "role", "text"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judged(table(spark, sf_dir, "pages"), "page_id", "url").withColumnRenamed("key", "page_id")


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), "doc_id", "text", "byte_bpe_multi_50k.tiktoken").withColumnRenamed("key", "doc_id")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of every document before and after three edits: a word put in the middle, a cut, and an end."""
    n = F.char_length(F.coalesce("text", F.lit("")))
    edit = lambda start, removed, inserted: F.struct(start.cast("long").alias("start"), F.lit(removed).alias("removed"), F.lit(inserted).alias("inserted"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.array(edit(F.floor(n / 2), 7, "un changed"), edit(F.floor(n / 4), 11, ""), edit(n, 0, " The end.")).alias("edits"))
    return token_counts.counted(docs, "doc_id", "text", "edits", "byte_bpe_50k.tiktoken").withColumnRenamed("key", "doc_id")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    judged = written(quality.base_features(docs, "text").select("doc_id", "source", *quality.FEATURES, "base_failed"), "quality")
    kept = quality.with_verdicts(judged, quality.host_verdicts(judged, "source"), "source")
    return kept.select("doc_id", *quality.FEATURES, "base_failed", "kept")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), "doc_id", "text", "byte_bpe_50k.json", "byte_bpe_50k.tiktoken")


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.cut_report(table(spark, sf_dir, "documents"), "doc_id", "text", passage_words=suffix_dedup.PASSAGE_WORDS)


def op9_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.byte_shards(table(spark, sf_dir, "documents"), "doc_id", "text", shards=40)
    return out.select(F.col("key").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.components(table(spark, sf_dir, "documents"), "doc_id", "text")


def op11_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_table.digests(table(spark, sf_dir, "documents"), "doc_id", "text", "byte_bpe_50k.json", "byte_bpe_50k.tiktoken").withColumnRenamed("key", "doc_id")


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = alignment.aligned(table(spark, sf_dir, "documents"), "doc_id", "text", "byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "piece_bpe_32k.model")
    return out.withColumnRenamed("key", "doc_id")


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"), "doc_id", "text")


QUERIES = {
    "op1_fingerprints": op1_fingerprints,
    "op2_chat_format": op2_chat_format,
    "op3_url_filter": op3_url_filter,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_token_counts": op5_token_counts,
    "op6_quality_rules": op6_quality_rules,
    "op7_packing": op7_packing,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_byte_shards": op9_byte_shards,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_word_bpe": op11_word_bpe,
    "op12_alignment": op12_alignment,
    "op13_spelling": op13_spelling,
}
ORACLE = oracle.SQL
