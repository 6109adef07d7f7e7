"""A corpus pipeline made of the llm operators: each stage takes documents and returns what it keeps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tessel.llm import jaccard_join, packing, quality, suffix_dedup
from tessel.llm.arrow import named
from tessel.plans.stages import written
from tessel.plans.tables import table


#: Passages of so many bytes go, whatever they hold.
PASSAGE_BYTES = 300
#: Passages of over 50 words go too, however short the words are.
PASSAGE_WORDS = 51


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and come from a host that passes.

    A null or empty text fails; a null source is a host of its own; repeated rows are judged each; no rows give none.
    """
    rows = docs.select("text", "source", F.struct(*named(docs)).alias("__row"))  # whatever the columns are called
    rows = written(quality.base_features(rows, "text").select("__row", "source", "base_failed"), "judged")
    hosts = quality.host_verdicts(rows, "source")
    return quality.with_verdicts(rows, hosts, "source").filter("kept").select("__row.*")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least id, of each class of near duplicates.

    Texts without a word all stay; of repeated rows one stays; rows with equal or null ids are told apart by their texts.
    """
    return jaccard_join.one_of_each(docs, "doc_id", "text")


def passage_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the later copies of passages of 300 bytes or of 51 words; n_chars follows the text.

    All rows stay, be it with an empty text; a null text becomes empty only if it is cut; of repeated rows one keeps its text.
    """
    cut = suffix_dedup.without_repeats(docs, "doc_id", "text", keep="first", length=PASSAGE_BYTES, block=PASSAGE_BYTES // 2, passage_words=PASSAGE_WORDS)
    return cut.withColumn("n_chars", F.char_length("text").cast("long")).select(*named(docs))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 1024 tokens; a null or empty text is its end token alone."""
    return packing.packed(docs, "doc_id", "text", "byte_bpe_50k.json", "byte_bpe_50k.tiktoken")


STAGES = [("quality", quality_stage), ("near_duplicates", near_duplicate_stage), ("passages", passage_stage), ("packing", packing_stage)]
#: The stages have no form in SQL (shingle classes, byte ranges, tokens); tests/llm holds them against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's rows are written before the next reads them."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
