"""From raw documents to token files: every stage one operator, written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tablex.llm import decontaminate, mixing, near_dedup, quality_classifier, token_files
from tablex.llm.common import table
from tablex.session import stored


def keep_good(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the quality classifier, fitted on the labels, does not reject."""
    return quality_classifier.good(docs, table(spark, folder, "labels"))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return near_dedup.deduplicated(docs)


def cut_benchmark(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents without the words that stand in a benchmark item."""
    return decontaminate.decontaminated(docs, table(spark, folder, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Each document as often as its source's budget takes it."""
    return mixing.mix(docs)


def write_ids(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Token files of the mix, read back."""
    return token_files.tokenised(spark, docs)


STAGES = [
    ("quality classifier", keep_good),
    ("near duplicates", keep_one_of_each),
    ("decontamination", cut_benchmark),
    ("mixing", mix_sources),
    ("token ids", write_ids),
]
#: SQL can't express the trained network, the sketches or the tokenizer; the tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the token files."""
    docs = table(spark, folder, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, folder), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, folder)
