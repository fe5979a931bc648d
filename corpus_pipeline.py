"""The training-data pipeline: documents in, encoded documents out.

Each stage works on all rows its predecessor kept, written as Parquet in between.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saldomart.llm.bpe import bpe_encode
from saldomart.llm.common import stored, table
from saldomart.llm.decontamination import uncontaminated
from saldomart.llm.ngram_join import one_of_each
from saldomart.llm.pii import mask_pii
from saldomart.llm.quality_rules import passing
from saldomart.llm.queries import WORD_TOKENIZER

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return passing(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar documents the one with the lowest doc_id stays."""
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return uncontaminated(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; n_chars follows the text where it was known."""
    n_chars = F.when(F.col("n_chars").isNotNull(), F.char_length("text")).cast(docs.schema["n_chars"].dataType)
    return mask_pii(docs).withColumn("n_chars", n_chars)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of every document kept, with the digests of identifiers and decoded text."""
    return bpe_encode(docs, WORD_TOKENIZER)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("ngram_join", near_duplicates),
    ("decontamination", decontamination),
    ("pii", personal_data),
    ("bpe", encoding),
]

ORACLE_SQL = None  # labels of a field and byte pairs have no SQL; tests/llm holds a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
