"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept
and returns a frame; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.llm import exact_dedup, langid, near_dedup, packing, suffix_dedup
from claimloom.llm.common import stored, prepare

#: A text goes if its language is unknown or less certain than this.
LEAST_SCORE = 0.3


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a letter, and those that no learnt language fits, go."""
    prepare(spark)
    predicted = langid.identify(docs, langid.fit(docs))
    known = (F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_SCORE)
    return predicted.where(known).select("row.*")


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays: the one with the largest id."""
    prepare(spark)
    return exact_dedup.deduplicate(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays: the one with the smallest id."""
    prepare(spark)
    return near_dedup.deduplicate(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; strings of 100 bytes that occur earlier are cut out of their texts."""
    prepare(spark)
    return suffix_dedup.remove_repeats(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all token pieces in sequences of 1024."""
    prepare(spark)
    return packing.packed(docs)


STAGES = [
    ("language ID", language_id),
    ("exact dedup", exact_duplicates),
    ("MinHash near-dedup", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("best-fit packing", pack),
]
#: SQL cannot express the stages that train a network or tokenize.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
