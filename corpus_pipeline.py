"""Language ID, near duplicates, benchmark decontamination, personal data and packing, over a table of documents."""

from pyspark.sql import DataFrame, SparkSession

from hourloom.llm.decontaminate import decontaminate
from hourloom.llm.jaccard_join import distinct_documents
from hourloom.llm.language_id import drop_rejected
from hourloom.llm.common import saved
from hourloom.llm.packing import pack
from hourloom.llm.pii import redact


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the language model rejects go."""
    return drop_rejected(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked documents stays: the one with the smallest doc_id."""
    return distinct_documents(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a window of a benchmark item occurs go."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data are replaced by their kind."""
    return redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 ids."""
    return pack(docs).drop("source")


STAGES = [
    ("language_id", languages),
    ("jaccard_join", near_duplicates),
    ("decontamination", decontamination),
    ("pii", personal_data),
    ("packing", packing),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir))
    return docs
