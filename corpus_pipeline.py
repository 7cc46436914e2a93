"""From raw documents to packed training sequences, stage by stage over whole tables.

Every stage works on all documents that its predecessor kept, is written as Parquet in the shared checkpoint folder and read again. The
last stage returns the pieces of documents with their sequences; the others return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fieldlens.llm import decontaminate, ngram_join, packing, quality_rules, secret_forest
from fieldlens.llm.common import shared_folder, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; of the others failing lines go."""
    return quality_rules.good_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked documents stays, the one of the smallest id."""
    return ngram_join.one_of_each(docs)


def contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the text; every document stays."""
    return secret_forest.without_secrets(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their sequence and place in it."""
    return packing.op9(docs)


STAGES = [("quality_rules", quality), ("ngram_join", near_duplicates), ("decontamination", contaminated), ("secret_scan", secrets),
          ("packing", packed)]

#: The forest and the genetic algorithm can't be told in SQL; tests/llm compares with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_folder(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
