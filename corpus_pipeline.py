"""From raw documents to packed training sequences: quality rules, one of each group of near
duplicates, personal data out, sources mixed to their weights, documents packed.

Every stage takes the documents that the one before kept and returns documents with the same columns;
the last returns the pieces of the packed sequences. Mixing may take a document once or twice, and
packing then places each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tablesync.llm import mixing
from tablesync.llm.common import let_workers_import, table, written
from tablesync.llm.packing import packed_documents
from tablesync.llm.parity_join import Likeness, one_of_each
from tablesync.llm.pii import redacted
from tablesync.llm.quality_rules import keep_good


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    let_workers_import(spark)
    return one_of_each(docs, Likeness(width=5, least=80))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    let_workers_import(spark)
    return redacted(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs, mixing.PRODUCTION)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    let_workers_import(spark)
    return packed_documents(docs)


STAGES = [
    ("quality_rules", quality),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mixing", mixture),
    ("packing", packing),
]

#: Personal data and packing have no SQL; tests compare the pipeline with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
