"""Labelled samples and folds that the two classifiers share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesync.llm.common import written


def fold(id_column: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % folds


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, learn: Column, rows: int, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """At most ``rows`` (text, y) of labelled documents that ``learn`` (over ``id``) allows, chosen by hash.

    Only ids and labels of the sample are broadcast, so at most ``rows`` of them."""
    marked = labels.select(F.col(id_col).alias("id"), F.col(label).cast("int").alias("y"))
    marked = marked.where(F.col("y").isin(0, 1) & learn)
    chosen = written(marked.orderBy(F.xxhash64("id"), "id", "y").limit(rows), "labels")
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # an id that repeats counts once for each of its labels
    return texts.join(F.broadcast(chosen), "id").select("id", "text", "y").dropDuplicates(["id", "y"])
