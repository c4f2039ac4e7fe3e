"""The registered queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tablesync.llm import mixing, sql
from tablesync.llm.common import let_workers_import, table
from tablesync.llm.kmeans_tree import neighbours
from tablesync.llm.mil_classifier import quality_scores
from tablesync.llm.packing import packed_documents
from tablesync.llm.parity_join import Likeness, linked
from tablesync.llm.pii import personal_data
from tablesync.llm.prefix_trie import prefix_trie, rebuilt
from tablesync.llm.quality_rules import quality_verdicts
from tablesync.llm.rare_digest import compared
from tablesync.llm.run_length_index import without_repeats
from tablesync.llm.toxicity import toxicity_scores
from tablesync.llm.turn_alignment import damaged, repair_digests
from tablesync.llm.warc import archived_pages

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(function):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            let_workers_import(spark)
            return function(spark, sf_dir)

        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return function

    return register


@query("op7_quality_rules", sql.quality_rules())
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdicts = quality_verdicts(table(spark, sf_dir, "documents"))
    return verdicts.drop("class_distance", "word_distance")


@query("op1_mixing", sql.mixing())
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_ids(table(spark, sf_dir, "documents"), mixing.PRODUCTION)


@query("op2_best_fit_packing")
def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_documents(table(spark, sf_dir, "documents"))


@query("op5_warc", sql.WARC)
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived_pages(spark, table(spark, sf_dir, "pages"))


@query("op10_kmeans_tree")
def op10_kmeans_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours(spark, table(spark, sf_dir, "embeddings"), "id % 100 = 0")


@query("op4_toxicity")
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op8_mil_quality")
def op8_mil_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op3_semi_markov_pii")
def op3_semi_markov_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))


@query("op6_parity_jaccard_join", sql.jaccard())
def op6_parity_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked(table(spark, sf_dir, "documents"), Likeness(4, 85))


@query("op9_run_length_index")
def op9_run_length_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents"), texts=False)


@query("op11_block_prefix_trie", sql.prefix_trie())
def op11_block_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(*rebuilt(table(spark, sf_dir, "conversations")))


@query("op12_turn_alignment")
def op12_turn_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_digests(damaged(table(spark, sf_dir, "conversations")))


@query("op13_rare_digest")
def op13_rare_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compared(table(spark, sf_dir, "documents"))
