"""Nearest neighbours by a hierarchical k-means tree with best-bin-first search.

The tree is fitted on a bounded sample (``sample_rows`` vectors, chosen by hash of their ids) and is
broadcast; its size depends on ``max_leaves``, not on the table. Every row is put into the leaf that
greedy descent finds. A query walks the tree through a priority queue of centre distances and visits
the nearest leaves. How many is calibrated: for ``calibration`` queries the true neighbours are found
by a scan of all rows, and visits widen until ``recall`` of them lie in visited leaves. Clustered vectors
take a few leaves in a hundred; where hardly anything is near, most of the leaves.

Visits and rows meet by (leaf, block): a leaf's rows are cut into blocks of ``block_rows``, so equal
or crowded vectors are many tasks' work. Each block returns its k best per query, exactly measured.

Defined results: vectors that are null, zero, of another length than most, or hold null or
non-finite components take no part, neither do null ids; ties go to the smaller id; every row but the
query's own is a candidate, others of its id too, and each of several query rows of one id has its list; a query visits leaves until they hold more than k rows, so small
tables give all candidates; an empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablesync.llm.common import parts_for, written


@dataclass(frozen=True)
class Settings:
    neighbours: int = 10
    sample_rows: int = 20_000
    branching: int = 8
    leaf_rows: int = 256  # rows of a leaf aimed at
    max_leaves: int = 2048
    calibration: int = 256  # queries
    recall: float = 0.94
    block_rows: int = 8192
    seed: int = 5


@dataclass
class Tree:
    """Nodes by number, the root 0: centre, children (none: a leaf), and the leaf's number."""

    centres: np.ndarray
    children: list[list[int]]
    leaf: np.ndarray

    def assign(self, vectors: np.ndarray) -> np.ndarray:
        """Leaf of each vector by greedy descent."""
        node = np.zeros(len(vectors), np.int64)
        waiting = [(0, np.arange(len(vectors)))]
        while waiting:
            at, rows = waiting.pop()
            own = self.children[at]
            if not own or not len(rows):
                node[rows] = at
                continue
            best = _nearest(vectors[rows], self.centres[own])
            waiting.extend((child, rows[best == i]) for i, child in enumerate(own))
        return self.leaf[node]

    def visits(self, query: np.ndarray, enough: int, rows: np.ndarray, least: int) -> list[int]:
        """Leaves in best-bin-first order: ``enough`` of those that hold rows, and until they hold ``least`` rows."""
        found: list[int] = []
        held, queue = 0, [(0.0, 0)]
        while queue and (len(found) < enough or held < least):
            _, at = heapq.heappop(queue)
            own = self.children[at]
            if own:
                gaps = self.centres[own] - query
                for child, gap in zip(own, np.einsum("ij,ij->i", gaps, gaps).tolist(), strict=True):
                    heapq.heappush(queue, (gap, child))
            elif rows[leaf := int(self.leaf[at])]:
                found.append(leaf)
                held += int(rows[leaf])
        return found


def _nearest(vectors: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres * centres).sum(axis=1) - 2 * vectors @ centres.T).argmin(axis=1)


def _k_means(vectors: np.ndarray, k: int, random: np.random.Generator, rounds: int = 8) -> np.ndarray:
    centres = vectors[random.choice(len(vectors), k, replace=False)]
    for _ in range(rounds):
        best = _nearest(vectors, centres)
        for i in np.unique(best):
            centres[i] = vectors[best == i].mean(axis=0)
    return centres[np.unique(_nearest(vectors, centres))]


def fit_tree(sample: np.ndarray, leaves: int, settings: Settings) -> Tree:
    """A tree of about ``leaves`` leaves over the sample."""
    random = np.random.default_rng(settings.seed)
    centres, children = [sample.mean(axis=0)], [[]]
    most = max(2, len(sample) // max(1, leaves))
    waiting = [(0, sample)]
    while waiting:
        at, own = waiting.pop()
        if len(own) <= most or leaves == 1:
            continue
        middle = _k_means(own, min(settings.branching, -(-len(own) // most)), random)
        if len(middle) < 2:  # equal vectors
            continue
        best = _nearest(own, middle)
        for i, centre in enumerate(middle):
            children[at].append(len(centres))
            waiting.append((len(centres), own[best == i]))
            centres.append(centre)
            children.append([])
    leaf = np.full(len(centres), -1)
    ends = [i for i, own in enumerate(children) if not own]
    leaf[ends] = np.arange(len(ends))
    return Tree(np.array(centres), children, leaf)


def nearest_of(query: np.ndarray, rows: np.ndarray, ids: np.ndarray, vectors: np.ndarray, own: int, k: int) -> list[tuple[int, int, float]]:
    """(row, id, distance) of the k nearest of one query by exact distance in double precision, ties to the smaller id."""
    rough = ((vectors - query) ** 2).sum(axis=1)
    rough[rows == own] = np.inf
    at = np.flatnonzero(np.isfinite(rough))
    if len(at) > k:
        at = at[rough[at] <= np.partition(rough[at], k - 1)[k - 1]]
    order = np.lexsort((rows[at], ids[at], rough[at]))[:k]
    return [(int(rows[r]), int(ids[r]), float(np.sqrt(rough[r]))) for r in at[order]]


def _usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v) of rows that take part, v as doubles of one length."""
    v = F.col("v")
    finite = ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    rows = rows.where(F.col("id").isNotNull() & v.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(v, lambda x: x != 0))
    sizes = rows.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), "size").first()
    return rows.where(F.size("v") == (sizes["size"] if sizes else 0))


def _matrix(column: pa.Array | pd.Series) -> np.ndarray:
    if isinstance(column, pd.Series):
        return np.array(column.tolist(), float).reshape(len(column), -1)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    return flat.reshape(len(column), -1)


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_row").orderBy("score", "vec_id", "vec_row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


FOUND = "query_row long, query_id long, vec_row long, vec_id long, score double"


def scanned(rows: DataFrame, queries: list[tuple[int, int, list[float]]], k: int) -> DataFrame:
    """The k nearest of few queries (row, id, vector) by a scan of all rows; each task returns its k best per query."""
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64()]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                at, ids, matrix = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False), _matrix(batch.column(2))
                found = [(own, i, *near) for own, i, v in queries for near in nearest_of(np.array(v), at, ids, matrix, own, k)]
                columns = list(zip(*found, strict=True)) or [[]] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=[f.split(" ")[0] for f in FOUND.split(", ")])

    return _top(rows.select("row", "id", "v").mapInArrow(scan, FOUND), k)


def neighbours(
    spark: SparkSession, vectors: DataFrame, is_query: Column | str, id_col: str = "vec_id", vector_col: str = "embedding",
    settings: Settings = Settings(),
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the nearest found of each row that ``is_query`` (SQL over ``id``)."""
    k, schema = settings.neighbours, "query_id long, rank int, vec_id long, score double"
    rows = written(_usable(vectors, id_col, vector_col).select(F.monotonically_increasing_id().alias("row"), "id", "v"), "vectors")
    n = rows.count()
    if n == 0:
        return spark.createDataFrame([], schema)
    by_hash = F.pmod(F.xxhash64("id"), F.lit(1_000_000))
    share = min(1_000_000, int(1.1e6 * settings.sample_rows / n) + 1)
    chosen = rows.where(by_hash < share).orderBy(F.xxhash64("id"), "id", "row").limit(settings.sample_rows)
    sample = np.array([r["v"] for r in chosen.collect()] or [rows.first()["v"]])
    leaves = min(settings.max_leaves, parts_for(n, settings.leaf_rows), max(1, len(sample) // 4))
    tree = spark.sparkContext.broadcast(fit_tree(sample, leaves, settings))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                leaf = tree.value.assign(_matrix(batch.column(2)))
                yield pa.RecordBatch.from_arrays([pa.array(leaf, pa.int32()), *batch.columns], names=["leaf", "row", "id", "v"])

    placed = "leaf int, row long, id long, v array<double>"
    indexed = written(rows.mapInArrow(index, placed), "vectors-by-leaf")
    sizes = np.zeros(int(tree.value.leaf.max()) + 1, np.int64)  # bounded by the tree
    for row in indexed.groupBy("leaf").count().collect():
        sizes[row["leaf"]] = row["count"]

    asked = indexed.where(is_query)
    visits = _calibrated(indexed, asked, tree.value, sizes, settings)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                walks = [tree.value.visits(q, visits, sizes, k + 1) for q in _matrix(batch.column(2))]
                of = np.repeat(np.arange(len(walks)), [len(w) for w in walks])
                leaf = pa.array(np.concatenate([np.array(w, int) for w in walks]), pa.int32())
                yield pa.RecordBatch.from_arrays([leaf, *(c.take(pa.array(of)) for c in batch.columns)], names=["leaf", "row", "id", "v"])

    probes = asked.select("row", "id", "v").mapInArrow(probe, placed)
    # a leaf of many rows is many blocks; its visitors go to each of them
    blocks = spark.createDataFrame([(i, parts_for(int(s), settings.block_rows)) for i, s in enumerate(sizes)], "leaf int, blocks int")
    probes = probes.join(F.broadcast(blocks), "leaf").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    stored = indexed.join(F.broadcast(blocks), "leaf").withColumn("block", F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int"))

    parts, columns = ["leaf", "row", "id", "v"], [f.split(" ") for f in FOUND.split(", ")]

    def search(visitors: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(visitors) and len(own):
            at, ids, matrix = own["row"].to_numpy(), own["id"].to_numpy(), _matrix(own["v"])
            for row, query, vector in zip(visitors["row"].tolist(), visitors["id"].tolist(), _matrix(visitors["v"]), strict=True):
                found.extend((row, query, *near) for near in nearest_of(vector, at, ids, matrix, row, k))
        return pd.DataFrame(found, columns=[c for c, _ in columns]).astype({c: "float64" if t == "double" else "int64" for c, t in columns})

    met = probes.select("block", *parts).groupBy("leaf", "block").cogroup(stored.select("block", *parts).groupBy("leaf", "block"))
    return _top(met.applyInPandas(search, FOUND), k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")


def _calibrated(indexed: DataFrame, asked: DataFrame, tree: Tree, sizes: np.ndarray, settings: Settings) -> int:
    """Leaf visits that reach the recall on the first queries by hash."""
    chosen = [(r["row"], r["id"], r["v"]) for r in asked.orderBy(F.xxhash64("id"), "id", "row").limit(settings.calibration).collect()]
    if not chosen:
        return 1
    truth = scanned(indexed, chosen, settings.neighbours).join(indexed.select(F.col("row").alias("vec_row"), "leaf"), "vec_row")
    orders = {own: {leaf: i for i, leaf in enumerate(tree.visits(np.array(v), len(sizes), sizes, 0))} for own, _, v in chosen}
    # at most k places for each calibration query
    places = [orders[r["query_row"]][r["leaf"]] for r in truth.select("query_row", "leaf").collect()]
    return int(np.quantile(places, settings.recall, method="higher")) + 1 if places else 1
