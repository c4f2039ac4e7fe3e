"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A document's features are its distinct words, their stems (the first four bytes of longer words),
pairs of neighbours, and pairs with one word between, each hashed to ``2**bits`` places. Follow-the-regularised-leader keeps per place a sum of gradients
and one of their squares: the first is soft-thresholded by ``l1``, so places seen little stay zero,
the second sets the place's own learning rate. One learner goes through all of a bounded sample, in
one task, so that scores mean the same at any size; only places that are not zero reach the driver
and are broadcast, at most ``2**bits`` of them.

Defined results: a null or empty text has no features and gets the score of the bias; a null id is
not held out and not learnt from; null labels are not learnt from; without labels every score is
0.5; repeated rows are scored alike; an empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

import tempfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.llm.common import written
from tablesync.llm.labelled import fold, labelled_sample

_SEPARATORS = bytes(32 if not (b >= 128 or chr(b).isalnum() or b == 39) else b for b in range(256))
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


@dataclass(frozen=True)
class Ftrl:
    bits: int = 20
    alpha: float = 2.0
    beta: float = 1.0
    l1: float = 10.0
    l2: float = 0.0
    rounds: int = 6
    sample_rows: int = 12_000  # labelled rows learnt from, at most


STEM = 4


class WordHashes(dict):
    """Lower-case words to 32-bit hashes; emptied when it holds ``limit`` words."""

    limit = 400_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        self[word] = found = zlib.crc32(word)
        return found


class StemHashes(WordHashes):
    """Words to the hash of the word and, above it, that of its stem; no stem (0) for short words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        stem = zlib.crc32(word[:STEM], STEM) if len(word) > STEM else 0
        self[word] = found = zlib.crc32(word) | stem << 32
        return found


_hashes = StemHashes()  # one per Python worker


def places(text: str, bits: int) -> np.ndarray:
    """Hashed features of a text, with repeats; the last place is kept for the bias."""
    words = text.lower().encode("utf-8", "replace").translate(_SEPARATORS).split()
    both = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    h, stems = both & np.uint64(2**32 - 1), both >> np.uint64(32)
    found = [(h + np.uint64(1)) * _MIX[0], stems[stems > 0] * _MIX[3] + _MIX[1], h[:-1] * _MIX[1] + h[1:] * _MIX[2], h[:-2] * _MIX[3] + h[2:] * _MIX[4]]
    mixed = np.concatenate(found)
    mixed ^= mixed >> np.uint64(29)
    return ((mixed * _MIX[0]) >> np.uint64(64 - bits)).astype(np.int32) % np.int32(2**bits - 1)


class Learner:
    """Per-coordinate FTRL-proximal for logistic loss and binary features."""

    def __init__(self, settings: Ftrl):
        self.s, n = settings, 2**settings.bits
        self.z, self.n = np.zeros(n), np.zeros(n)

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, s = self.z[at], self.s
        shrunk = np.sign(z) * np.maximum(np.abs(z) - s.l1, 0.0)
        return -shrunk / ((s.beta + np.sqrt(self.n[at])) / s.alpha + s.l2)

    def learn(self, at: np.ndarray, y: int) -> None:
        w = self.weights(at)
        g = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35))) - y
        before = self.n[at]
        self.n[at] = before + g * g
        self.z[at] += g - (np.sqrt(before + g * g) - np.sqrt(before)) / self.s.alpha * w


def _features(sample: DataFrame, settings: Ftrl) -> DataFrame:
    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bias = 2**settings.bits - 1
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                found = [np.append(np.unique(places(t, settings.bits)), bias).astype("<i4").tobytes() for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.binary()), part.column(2)], names=["id", "at", "y"])

    schema = T.StructType([sample.schema["id"], T.StructField("at", T.BinaryType()), T.StructField("y", T.IntegerType())])
    return sample.mapInArrow(extract, schema)


def fit(sample: DataFrame, settings: Ftrl = Ftrl()) -> dict[int, float]:
    """Weights that are not zero, by place. ``sample`` has id, text, y."""
    examples = written(_features(sample, settings), "toxicity-sample")

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with tempfile.TemporaryFile() as spool:  # read once for each round; the places of long texts need not fit in memory
            sizes, y = [], []
            for batch in batches:
                for value in batch.column(1):
                    sizes.append(spool.write(value.as_py()) // 4)
                y += batch.column(2).to_pylist()
            if not y:
                return
            spool.flush()
            every, ends = np.memmap(spool, "<i4", "r"), np.cumsum(sizes)
            learner, random = Learner(settings), np.random.default_rng(1)
            for _ in range(settings.rounds):
                for i in random.permutation(len(y)):
                    learner.learn(np.array(every[ends[i] - sizes[i] : ends[i]]), y[i])
            del every
        used = np.flatnonzero(learner.z)
        w = learner.weights(used)
        yield pa.RecordBatch.from_arrays([pa.array(used[w != 0], pa.int32()), pa.array(w[w != 0])], names=["at", "w"])

    ordered = examples.coalesce(1).sortWithinPartitions("id", "y", "at")
    return {r["at"]: r["w"] for r in ordered.mapInArrow(train, "at int, w double").collect()}


def scored(docs: DataFrame, weights: dict[int, float], settings: Ftrl = Ftrl(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``score`` of every text: the sum of the weights of its distinct features, as a probability."""
    spark, bias = docs.sparkSession, 2**settings.bits - 1
    sent = spark.sparkContext.broadcast((np.array(list(weights), np.int32), np.array(list(weights.values()), np.float32)))
    schema = T.StructType([docs.schema[id_col], T.StructField("score", T.DoubleType())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense = np.zeros(2**settings.bits, np.float32)
        dense[sent.value[0]] = sent.value[1]
        known = dense != 0
        known[bias] = False
        for batch in batches:
            logits = np.full(batch.num_rows, float(dense[bias]))
            for i in range(batch.num_rows):
                at = places(batch.column(1)[i].as_py() or "", settings.bits)
                logits[i] += dense[np.unique(at[known[at]])].sum(dtype=float)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(1.0 / (1.0 + np.exp(-np.clip(logits, -35, 35))))], names=schema.names)

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(score, schema)


def toxicity_scores(
    spark: SparkSession, docs: DataFrame, labels: DataFrame, held_out: Column | None = None, threshold: float = 0.7,
    settings: Ftrl = Ftrl(),
) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted``. ``held_out`` is a condition over ``id``."""
    held_out = fold("id", 3) == 1 if held_out is None else held_out
    weights = fit(labelled_sample(docs, labels, "toxic", ~held_out, settings.sample_rows), settings)
    found = scored(docs.select(F.col("doc_id").alias("id"), "text"), weights, settings, "id")
    return found.select(
        F.col("id").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))
