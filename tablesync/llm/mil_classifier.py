"""Quality by attention-based multiple-instance learning.

A document is a bag of passages of ``passage_words`` words. Every passage is measured (shares of
character classes, repeats, new and common words, word lengths) and encoded by a small network; gated
attention, softmax(w . (tanh(V h) * sigmoid(U h))), weights the passages, and the weighted mean of
their codes is scored. Only documents have labels; which passages matter is learnt from them.

The network is fitted on a bounded, hashed sample whose measures (not texts) reach the driver, and is
broadcast: a few thousand numbers. Every whole text is scored in one pass, without a shuffle.

Defined results: a null or empty text is one passage of zeros; a null id is not held out and not
learnt from; null labels are not learnt from; without labels every score is 0.5; repeated rows are
scored alike; an empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.llm.labelled import fold, labelled_sample
from tablesync.llm.toxicity import WordHashes

_hashes = WordHashes()  # one per Python worker


def _classes() -> np.ndarray:
    """Class of each byte: lower, upper, digit, space, stop, symbol, other mark, not ASCII, line end."""
    kind = np.full(256, 6)
    for i, own in ((0, range(97, 123)), (1, range(65, 91)), (2, range(48, 58)), (3, b" \t\r\x0b\x0c"), (4, b".,;:!?'\"()-"),
                   (5, b"#*$%&|<>"), (7, range(128, 256)), (8, b"\n")):
        kind[list(own)] = i
    return kind


_KIND = _classes()
_SPACE = np.isin(_KIND, (3, 8))
FEATURES = 20


@dataclass(frozen=True)
class Settings:
    passage_words: int = 64
    hidden: int = 24
    attention: int = 12
    rounds: int = 40
    batch: int = 128
    rate: float = 0.01
    sample_rows: int = 6_000  # labelled rows learnt from, at most
    seed: int = 3


def passages(text: str, size: int) -> np.ndarray:
    """A row of measures for each passage."""
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    inside = ~_SPACE[raw]
    starts = np.flatnonzero(inside & np.append(True, ~inside[:-1])) if len(raw) else np.zeros(0, np.int64)
    n = len(starts)
    if n == 0:
        return np.zeros((1, FEATURES), np.float32)
    words = raw.tobytes().split()
    h = np.fromiter(map(_hashes.__getitem__, words), np.int64, n)
    first = np.arange(0, n, size)
    counts = np.diff(np.append(first, n))
    begin = starts[first]
    begin[0] = 0
    length = np.diff(np.append(begin, len(raw)))
    out = np.zeros((len(first), FEATURES), np.float32)
    kinds = _KIND[raw]
    for i in range(9):
        out[:, i] = np.add.reduceat(kinds == i, begin, dtype=np.int64) / length

    def share(flags: np.ndarray) -> np.ndarray:
        return np.add.reduceat(flags, first, dtype=np.int64) / counts

    for i, lag in enumerate((1, 2, 3)):
        out[:, 9 + i] = share(np.append(np.zeros(min(lag, n), bool), h[lag:] == h[:-lag]))
    _, where, inverse, times = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
    new = np.zeros(n, bool)
    new[where] = True
    out[:, 12] = share(new)
    out[:, 13] = share(times[inverse] > 3)
    lengths = np.fromiter(map(len, words), np.float64, n)
    mean = np.add.reduceat(lengths, first) / counts
    out[:, 14] = mean / 10
    out[:, 15] = np.sqrt(np.maximum(np.add.reduceat(lengths * lengths, first) / counts - mean * mean, 0)) / 10
    out[:, 16] = share(lengths <= 3)
    out[:, 17] = share(lengths > 20)
    out[:, 18] = np.log1p(counts) / 5
    out[:, 19] = np.log1p(n) / 10
    return out


class Network:
    """Encoder, gated attention and score, with gradients by hand."""

    def __init__(self, weights: dict[str, np.ndarray]):
        self.w = weights

    @staticmethod
    def fresh(s: Settings, mean: np.ndarray, scale: np.ndarray) -> Network:
        r = np.random.default_rng(s.seed)
        made = {"E": (FEATURES, s.hidden), "V": (s.hidden, s.attention), "U": (s.hidden, s.attention)}
        w = {k: r.normal(0, 1 / np.sqrt(shape[0]), shape) for k, shape in made.items()}
        w |= {"e": np.zeros(s.hidden), "a": r.normal(0, 0.3, s.attention), "c": r.normal(0, 0.3, s.hidden), "b": np.zeros(1)}
        return Network(w | {"mean": mean, "scale": scale})

    def forward(self, x: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
        """Scores of the bags that begin at the rows ``first``, and what the gradients need."""
        w = self.w
        x = np.clip((x - w["mean"]) / w["scale"], -6, 6)
        bag = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(x))))
        h = np.tanh(x @ w["E"] + w["e"])
        t, g = np.tanh(h @ w["V"]), 1 / (1 + np.exp(-(h @ w["U"])))
        raw = (t * g) @ w["a"]
        power = np.exp(raw - np.maximum.reduceat(raw, first)[bag])
        att = power / np.add.reduceat(power, first)[bag]
        z = np.add.reduceat(att[:, None] * h, first, axis=0)
        score = 1 / (1 + np.exp(-np.clip(z @ w["c"] + w["b"][0], -35, 35)))
        return score, {"x": x, "bag": bag, "h": h, "t": t, "g": g, "att": att, "z": z}

    def gradients(self, x: np.ndarray, first: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        w = self.w
        score, f = self.forward(x, first)
        d = (score - y) / len(y)
        dz = d[:, None] * w["c"]
        h, att, bag = f["h"], f["att"], f["bag"]
        datt = (dz[bag] * h).sum(axis=1)
        draw = att * (datt - np.add.reduceat(att * datt, first)[bag])
        dt, dg = draw[:, None] * w["a"] * f["g"] * (1 - f["t"] ** 2), draw[:, None] * w["a"] * f["t"] * f["g"] * (1 - f["g"])
        dh = att[:, None] * dz[bag] + dt @ w["V"].T + dg @ w["U"].T
        dpre = dh * (1 - h * h)
        return {
            "E": f["x"].T @ dpre, "e": dpre.sum(axis=0), "V": h.T @ dt, "U": h.T @ dg, "a": (f["t"] * f["g"]).T @ draw,
            "c": f["z"].T @ d, "b": np.array([d.sum()]),
        }


def fit(bags: list[np.ndarray], y: np.ndarray, s: Settings = Settings()) -> Network | None:
    """Adam over shuffled batches of bags; None without bags of both labels."""
    if len(bags) == 0 or len(set(y.tolist())) < 2:
        return None
    rows = np.concatenate(bags)
    net = Network.fresh(s, rows.mean(axis=0), rows.std(axis=0) + 0.01)
    random, step = np.random.default_rng(s.seed), 0
    m, v = ({k: np.zeros_like(x) for k, x in net.w.items()} for _ in range(2))
    for turn in range(s.rounds):
        rate = s.rate * (1 - turn / s.rounds) + 1e-4
        order = random.permutation(len(bags))
        for at in range(0, len(order), s.batch):
            own = order[at : at + s.batch]
            x = np.concatenate([bags[i] for i in own])
            first = np.cumsum([0, *[len(bags[i]) for i in own[:-1]]])
            step += 1
            for k, g in net.gradients(x, first, y[own]).items():
                g = g + 1e-4 * net.w[k]
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                net.w[k] = net.w[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return net


def _bags(docs: DataFrame, s: Settings, id_col: str, text_col: str, label: str) -> tuple[list[np.ndarray], np.ndarray]:
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [passages(t or "", s.passage_words).astype("<f4").tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.string()), pa.array(rows, pa.binary()), batch.column(2)], names=["id", "x", "y"])

    found = docs.select(id_col, text_col, label).mapInArrow(measure, "id string, x binary, y int").collect()
    found.sort(key=lambda r: (r["id"] or "", r["x"], r["y"]))  # the same sample gives the same network
    return [np.frombuffer(r["x"], "<f4").reshape(-1, FEATURES) for r in found], np.array([r["y"] for r in found], float)


def scored(docs: DataFrame, net: Network | None, s: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``score`` of every text, and ``focus``, the number of the passage with the largest weight."""
    sent = docs.sparkSession.sparkContext.broadcast(None if net is None else net.w)
    schema = T.StructType([docs.schema[id_col], T.StructField("score", T.DoubleType()), T.StructField("focus", T.IntegerType())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None if sent.value is None else Network(sent.value)
        for batch in batches:
            for start in range(0, batch.num_rows, 128):
                part = batch.slice(start, 128)
                bags = [passages(t or "", s.passage_words) for t in part.column(1).to_pylist()]
                first = np.cumsum([0, *[len(b) for b in bags[:-1]]])
                if own is None:
                    found, focus = np.full(len(bags), 0.5), np.zeros(len(bags))
                else:
                    found, f = own.forward(np.concatenate(bags), first)
                    found = np.round(found, 12)  # sums over a batch may differ in their last bits
                    focus = [int(np.argmax(a)) for a in np.split(f["att"], first[1:])]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.float64()), pa.array(focus, pa.int32())], names=schema.names)

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(score, schema)


def quality_scores(
    spark: SparkSession, docs: DataFrame, labels: DataFrame, held_out: Column | None = None, threshold: float = 0.3,
    settings: Settings = Settings(),
) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted``, ``focus``. ``held_out`` is a condition over ``id``."""
    held_out = fold("id", 5) == 0 if held_out is None else held_out
    sample = labelled_sample(docs, labels, "quality", ~held_out, settings.sample_rows)
    net = fit(*_bags(sample, settings, "id", "text", "y"), settings)
    found = scored(docs.select(F.col("doc_id").alias("id"), "text"), net, settings, "id")
    return found.select(
        F.col("id").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"), "focus")
