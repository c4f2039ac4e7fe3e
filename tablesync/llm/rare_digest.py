"""Document fingerprints from improbable features.

Every window of 32 bytes has a level: its entropy in thousandths of the most a window can have.
Levels are ranked by how rare they are among all windows of the corpus, rarest first; windows under
``floor`` (runs and near-runs, rare but empty) come last. In each neighbourhood of ``near`` windows the
lowest rank wins, the leftmost at a tie; a window that wins ``least_wins`` neighbourhoods is a feature
(in a text without one, the window with most wins). Features depend on nearby bytes only, so a shared
passage gives the same features wherever it stands. Texts under 512 bytes have too few such windows:
they have features of 8 bytes as well, and under 128 bytes those alone. Each `Kind` of window has its
own ranks and filters, and texts are compared by the kinds that both have (an edit that keeps half a
text keeps a kind).

A feature is hashed into five bits of a 2048-bit Bloom filter. A filter takes 160 features, then the
next is chained, so a fingerprint grows with its text. Two filters are alike by their common bits beyond
what chance gives (and three standard deviations), over the most possible; two fingerprints by the mean,
over the features of the one with fewer filters, of each filter's best match in the other; of several
kinds the best counts.

The rarity table has 1,001 numbers a kind, counted over the whole corpus and summed before they are shuffled.
To meet its next document, a text is shuffled once, into parts that are ranges of the order: descending
id, then a hash of the text. Their bounds are quantiles; an id (or null) that many rows share has bounds
within its hashes. The first row of each part also goes to the end of the part before. Tasks read a part
as a stream of about ``Settings.together`` bytes.

Defined results: a null text is empty; an empty text has the empty fingerprint, which is like itself
(1) and nothing else (0); a text shorter than a window is one feature; equal texts have equal
fingerprints, of likeness 1; very long texts are measured in overlapping pieces with the same result as
in one; rows without id come last, rows of one id stand by their text's hash, equal rows after each
other; a lone row is its own next; an empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from math import log2

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tablesync.llm.common import parts_for

LEVELS = 1000
_BITS, _HASHES = 2048, 5
_SCALE = 1 << 20
_MIX = np.random.default_rng(13).integers(1, 2**63, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


@dataclass(frozen=True)
class Kind:
    """Windows for texts of ``low`` to below ``high`` bytes."""

    window: int
    near: int  # at most window: neighbourhoods then end where a text ends
    least_wins: int
    floor: int
    low: int = 0
    high: int = 1 << 62

    def __post_init__(self) -> None:
        if not 1 <= self.near <= self.window:
            raise ValueError("near must lie between 1 and window")

    def takes(self, text: bytes) -> bool:
        return self.low <= len(text) < self.high


@dataclass(frozen=True)
class Settings:
    kinds: tuple[Kind, ...] = (Kind(32, 32, 4, 300, low=128), Kind(8, 8, 2, 300, high=512))
    per_filter: int = 160
    together: int = 1 << 18
    part_bytes: int = 16 << 20
    parts_at_most: int = 20_000  # parts grow beyond this, as streams


@dataclass(frozen=True)
class Chain:
    """Features and bits of each filter."""

    sizes: tuple[int, ...] = ()
    filters: bytes = b""

    def __str__(self) -> str:
        step = _BITS // 8
        parts = (self.filters[i * step : (i + 1) * step] for i in range(len(self.sizes)))
        return ";".join(f"{n}:{base64.b64encode(bits).decode()}" for n, bits in zip(self.sizes, parts, strict=True))

    @staticmethod
    def parsed(text: str) -> Chain:
        parts = [part.split(":") for part in text.split(";")] if text else []
        return Chain(tuple(int(n) for n, _ in parts), b"".join(base64.b64decode(bits) for _, bits in parts))


Fingerprint = tuple[Chain, ...]  #: a chain for each kind, without filters where the text is not of it


def told(own: Fingerprint) -> str:
    return "|".join(map(str, own)) if any(chain.sizes for chain in own) else ""


def parsed(text: str, settings: Settings = Settings()) -> Fingerprint:
    return tuple(map(Chain.parsed, text.split("|"))) if text else (Chain(),) * len(settings.kinds)


def levels(text: np.ndarray, window: int) -> np.ndarray:
    """The level of each window of a byte array, by sums of c log2 c that change by two terms a step.

    Sums are whole numbers, so a window has one level wherever it stands."""
    n = len(text)
    if n < window:
        return np.zeros(0, np.int64)
    whole = np.array([round(c * log2(c) * _SCALE) if c else 0 for c in range(window + 2)], np.int64)
    gain = np.diff(whole, prepend=0)
    before, after = np.ones(n, np.uint8), np.ones(n, np.uint8)  # equal bytes among the window before and after, with itself
    for lag in range(1, window + 1):
        same = (text[lag:] == text[:-lag]).view(np.uint8)
        before[lag:] += same
        after[: n - lag] += same
    sums = np.empty(n - window + 1, np.int64)
    sums[0] = whole[np.bincount(text[:window], minlength=256)].sum()
    sums[1:] = gain[before[window:]] - gain[after[: n - window]]
    np.cumsum(sums, out=sums)
    most = window * log2(window) * _SCALE
    return np.clip((most - sums) * LEVELS // most, 0, LEVELS).astype(np.int64)


def rarity(counts: Sequence[int], floor: int) -> np.ndarray:
    """The rank of each level, by how many windows have it; levels under the floor last."""
    order = sorted(range(LEVELS + 1), key=lambda level: (level < floor, counts[level], level))
    ranks = np.empty(LEVELS + 1, np.int64)
    ranks[order] = np.arange(LEVELS + 1)
    return ranks


@dataclass(frozen=True)
class _Piece:
    """Windows ``low`` to ``high`` of a text are decided here; bytes from ``start`` are at ``at``."""

    doc: int
    start: int
    low: int
    high: int
    windows: int  # of the whole text


def _pieces(texts: list[bytes], s: Kind, together: int) -> Iterator[tuple[list[_Piece], np.ndarray, np.ndarray]]:
    """Texts joined to buffers of about ``together`` bytes, long ones cut with what decides at the edges."""
    held, bodies, size = [], [], 0
    for doc, text in enumerate(texts):
        windows = len(text) - s.window + 1
        for low in range(0, windows, together):
            high = min(low + together, windows)
            start, stop = max(0, low - s.near + 1), min(len(text), high + s.near + s.window - 2)
            held.append(_Piece(doc, start, low, high, windows))
            bodies.append(text[start:stop])
            size += stop - start
            if size >= together:
                yield held, *_joined(bodies)
                held, bodies, size = [], [], 0
    if held:
        yield held, *_joined(bodies)


def _joined(bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(bodies), np.uint8), np.cumsum([0, *map(len, bodies)])


def _features(texts: list[bytes], ranks: np.ndarray, s: Kind, together: int) -> list[np.ndarray]:
    """Hashes of each text's features, in order."""
    found: list[list[np.ndarray]] = [[] for _ in texts]
    best: dict[int, tuple[int, np.ndarray]] = {}  # texts without a feature yet: most wins, and that window
    for pieces, buffer, offsets in _pieces(texts, s, together):
        key = ranks[levels(buffer, s.window)] << 32 | np.arange(len(buffer) - s.window + 1)
        starts, owner = [], np.full(len(key), -1, np.int64)
        for k, (piece, at, end) in enumerate(zip(pieces, offsets, offsets[1:], strict=False)):
            key[end - s.window + 1 : end] = np.iinfo(np.int64).max  # windows that leave the piece
            shift = at - piece.start
            owner[piece.low + shift : piece.high + shift] = k
            first = max(0, piece.low - s.near + 1)
            last = min(piece.high - 1, max(piece.windows - s.near, 0))
            starts.append(np.arange(first + shift, last + shift + 1))
        low, width = key, 1  # the least key of ever wider neighbourhoods
        while width < s.near:
            step = min(width, s.near - width)
            low = np.minimum(low, np.append(low[step:], np.full(min(step, len(low)), np.iinfo(np.int64).max)))
            width += step
        winners = low[np.concatenate(starts)] & 0xFFFFFFFF
        wins = np.bincount(winners, minlength=len(key))
        wins[owner < 0] = 0
        chosen = np.flatnonzero(wins >= s.least_wins)
        piece_of = owner[chosen]
        cuts = np.searchsorted(piece_of, np.arange(len(pieces) + 1))
        hashes = _hashed(buffer, chosen, s.window)
        for k, piece in enumerate(pieces):
            if cuts[k + 1] > cuts[k]:
                found[piece.doc].append(hashes[cuts[k] : cuts[k + 1]])
            elif not found[piece.doc]:
                shift = offsets[k] - piece.start
                part = wins[piece.low + shift : piece.high + shift]
                top = int(part.argmax())
                if int(part[top]) > best.get(piece.doc, (-1, None))[0]:
                    best[piece.doc] = int(part[top]), _hashed(buffer, np.array([top + piece.low + shift]), s.window)
    out = []
    for doc, text in enumerate(texts):
        if found[doc]:
            own = np.concatenate(found[doc])
            _, first = np.unique(own, return_index=True)
            out.append(own[np.sort(first)])
        elif doc in best:
            out.append(best[doc][1])
        else:
            out.append(np.array([xxhash.xxh64_intdigest(text)] if text else [], np.uint64))
    return out


def _hashed(buffer: np.ndarray, at: np.ndarray, window: int) -> np.ndarray:
    h = np.full(len(at), window, np.uint64)
    for i in range(0, window, 8):
        some = min(8, window - i)
        word = np.zeros((len(at), 8), np.uint8)
        word[:, :some] = buffer[at[:, None] + np.arange(i, i + some)]
        h = (h ^ word.view(np.uint64)[:, 0]) * _MIX[i // 8 % 4]
        h ^= h >> np.uint64(29)
    h = (h ^ (h >> np.uint64(31))) * _MIX[4]
    return h ^ (h >> np.uint64(32))


def fingerprints(texts: list[bytes], ranks: Sequence[np.ndarray], settings: Settings = Settings()) -> list[Fingerprint]:
    """``ranks`` are those of each kind."""
    chains = []
    for kind, own in zip(settings.kinds, ranks, strict=True):
        at = [i for i, text in enumerate(texts) if kind.takes(text)]
        of_kind = [Chain()] * len(texts)
        for i, features in zip(at, _features([texts[i] for i in at], own, kind, settings.together), strict=True):
            of_kind[i] = _chain(features, settings.per_filter)
        chains.append(of_kind)
    return list(zip(*chains, strict=True))


def _chain(features: np.ndarray, per_filter: int) -> Chain:
    which = np.arange(len(features)) // per_filter
    bits = np.zeros((-(-len(features) // per_filter), _BITS), np.uint8)
    for k in range(_HASHES):
        bits[which, (features >> np.uint64(11 * k)) & np.uint64(_BITS - 1)] = 1
    return Chain(tuple(np.bincount(which).tolist()), np.packbits(bits, axis=1).tobytes())


def likeness(a: Fingerprint, b: Fingerprint) -> float:
    """0 to 1, by the best of the kinds that both have; equal fingerprints are wholly alike."""
    return 1.0 if a == b else max(_alike(x, y) for x, y in zip(a, b, strict=True))


def _alike(a: Chain, b: Chain) -> float:
    """The mean over the smaller chain's features of its filters' best matches."""
    if not (a.sizes and b.sizes):
        return 0.0
    if len(a.sizes) == len(b.sizes):
        return max(_covered(a, b), _covered(b, a))
    return _covered(a, b) if len(a.sizes) < len(b.sizes) else _covered(b, a)


def _covered(a: Chain, b: Chain) -> float:
    x, y = (np.frombuffer(f.filters, np.uint64).reshape(len(f.sizes), -1) for f in (a, b))
    set_x, set_y = (np.bitwise_count(f).sum(axis=1).astype(float) for f in (x, y))
    total = 0.0
    for row, own, size in zip(x, set_x, a.sizes, strict=True):
        common = np.bitwise_count(row & y).sum(axis=1)
        chance = own * set_y / _BITS
        chance += 3 * np.sqrt(chance * (1 - own / _BITS) * (1 - set_y / _BITS))
        most = np.minimum(own, set_y)
        beyond = (common - chance) / np.maximum(most - chance, 1e-9)
        total += size * float(np.where(most > chance, np.clip(beyond, 0, 1), 0).max())
    return total / sum(a.sizes)


# -- over a table ---------------------------------------------------------


def measured(docs: DataFrame, settings: Settings = Settings(), text_col: str = "text") -> tuple[list[np.ndarray], int]:
    """(windows of each level, for each kind; bytes) over all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, size = np.zeros((len(settings.kinds), LEVELS + 1), np.int64), 0
        for batch in batches:
            for held in _together(batch.column(0), settings.together):
                size += sum(map(len, held))
                for kind, total in zip(settings.kinds, counts, strict=True):
                    for pieces, buffer, offsets in _pieces([t for t in held if kind.takes(t)], kind, settings.together):
                        level = levels(buffer, kind.window)
                        counted = np.zeros(len(level), bool)
                        for piece, at in zip(pieces, offsets, strict=False):
                            counted[piece.low - piece.start + at : piece.high - piece.start + at] = True
                        total += np.bincount(level[counted], minlength=LEVELS + 1)
        yield pa.RecordBatch.from_arrays([pa.array([*range(counts.size), -1]), pa.array([*counts.ravel().tolist(), size])], names=["level", "n"])

    rows = docs.select(F.coalesce(text_col, F.lit("")).alias("t")).mapInArrow(count, "level long, n long")
    total = {r["level"]: r["n"] for r in rows.groupBy("level").agg(F.sum("n").alias("n")).collect()}  # 1,001 rows a kind
    counts = np.array([total.get(i, 0) for i in range(len(settings.kinds) * (LEVELS + 1))], np.int64)
    return list(counts.reshape(len(settings.kinds), -1)), total.get(-1, 0)


def _together(column: pa.Array, size: int) -> Iterator[list[bytes]]:
    held, bytes_ = [], 0
    for value in column:
        held.append(value.as_buffer().to_pybytes() if value.is_valid else b"")
        bytes_ += len(held[-1])
        if bytes_ >= size:
            yield held
            held, bytes_ = [], 0
    yield held


def _parts(rows: DataFrame, n: int) -> DataFrame:
    """``rows`` (id, text, tie) with ``part``, a range of the order that the part's number follows."""
    sizes = rows.agg(F.count("*").alias("n"), F.count("id").alias("named")).first()
    quantiles = [i / n for i in range(1, n)]
    bounds = rows.where("id is not null").agg(F.percentile_approx("id", quantiles, 10 * n)).first()[0] if n > 1 and sizes["named"] else []
    down = -np.sort(np.array(bounds or [], np.float64))[::-1]  # ids as floats: only where parts end depends on it
    unnamed = max(1, round(n * (1 - sizes["named"] / max(sizes["n"], 1))))

    @pandas_udf("long")
    def part(own, tie):
        share = (tie.to_numpy(np.float64) + 2.0**63) / 2.0**64
        named = own.notna().to_numpy()
        value = -own.fillna(0).to_numpy(np.float64)
        low, high = np.searchsorted(down, value, "left"), np.searchsorted(down, value, "right")
        split = np.where(named, high - low, unnamed)
        inner = 1 + np.minimum((share * split).astype(np.int64), split - 1)
        return pd.Series(np.where(named, low, len(down)) + np.where(split > 0, inner, 0))

    return rows.withColumn("part", part("id", "tie"))


def compared(docs: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document its fingerprint and that of its edited text, whose second half comes from the
    start of the next document in descending order of id, and how like it both and the next are."""
    counts, size = measured(docs, settings, text_col)
    ranks = [rarity(own, kind.floor) for own, kind in zip(counts, settings.kinds, strict=True)]
    n = min(parts_for(size, settings.part_bytes), settings.parts_at_most)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    rows = _parts(rows.withColumn("tie", F.xxhash64("text")), n)
    firsts = rows.groupBy("part").agg(F.max(F.struct("id", F.bitwise_not("tie"))).alias("first")).collect()  # a row a part
    order = sorted((r["part"], *r["first"]) for r in firsts)
    before = [(own, ~tie, order[i - 1][0]) for i, (_, own, tie) in enumerate(order)]
    first = rows.sparkSession.createDataFrame(before, "own long, own_tie long, to long")
    ghosts = rows.join(F.broadcast(first), rows["id"].eqNullSafe(first["own"]) & (rows["tie"] == first["own_tie"]))
    both = rows.withColumn("ghost", F.lit(0)).unionByName(ghosts.select("id", "text", "tie", F.col("to").alias("part"), F.lit(1).alias("ghost")))
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _runs(batches, settings.together):
            texts = [text for _, text in held]
            edits = [a[: len(a) - len(a) // 2] + b[: len(a) // 2] for a, b in zip(texts, texts[1:], strict=False)]
            raw = [e.encode("utf-8", "replace") for e in edits]
            made = fingerprints([t.encode("utf-8", "replace") for t in texts] + raw, ranks, settings)
            own, edited = made[: len(texts)], made[len(texts) :]
            yield pa.RecordBatch.from_arrays([
                pa.array([i for i, _ in held[:-1]], pa.int64()), pa.array([len(t) for t in texts[:-1]], pa.int64()),
                pa.array([hashlib.sha256(e).hexdigest() for e in raw]), pa.array([told(f) for f in own[:-1]]), pa.array([told(f) for f in edited]),
                pa.array([likeness(a, b) for a, b in zip(own, edited, strict=False)], pa.float64()),
                pa.array([likeness(a, b) for a, b in zip(own, own[1:], strict=False)], pa.float64()),
            ], schema=arrow)

    arrow = pa.schema([(c.split()[0], {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}[c.split()[1]]) for c in schema.split(", ")])
    tasks = order[-1][0] + 1 if order else 1
    placed = both.repartitionById(tasks, F.col("part").cast("int")).sortWithinPartitions("part", "ghost", F.col("id").desc_nulls_last(), "tie", "text")
    return placed.select("part", "ghost", "id", "text").mapInArrow(run, schema)


def _runs(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[list[tuple[int | None, str]]]:
    """Documents that follow each other, about ``size`` bytes at a time; the last is there as the next
    one only, and begins the next run. Of a part's ghosts the first counts."""
    held, bytes_, part, closed = [], 0, None, False
    for batch in batches:
        columns = [batch.column(c) for c in range(4)]
        for i in range(batch.num_rows):
            here, ghost, own, text = (column[i].as_py() for column in columns)
            if here != part:
                if len(held) > 1:
                    yield held
                held, bytes_, part, closed = [], 0, here, False
            if closed:
                continue
            held.append((own, text))
            closed, bytes_ = bool(ghost), bytes_ + len(text)
            if bytes_ >= size and len(held) > 1:
                yield held
                held, bytes_ = held[-1:], len(text)
    if len(held) > 1:
        yield held
