"""N-gram Jaccard self-join by parity sketches.

A document's set is its distinct word shingles, as 64-bit hashes. A sketch is made by XOR: the hashes
are dealt into G blocks and each block keeps the XOR of its own, so every shingle that only one of
two documents has changes at most one block, and the number of differing blocks is at most the
symmetric difference. Two linked documents whose smaller one lies in a size band differ in at most d
shingles, so of the blocks that hold something in one of them all but d are equal in both. Put in one
order for all documents (most shingles first, as those say most, then by hash), the first common block
is among the first d + 1 of each: documents are joined on those d + 1 blocks of the band's grouping, d
being taken for the document's own size (a document also joins the band below, for smaller partners).
Bands double in width; G is a little over d at the band's upper end. That makes 0.25 to 0.5 keys
a shingle at 80 %, each of several shingles.

Only two documents that both have at most d blocks with anything in them could miss each other. Such
documents, one in a hundred or fewer (`weak_share` in the tests), also join on the prefix of their
sorted hashes, the usual prefix filter, which is exact. No pair is lost.

Pairs are never enumerated within a group. First each document meets the smallest of each of its
blocks, and the pair that a 1024-bit parity sketch (its Hamming distance bounds the symmetric
difference from below) calls closest is verified on the sets. Blocks whose documents are then one
component are done. In the others all pairs across components pass the sketch; the closest of each
two components are verified, more in every round, until every such pair has been refuted or joined.

Defined results: a null or empty text, or one without words, has no shingles and its own id as
component; fewer words than the width are one shingle; equal sets are one node, so copies cost one
row; rows with equal ids are one document; a row without id is in the component of an equal set that
has one, or null; an empty table gives no rows; other columns are left out; ids are whole numbers. Very
long texts are sets like others. Sets are verified by all 64 bits of their hashes. Tables between the
steps are deleted as soon as their successor is written.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.llm.common import released, tidied, written
from tablesync.llm.components import components

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_ODD = np.random.default_rng(2024).integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SKETCH_BITS = 1024
#: Ids of documents that share a key, up to which they are broadcast to find their texts: 8 bytes
#: each. More are joined by shuffle.
BROADCAST_IDS = 2_000_000


@dataclass(frozen=True)
class Likeness:
    """Documents link when ``of * |A and B| >= least * |A or B|`` over sets of ``width`` words."""

    width: int = 5
    least: int = 80
    of: int = 100

    def differ(self, a: int, b: int) -> int:
        """Most shingles that only one of two linked sets of these sizes has."""
        return (a + b) * (self.of - self.least) // (self.of + self.least)

    def partner(self, a: int) -> int:
        """Largest size of a set that links with one of size a."""
        return a * self.of // self.least


@dataclass(frozen=True)
class Band:
    number: int
    low: int
    high: int
    blocks: int

    def apart(self, n: int, rule: Likeness) -> int:
        """Most shingles by which a set of size n differs from a partner, where the smaller one is of this band."""
        return rule.differ(n, rule.partner(n)) if n <= self.high else rule.differ(self.high, n)


def bands(rule: Likeness, upto: int) -> list[Band]:
    """Size bands of the smaller partner, each twice as wide as the one below."""
    made, low = [], 1
    while low <= upto:
        high = 2 * low - 1
        d = rule.differ(high, rule.partner(high))
        made.append(Band(len(made), low, high, d + 1 + max(2, d * 15 // 100) if d else 0))
        low = high + 1
    return made


def _mix(x: np.ndarray, k: int) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _ODD[k]
    return x ^ (x >> np.uint64(29))


class _Words(dict):
    """64-bit hashes of words; emptied when it holds 400,000."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 400_000:
            self.clear()
        self[word] = found = xxhash.xxh64_intdigest(word)
        return found


_words = _Words()  # one per Python worker, emptied after each task


def forget_words() -> None:
    _words.clear()


def shingles(text: str, width: int) -> np.ndarray:
    """Distinct hashed shingles, ascending."""
    words = text.encode("utf-8", "replace").translate(_LOWER).split()
    h = np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
    n = max(len(h) - width + 1, min(len(h), 1))
    if not n:
        return h
    if len(h) < width:
        total = (h * _ODD[: len(h)]).sum(dtype=np.uint64, keepdims=True) + _ODD[40 + len(h)]
        return _mix(total, 32)
    total = h[:n] * _ODD[0]
    for i in range(1, width):
        total = total + h[i : n + i] * _ODD[i]
    return np.unique(_mix(total, 32))


def parity(own: np.ndarray) -> bytes:
    """The bit sketch: each shingle flips one bit."""
    bit = (_mix(own, 33) >> np.uint64(54)).astype(np.int64)
    return np.packbits(np.bincount(bit, minlength=_SKETCH_BITS).astype(np.uint8) & 1).tobytes()


def join_keys(own: np.ndarray, rule: Likeness, layout: list[Band]) -> np.ndarray:
    """Blocks a set joins on, as 64-bit keys that hold band and block."""
    keys, weak = block_keys(own, rule, layout)
    if weak:
        n = len(own)
        prefix = n - (n * rule.least + rule.of - 1) // rule.of + 1
        keys.append(_mix(own[:prefix], 37))
    return np.unique(np.concatenate(keys)) if keys else own[:0]


def block_keys(own: np.ndarray, rule: Likeness, layout: list[Band]) -> tuple[list[np.ndarray], bool]:
    """The first blocks of each band, and whether some band has too few blocks with anything in them."""
    n = len(own)
    keys, weak = [], False
    for band in layout[: n.bit_length()]:
        if not band.blocks or rule.partner(band.high) < n:  # without blocks only equal sets link
            continue
        block = (_mix(own, 34 + band.number % 4) >> np.uint64(33)) % np.uint64(band.blocks)
        order = np.argsort(block, kind="stable")
        which, first, held = np.unique(block[order], return_index=True, return_counts=True)
        sketch = np.bitwise_xor.reduceat(_mix(own[order], 38), first)
        tag = which * np.uint64(1024) + np.uint64(band.number + 1)
        key = _mix(sketch ^ _mix(tag, 39), 36)
        d = band.apart(n, rule)
        weak |= len(key) <= d
        keys.append(key[np.lexsort((key, -held))[: d + 1]])
    return keys, weak


def _sums(own: np.ndarray) -> tuple[int, int]:
    """Two hashes of a whole set."""
    return int(_mix(own, 30).sum(dtype=np.uint64).view(np.int64)), int(np.bitwise_xor.reduce(_mix(own, 31)).view(np.int64))


def _sets(docs: DataFrame, rule: Likeness, id_col: str, text_col: str) -> DataFrame:
    """Per row: id, n, two hashes of the whole set, and keys (of a set's first row in a task)."""
    layout = bands(rule, 1 << 31)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                rows = []
                for own_id, value in zip(part.column(0), part.column(1), strict=True):
                    own = shingles(value.as_py() or "", rule.width)
                    if not len(own):
                        rows.append((0, 0, 0, None))
                        continue
                    sums = _sums(own)
                    new = own_id.is_valid and sums not in seen
                    if new:
                        seen.add(sums)
                    rows.append((len(own), *sums, join_keys(own, rule, layout).view(np.int64) if new else None))
                n, s1, s2, keys = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).cast(pa.int64()), pa.array(n, pa.int64()), pa.array(s1, pa.int64()), pa.array(s2, pa.int64()),
                     pa.array(keys, pa.list_(pa.int64()))], names=["id", "n", "s1", "s2", "keys"])

    schema = "id long, n long, s1 long, s2 long, keys array<long>"
    return written(docs.select(F.col(id_col), F.col(text_col)).mapInArrow(tidied(measure, forget_words), schema), "shingle-sets")


def _shared_keys(sets: DataFrame, parts: int) -> DataFrame:
    """(key, s1, s2) of keys that more than one set has. Runs of equal keys are streamed, not gathered."""
    rows = sets.where("keys is not null").select(F.explode("keys").alias("key"), F.xxhash64("s1", "s2").alias("set"), "id")

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []  # the last row of what came before, and whether its run was given out

        def out(key: np.ndarray, node: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(node, pa.int64())], names=["key", "node"])

        last_key, last_set, last_id, given = None, 0, 0, False
        for batch in batches:
            if not batch.num_rows:
                continue
            key, own, node = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            if last_key is not None:  # the row before joins the batch, to compare it
                key, own, node = np.append(last_key, key), np.append(last_set, own), np.append(last_id, node)
            new = np.append(True, (key[1:] != key[:-1]) | (own[1:] != own[:-1]))  # first row of each set within its key
            at = np.flatnonzero(new)
            k = key[at]
            same_before = np.append(False, k[1:] == k[:-1])
            same_after = np.append(k[1:] == k[:-1], False)
            give = same_before | same_after
            if given:
                give[0] = False
            rows = at[give]
            if len(rows):
                yield out(key[rows], node[rows])
            given = bool(give[-1]) or (given and len(at) == 1)
            last_key, last_set, last_id = key[at[-1]], own[at[-1]], node[at[-1]]

    sorted_ = rows.repartition(parts, "key").sortWithinPartitions("key", "set", "id")
    return sorted_.select("key", "set", "id").mapInArrow(shared, "key long, node long")


def _involved(docs: DataFrame, ids: DataFrame, rule: Likeness, id_col: str, text_col: str) -> DataFrame:
    """(id, s1, s2, n, sketch, hashes) of the documents ``ids``: their sets are made again rather than kept for all."""
    few = ids.count() <= BROADCAST_IDS
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    texts = texts.join(F.broadcast(ids) if few else ids.hint("shuffle_hash"), "id")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                rows = []
                for own_id, value in zip(part.column(0).to_pylist(), part.column(1), strict=True):
                    own = shingles(value.as_py() or "", rule.width)
                    if len(own):
                        rows.append((own_id, *_sums(own), len(own), parity(own), own.astype("<u8").tobytes()))
                columns = list(zip(*rows, strict=True)) or [[]] * 6
                kinds = [pa.int64()] * 4 + [pa.binary()] * 2
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["id", "s1", "s2", "n", "sketch", "hashes"])

    schema = "id long, s1 long, s2 long, n long, sketch binary, hashes binary"
    return texts.select("id", "text").mapInArrow(tidied(measure, forget_words), schema).dropDuplicates(["id", "s1", "s2"])


def _verified(pairs: DataFrame, sets: DataFrame, rule: Likeness) -> DataFrame:
    """The pairs (a, b) that link. Each pair brings one set to the other's rows; the join may be split."""
    own = sets.select("id", "n", "hashes")
    left = pairs.join(own.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("hashes").alias("ha")), "a")
    both = left.join(own.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("hashes").alias("hb")), "b")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                p, q = np.frombuffer(x.as_py(), "<u8"), np.frombuffer(y.as_py(), "<u8")
                shared = len(np.intersect1d(p, q, assume_unique=True))
                good.append(rule.of * shared >= rule.least * (len(p) + len(q) - shared))
            yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))

    return both.select("a", "b", "ha", "hb").mapInArrow(check, "a long, b long").distinct()


def _possible(n1, n2, apart, rule: Likeness):
    """Whether sizes and the Hamming distance allow a link (columns or arrays)."""
    return apart * (rule.of + rule.least) <= (n1 + n2) * (rule.of - rule.least)


_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).sum(axis=1).astype(np.int64)


def _first_pairs(shared: DataFrame, sets: DataFrame, rule: Likeness) -> DataFrame:
    """Of the smallest documents that each one shares a key with, the closest by sketch: (a, b)."""
    low = shared.groupBy("key").agg(F.min("node").alias("b"))
    pairs = shared.join(low, "key").where("node != b").groupBy(F.col("node").alias("a"), "b").agg(F.count("*").alias("keys"))
    # the three with which it shares most keys are measured
    best = pairs.groupBy("a").agg(F.slice(F.sort_array(F.collect_set(F.struct((-F.col("keys")).alias("k"), "b"))), 1, 3).alias("few"))
    few = best.select("a", F.explode("few.b").alias("b"))
    own = sets.select("id", "n", "sketch")
    few = few.join(own.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa")), "a")
    few = few.join(own.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb")), "b")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, _SKETCH_BITS // 8) for i in (4, 5))
                apart = _BITS[x ^ y].sum(axis=1)
                good = _possible(batch.column(2).to_numpy(), batch.column(3).to_numpy(), apart, rule)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(apart)], names=["a", "b", "apart"]).filter(pa.array(good))

    near = few.select("a", "b", "na", "nb", "sa", "sb").mapInArrow(measure, "a long, b long, apart long")
    return near.groupBy("a").agg(F.min_by("b", F.struct("apart", "b")).alias("b"))


def _cross_pairs(open_: DataFrame, sets: DataFrame, rule: Likeness, most: int, parts: int) -> DataFrame:
    """Pairs across components that share a key and pass the sketch; of two components in one key the ``most`` closest.

    (a, b, more): more marks keys where passing pairs were left for a later round."""
    rows = open_.join(sets.select(F.col("id").alias("node"), "n", "sketch"), "node")
    rows = rows.repartition(parts, "key").sortWithinPartitions("key", "label", "node").select("key", "node", "label", "n", "sketch")

    def of_key(node: np.ndarray, label: np.ndarray, n: np.ndarray, sketch: np.ndarray) -> Iterator[tuple[int, int, bool]]:
        found: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
        order = np.argsort(n, kind="stable")
        node, label, n, sketch = node[order], label[order], n[order], sketch[order]
        upto = np.searchsorted(n, [rule.partner(int(x)) for x in n], side="right")
        for i in range(len(node) - 1):
            later = np.arange(i + 1, upto[i])
            later = later[label[later] != label[i]]
            for some in np.array_split(later, max(1, len(later) // 65536)):
                apart = _BITS[sketch[some] ^ sketch[i]].sum(axis=1)
                good = _possible(n[i], n[some], apart, rule)
                for j, d in zip(some[good].tolist(), apart[good].tolist(), strict=True):
                    key = (min(label[i], label[j]), max(label[i], label[j]))
                    own = found.setdefault(key, [])
                    own.append((d, int(node[i]), int(node[j])))
                    if len(own) > 4 * most + 64:
                        own.sort()
                        del own[most + 1 :]  # one more than is given, to tell that some are left
        for own in found.values():
            own.sort()
            for _, a, b in own[:most]:
                yield max(a, b), min(a, b), len(own) > most

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []

        def flush(parts_: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            whole = pa.Table.from_batches(parts_).combine_chunks().to_batches()[0]
            key, node, label, n = (whole.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            sketch = np.frombuffer(b"".join(whole.column(4).to_pylist()), np.uint8).reshape(-1, _SKETCH_BITS // 8)
            cut = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            found: set[tuple[int, int, bool]] = set()
            for a, b in zip(cut, np.append(cut[1:], len(key)), strict=True):
                found.update(of_key(node[a:b], label[a:b], n[a:b], sketch[a:b]))
            columns = list(zip(*sorted(found), strict=True)) or [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.bool_())], names=["a", "b", "more"])

        for batch in batches:
            if not batch.num_rows:
                continue
            key = batch.column(0).to_numpy()
            turn = int(np.searchsorted(key, key[-1]))  # where the last key begins, which may go on
            if turn or (kept and kept[-1].column(0)[0].as_py() != key[0]):
                done = [*kept, batch.slice(0, turn)] if turn else kept
                yield from flush(done)
                kept = [batch.slice(turn)]
            else:
                kept.append(batch)
        if kept:
            yield from flush(kept)

    return rows.mapInArrow(pairs, "a long, b long, more boolean")


def linked(docs: DataFrame, rule: Likeness = Likeness(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``n_shingles``, ``component_id``: the smallest id reachable by links."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = _sets(docs, rule, id_col, text_col)
    every = written(keyed.select("id", "n", "s1", "s2"), "set-sizes")
    classes = every.where("n > 0 and id is not null").groupBy("s1", "s2").agg(F.min("id").alias("class"))
    classes = written(classes, "set-classes")
    ids = every.where("n > 0 and id is not null").join(classes, ["s1", "s2"]).select(F.col("id").alias("node"), "class").distinct()
    found = written(_shared_keys(keyed.where("id is not null"), parts), "shared-keys", large=True)
    released(keyed)
    shared = written(found.join(ids, "node").select("key", F.col("class").alias("node")).distinct(), "shared-keys", large=True)
    released(found)
    involved = written(shared.select(F.col("node").alias("id")).distinct(), "shared-ids")
    own_sets = _involved(docs, involved, rule, id_col, text_col)
    named = classes.withColumnRenamed("class", "id")
    sets = written(own_sets.join(named, ["id", "s1", "s2"], "left_semi").select("id", "n", "sketch", "hashes"), "shared-sets", large=True)
    released(involved)

    links = written(_verified(_first_pairs(shared, sets, rule), sets, rule), "links", large=True)
    labels, most = components(links), 8
    while True:
        known = shared.join(labels, "node", "left").select("key", "node", F.coalesce("component", "node").alias("label"))
        mixed = known.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x < y").select("key")
        found = written(_cross_pairs(known.join(mixed, "key"), sets, rule, most, parts), "cross-pairs", large=True)
        n, more = found.agg(F.count("*"), F.max("more")).first()
        if n:
            new = _verified(found.select("a", "b").distinct(), sets, rule)
            before, links = links, written(links.unionByName(new), "links", large=True)
            released(before, labels)
            labels = components(links)
        released(found)
        if not n or not more:
            break
        most *= 8
    released(shared, sets, links)
    rows = every.select("id", "n", "s1", "s2").join(classes, ["s1", "s2"], "left")
    rows = rows.join(labels.withColumnRenamed("node", "class"), "class", "left")
    return rows.select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.coalesce("component", "class")).otherwise(F.col("id")).alias("component_id"))


def one_of_each(docs: DataFrame, rule: Likeness = Likeness(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with the smallest id of each component, with their own columns; rows without id stay.

    Only ids are joined in, and texts stay where they are while the ids may be broadcast; of rows
    with equal ids one stays."""
    own = docs.columns
    found = written(linked(docs, rule, id_col, text_col).select(F.col(id_col).alias("id"), "component_id"), "near-duplicates")
    times = written(found.where("id = component_id").groupBy("id").agg(F.count("*").alias("n")), "near-duplicates-kept")
    n, most = times.agg(F.count("*"), F.max("n")).first()
    keep = times.select(F.col("id").alias(id_col))
    kept = docs.join(F.broadcast(keep) if n <= BROADCAST_IDS else keep.hint("shuffle_hash"), id_col, "left_semi")
    if (most or 0) > 1:
        kept = kept.dropDuplicates([id_col])
    return kept.select(*own).unionByName(docs.where(F.col(id_col).isNull()).select(*own))
