"""Prefix trie of conversations, by hashes of fixed-length blocks of turns.

A conversation is cut into blocks of ``Settings.block`` turns. A turn has a 128-bit hash that holds its
place, a block the XOR of its turns' hashes, and a prefix the XOR of the blocks before it, so a prefix
of whole blocks is known for every conversation from one running XOR. Conversations are grouped by the
prefix and the digest of the next block first, which leaves one row for each distinct block after a
prefix, with its smallest conversation and how many it stands for. Where all that follows a prefix is
one block, its turns are nodes as they are. Only where siblings diverge are turn boundaries looked at:
there the distinct blocks, not the conversations, are opened, and their turn prefixes grouped.

Subtree sums use the blocks too: nodes add to the nodes above them inside their block, blocks to blocks
above them by doubling distances (a conversation of n turns takes log2(n / block) rounds), each an
aggregate that is combined before it is shuffled.

No step gathers the members or the children of a node: counts and minima are partial aggregates; a
parent with very many children (at most a thousand parents can have more than a thousandth of all) is
joined by broadcast, others by shuffle. The ids that end in a node are sorted by ranges over all tasks
and joined to texts of ``chunk`` ids, which one task a node then only feeds to SHA-256, an inherently
serial hash, without holding them. A conversation's turns are numbered by one window, which spills.

Defined results: a null role or text is empty; turns of one number stand by role, then text; rows
without a conversation id belong to none and are left out; a conversation that gets no turns is a
member of the root alone; an empty table has no members, so no nodes; equal rows are turns of their own;
other columns are left out. Very long texts count by their bytes and are hashed before any shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from tablesync.llm.common import parts_for, with_facts, written

_NODE = ["depth", "p1", "p2"]
_PREFIX = ["k", "b1", "b2"]
_NOTHING = hashlib.sha256(b"").hexdigest()


@dataclass(frozen=True)
class Settings:
    block: int = 4
    chunk: int = 4096
    ids_per_task: int = 1_000_000


def rebuilt(conversations: DataFrame, group: int = 5, heads: int = 9) -> tuple[DataFrame, DataFrame]:
    """(ids, turns): every conversation c begins with the first h turns of c - c % group, then has its
    own after its first h; h = crc32(c) % heads. At most ``heads`` turns a group are dealt to its members."""
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("pos", F.row_number().over(order).cast("long"))
    rows = rows.select("conv_id", "pos", *turn_facts())
    rows = written(rows, "trie-rows")
    own_heads = F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads
    ids = rows.select("conv_id").distinct().withColumn("h", own_heads)
    donors = rows.where((F.col("conv_id") % group == 0) & (F.col("pos") < heads)).withColumnRenamed("conv_id", "donor")
    dealt = ids.withColumn("donor", F.col("conv_id") - F.col("conv_id") % group).join(donors, "donor").where("pos <= h")
    own = rows.withColumn("h", own_heads).where("pos > h")
    return ids.select("conv_id"), dealt.select(*rows.columns).unionByName(own.select(*rows.columns))


def turn_facts() -> list:
    """What the trie needs of a turn: a digest of role and text, and the text's bytes."""
    told = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")
    return [F.unhex(F.md5(told.cast("binary"))).alias("digest"), F.octet_length("text").cast("long").alias("bytes")]


def prefix_trie(ids: DataFrame, turns: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """A row per node of the trie over ``turns`` (conv_id, pos, digest, bytes); ``ids`` are all conversations."""
    ids = written(ids, "trie-ids")
    members = ids.agg(F.count("*").alias("n"), F.min("conv_id").alias("low")).first()
    turns = written(turns, "trie-turns")
    longest = turns.groupBy("conv_id").count().agg(F.max("count")).first()[0] or 0
    blocks = written(_blocks(turns, settings.block, longest), "trie-blocks")
    distinct, groups = _distinct_blocks(blocks)
    nodes = written(_nodes(distinct, groups), "trie-nodes")
    kids = nodes.groupBy((F.col("depth") - 1).alias("depth"), F.col("q1").alias("p1"), F.col("q2").alias("p2")).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(kids, _NODE, "left").withColumn("leaf", F.col("n_children").isNull().cast("long"))
    nodes = nodes.withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    nodes = nodes.withColumn("saved", (F.col("n_convs") - 1) * F.col("bytes"))
    nodes = written(nodes, "trie-kids")
    below = written(_below(nodes, groups, _doublings(longest, settings.block)), "trie-below")
    at_end = below.select((F.col("k") * settings.block).alias("depth"), F.col("b1").alias("p1"), F.col("b2").alias("p2"), "all_saved", "all_leaves")
    sums = nodes.join(at_end, _NODE, "left").select(
        F.explode("up").alias("u"), (F.col("saved") + F.coalesce("all_saved", F.lit(0))).alias("s"),
        (F.col("leaf") + F.coalesce("all_leaves", F.lit(0))).alias("l"),
    ).groupBy("u.depth", "u.p1", "u.p2").agg(F.sum("s").alias("saved_tokens"), F.sum("l").alias("n_leaves"))
    ends = written(_ends(ids, blocks, members["n"], settings), "trie-ends")

    total = nodes.count()
    parents = nodes.where("n_children > 0").select(*_NODE, F.col("conv_id").alias("parent_conv_id"), "n_children")
    deeper = nodes.where("depth > 1").select(*_NODE, F.struct((F.col("depth") - 1).alias("depth"), F.col("q1").alias("p1"), F.col("q2").alias("p2")).alias("parent"))
    deeper = deeper.select(F.col("depth").alias("d"), F.col("p1").alias("x1"), F.col("p2").alias("x2"), "parent.*")
    deeper = with_facts(deeper, parents, _NODE, "n_children", total)
    parent_ids = deeper.select(F.col("d").alias("depth"), F.col("x1").alias("p1"), F.col("x2").alias("p2"), "parent_conv_id")
    top = nodes.where("depth = 1").select(*_NODE, F.lit(members["low"]).cast("long").alias("parent_conv_id"))

    inner = nodes.join(sums, _NODE).join(parent_ids.unionByName(top), _NODE).select(
        *_NODE, "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")
    inner = inner.unionByName(_root(inner, top, below, members))
    nodes = inner.join(ends, _NODE, "left")
    return nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                        F.coalesce("ends_sha256", F.lit(_NOTHING)).alias("ends_sha256"))


def _root(inner: DataFrame, top: DataFrame, below: DataFrame, members: Row) -> DataFrame:
    """The textless node above all; none without members."""
    whole = below.where("k = 0").first()
    row = {"depth": 0, "p1": 0, "p2": 0, "conv_id": members["low"], "parent_conv_id": None, "n_convs": members["n"], "n_children": top.count(),
           "n_leaves": whole["all_leaves"] if whole else 1, "saved_tokens": whole["all_saved"] if whole else 0}
    return inner.sparkSession.createDataFrame([row] if members["n"] else [], inner.schema)


def _doublings(longest: int, block: int) -> int:
    """Rounds until the distance 2 ** rounds exceeds any between blocks of a conversation."""
    return max(-(-longest // block) - 1, 0).bit_length()


def _blocks(turns: DataFrame, block: int, longest: int) -> DataFrame:
    """Per conversation and block: the prefix before it (b1, b2), its digest, its turns, the prefixes
    1, 2, 4, ... blocks further up, and whether it is the last. One shuffle, by conversation."""
    place = Window.partitionBy("conv_id").orderBy("pos")
    turns = turns.withColumn("n", F.row_number().over(place).cast("long"))
    told = [F.xxhash64(F.lit(salt), "n", "digest").alias(name) for salt, name in ((1, "d1"), (2, "d2"))]
    turns = turns.select("conv_id", "n", *told, "bytes", ((F.col("n") - 1) / block).cast("long").alias("k"))
    blocks = turns.groupBy("conv_id", "k").agg(
        F.bit_xor("d1").alias("x1"), F.bit_xor("d2").alias("x2"), F.count("*").alias("size"),
        F.sort_array(F.collect_list(F.struct("n", "d1", "d2", "bytes"))).alias("turns"))  # at most a block of turns
    order = Window.partitionBy("conv_id").orderBy("k")
    before = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    for b, x in (("b1", "x1"), ("b2", "x2")):
        blocks = blocks.withColumn(b, F.bit_xor(x).over(before).bitwiseXOR(F.col(x)))
    up = [F.lag(F.struct(*_PREFIX), 2**i).over(order).alias(f"up{i}") for i in range(_doublings(longest, block))]
    return blocks.select("*", *up, F.lead("k").over(order).isNull().alias("last"))


def _distinct_blocks(blocks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct blocks after each prefix, and the prefixes with how many blocks follow them."""
    up = [F.any_value(c).alias(c) for c in blocks.columns if c.startswith("up")]
    distinct = blocks.groupBy(*_PREFIX, "x1", "x2", "size").agg(
        F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.any_value("turns").alias("turns"), *up)
    distinct = written(distinct, "trie-distinct")
    groups = distinct.groupBy(*_PREFIX).agg(F.count("*").alias("kinds"), *up)
    return distinct, written(groups, "trie-groups")


def _opened(distinct: DataFrame) -> DataFrame:
    """The turns of distinct blocks as nodes. ``up`` are the nodes of the block down to this one."""
    so_far = "aggregate(slice(turns, 1, i + 1), {b}, (a, u) -> a ^ u.{d})"
    path = f"transform(turns, (t, i) -> named_struct('depth', t.n, 'p1', {so_far.format(b='b1', d='d1')}, 'p2', {so_far.format(b='b2', d='d2')}))"
    rows = distinct.withColumn("path", F.expr(path)).select(*_PREFIX, "n_convs", "conv_id", "path", F.posexplode("turns").alias("i", "turn"))
    here = F.get("path", F.col("i"))
    rows = rows.select(*_PREFIX, "n_convs", "conv_id", "turn", here.alias("here"), F.slice("path", F.lit(1), F.col("i") + 1).alias("up"))
    return rows.select("here.*", F.col("here.p1").bitwiseXOR(F.col("turn.d1")).alias("q1"), F.col("here.p2").bitwiseXOR(F.col("turn.d2")).alias("q2"),
                       *_PREFIX, "n_convs", "conv_id", "turn.bytes", "up")


def _nodes(distinct: DataFrame, groups: DataFrame) -> DataFrame:
    rows = distinct.drop(*[c for c in distinct.columns if c.startswith("up")])
    rows = with_facts(rows, groups.select(*_PREFIX, "kinds"), _PREFIX, "kinds", distinct.count())
    straight, diverged = _opened(rows.where("kinds = 1")), _opened(rows.where("kinds > 1"))
    any_of = [F.any_value(c).alias(c) for c in ("q1", "q2", *_PREFIX, "bytes", "up")]
    refined = diverged.groupBy(*_NODE).agg(F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("conv_id"), *any_of)
    return straight.unionByName(refined)


def _below(nodes: DataFrame, groups: DataFrame, rounds: int) -> DataFrame:
    """Per prefix of whole blocks: what all nodes under it save, and its leaves."""
    sums = nodes.groupBy(*_PREFIX).agg(F.sum("saved").alias("all_saved"), F.sum("leaf").alias("all_leaves"))
    below = written(groups.join(sums, _PREFIX), "trie-sums")
    for i in range(rounds):
        add = below.where(F.col(f"up{i}").isNotNull()).groupBy(*[F.col(f"up{i}.{c}").alias(c) for c in _PREFIX]).agg(
            F.sum("all_saved").alias("more_saved"), F.sum("all_leaves").alias("more_leaves"))
        joined = below.join(add, _PREFIX, "left")
        for had, more in (("all_saved", "more_saved"), ("all_leaves", "more_leaves")):
            joined = joined.withColumn(had, F.col(had) + F.coalesce(more, F.lit(0).cast("long")))
        below = written(joined.drop("more_saved", "more_leaves"), "trie-sums")
    return below.select(*_PREFIX, "all_saved", "all_leaves")


def _ends(ids: DataFrame, blocks: DataFrame, n: int, settings: Settings) -> DataFrame:
    """SHA-256 over the ids that end in a node, ascending."""
    last = blocks.where("last").select("conv_id", F.reduce("turns", F.lit(0).cast("long"), lambda _, t: t.n).alias("depth"),
                                       F.col("b1").bitwiseXOR(F.col("x1")).alias("p1"), F.col("b2").bitwiseXOR(F.col("x2")).alias("p2"))
    zero = F.lit(0).cast("long")
    ends = ids.join(last, "conv_id", "left").select(*[F.coalesce(c, zero).alias(c) for c in _NODE], "conv_id")
    parts = parts_for(n, settings.ids_per_task)

    def runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple, int, int]]:
        key = np.stack([batch.column(c).to_numpy() for c in range(3)])
        cut = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
        for a, b in zip([0, *cut], [*cut, batch.num_rows], strict=True):
            yield tuple(key[:, a].tolist()), int(a), int(b)

    def chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, a, b in runs(batch) if batch.num_rows else ():
                for start in range(a, b, settings.chunk):
                    some = batch.column(3).slice(start, min(settings.chunk, b - start)).to_pylist()
                    rows.append((*key, some[0], ",".join(map(str, some))))
            yield pa.RecordBatch.from_pylist([dict(zip([*_NODE, "first", "ids"], r, strict=True)) for r in rows], schema=chunk_type)

    chunk_type = pa.schema([(c, pa.int64()) for c in [*_NODE, "first"]] + [("ids", pa.string())])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, running = None, None
        for batch in batches:
            done = []
            for new, a, b in runs(batch) if batch.num_rows else ():
                if new != key:
                    if key is not None:
                        done.append((key, running.hexdigest()))
                    key, running = new, hashlib.sha256()
                else:
                    running.update(b",")
                running.update(",".join(batch.column(4).slice(a, b - a).to_pylist()).encode())
            yield out(done)
        if key is not None:
            yield out([(key, running.hexdigest())])

    def out(done: list) -> pa.RecordBatch:
        columns = [pa.array([k[c] for k, _ in done], pa.int64()) for c in range(3)]
        return pa.RecordBatch.from_arrays([*columns, pa.array([h for _, h in done], pa.string())], names=[*_NODE, "ends_sha256"])

    keys = "depth long, p1 long, p2 long"
    chunks = ends.repartitionByRange(parts, *_NODE, "conv_id").sortWithinPartitions(*_NODE, "conv_id").mapInArrow(chunked, f"{keys}, first long, ids string")
    return chunks.repartition(*_NODE).sortWithinPartitions(*_NODE, "first").mapInArrow(hashed, f"{keys}, ends_sha256 string")
