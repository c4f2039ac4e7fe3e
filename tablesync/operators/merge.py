"""Key-based reconciliation of a target and a batch, as DataFrame joins.

NULL keys equal nothing, so those rows skip the join. Sent through it they
would all hash to one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tablesync.functions.audit import quoted
from tablesync.operators.dedup import any_null

_HIT = "__hit"
_HELD = "__held"
_ROW_BYTES, _VALUE_BYTES = 16, 16


def memory_bytes(schema: T.StructType, columns: Sequence[str]) -> Column:
    """What a row of these columns takes in memory, at least; NULL when unknown.

    File sizes say little about that: encoded columns can be many times smaller.
    """
    size = F.lit(_ROW_BYTES)
    for name in columns:
        kind = schema[name].dataType
        if isinstance(kind, (T.StringType, T.BinaryType)):
            size = size + F.lit(_VALUE_BYTES) + F.coalesce(F.octet_length(quoted(name)), F.lit(0))
        elif isinstance(kind, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
            return F.lit(None).cast("bigint")
        else:
            size = size + F.lit(_VALUE_BYTES)
    return size


def join_side(df: DataFrame, small: bool) -> DataFrame:
    """Broadcast a side measured to be small; sort-merge with any other."""
    return F.broadcast(df) if small else df.hint("merge")


def upsert_rows(target: DataFrame, batch: DataFrame, key: Sequence[str], small: bool) -> DataFrame:
    """Target rows whose key is not in the batch, and all batch rows.

    Both sides have the same columns and the batch's keys are unique. Only key
    columns of the batch enter the join. With ``small``, meaning that they fit a
    broadcast, the target is not shuffled.
    """
    key = list(key)
    new_keys = batch.where(~any_null(key)).select(*[quoted(k) for k in key])
    kept = target.where(~any_null(key)).join(join_side(new_keys, small), key, "left_anti")
    return kept.select(*_all(target)).unionByName(target.where(any_null(key))).unionByName(batch)


def merge_columns(
    target: DataFrame, batch: DataFrame, key: Sequence[str], small: bool,
) -> DataFrame:
    """Matched target rows take the batch's columns and keep their others;
    unmatched batch rows are inserted with NULL in the columns they lack.

    Updates are a left join from the target, inserts an anti join from the batch. A small batch is
    broadcast against the target, which then is not shuffled; with a large one both are sort-merged,
    and adaptive execution splits a hot key's rows in either, which it cannot do in a full outer join.
    """
    key = list(key)
    updated = [c for c in batch.columns if c not in key]
    keyed_target, keyed_batch = target.where(~any_null(key)), batch.where(~any_null(key))
    new = keyed_batch.select(
        *[quoted(k) for k in key],
        *[quoted(c).alias(f"__new_{c}") for c in updated],
        F.lit(True).alias(_HIT),
    )
    rows = keyed_target.join(join_side(new, small), key, "left")
    taken = {
        c: F.when(F.col(_HIT), quoted(f"__new_{c}")).otherwise(quoted(c)) for c in updated
    }
    merged = rows.select(*[taken.get(c, quoted(c)).alias(c) for c in target.columns])
    inserts = batch.where(any_null(key))
    names = [quoted(k) for k in key]
    known = keyed_target.select(*names)
    if small:
        known = known.join(join_side(keyed_batch.select(*names), small), key, "left_semi")
    else:
        known = known.hint("merge")
    inserts = inserts.unionByName(keyed_batch.join(known, key, "left_anti").select(*_all(batch)))
    untouched = target.where(any_null(key))
    return merged.unionByName(untouched).unionByName(inserts, allowMissingColumns=True)


def fresh_rows(
    target: DataFrame, batch: DataFrame, key: Sequence[str], order: str, small: bool,
) -> DataFrame:
    """Batch rows that are not older, by ``order``, than the target row of their key.

    Only key and order of the target are read, and cut down to the batch's keys
    before anything is shuffled.
    """
    key = list(key)
    names = [quoted(k) for k in key]
    keyed_batch = batch.where(~any_null(key))
    held = (
        target.where(~any_null(key))
        .select(*names, quoted(order).alias(_HELD))
        .join(join_side(keyed_batch.select(*names), small), key, "left_semi")
        .groupBy(*names).agg(F.max(_HELD).alias(_HELD))  # an appended target may hold a key many times
    )
    fresh = (
        keyed_batch.join(held, key, "left")
        .where(F.col(_HELD).isNull() | (quoted(order) >= F.col(_HELD)))
        .select(*_all(batch))
    )
    return fresh.unionByName(batch.where(any_null(key)))


def _all(df: DataFrame) -> list:
    return [quoted(c) for c in df.columns]
