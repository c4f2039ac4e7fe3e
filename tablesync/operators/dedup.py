"""Latest row per key, and keys that occur more than once."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tablesync.functions.audit import quoted, resolve_columns

_RANK = "__rank"
_UNHASHABLE = re.compile(r"map<|variant")


def any_null(key: Sequence[str]) -> Column:
    """True where some key column is NULL: such a row equals no other."""
    return reduce(Column.__or__, [quoted(k).isNull() for k in key])


def latest_per_key(
    df: DataFrame, key: Sequence[str], order: str | Sequence[str], null_keys_match: bool = True,
) -> DataFrame:
    """The row with the greatest ``order`` value per key.

    ``row_number() = 1`` lets Spark keep one row per key in each map task before
    the shuffle (WindowGroupLimit), so a hot key sends at most one row per task.
    Equal order values are settled by a hash of the row, so that a re-run task
    picks the same row. With ``null_keys_match=False`` rows with a NULL in the
    key all stay.
    """
    key = resolve_columns(key, df.columns)
    order = resolve_columns([order] if isinstance(order, str) else order, df.columns)
    hashed = [quoted(f.name) for f in df.schema if not _UNHASHABLE.search(f.dataType.simpleString())]
    parts = [quoted(k) for k in key]
    if not null_keys_match:  # a number of its own keeps each of these rows, in the same pass
        parts.append(F.when(any_null(key), F.monotonically_increasing_id()))
    spec = Window.partitionBy(*parts).orderBy(
        *[quoted(o).desc_nulls_last() for o in order], F.xxhash64(*hashed).desc()
    )
    return df.withColumn(_RANK, F.row_number().over(spec)).where(F.col(_RANK) == 1).drop(_RANK)


def key_violations(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with the number of rows as ``n``.

    Partial aggregation runs before the shuffle, so a hot key costs one row per
    map task. Rows with a NULL in the key violate nothing.
    """
    key = resolve_columns(key, df.columns)
    return (
        df.where(~any_null(key))
        .groupBy(*[quoted(k) for k in key])
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1)
    )
