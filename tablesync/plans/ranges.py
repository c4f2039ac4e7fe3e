"""Ranges of a key that hold about equally many rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T


@dataclass(frozen=True)
class KeyRange:
    """Keys from ``low`` to below ``high``; None is open. ``nulls`` is the range of rows without a key."""

    low: object = None
    high: object = None
    nulls: bool = False

    def condition(self, key: Column) -> Column:
        if self.nulls:
            return key.isNull()
        inside = key.isNotNull()
        if self.low is not None:
            inside = inside & (key >= F.lit(self.low))
        return inside & (key < F.lit(self.high)) if self.high is not None else inside


def balanced_ranges(df: DataFrame, key: Column, ranges: int, accuracy: int = 100) -> list[KeyRange]:
    """Ranges whose bounds are quantiles of the key, so that skewed keys still give equal shares; rows with
    a NULL key have a range of their own. Every row is in exactly one. A value that fills more than a
    range is one range by itself.

    Numbers, dates and moments go through Spark's quantile sketch (partial aggregates, one row); text has no sketch,
    so its bounds are the greatest text of each of ``ranges`` * 64 hash-free prefixes, weighed by their counts."""
    rows = df.select(key.alias("k"))
    kind = rows.schema["k"].dataType
    if isinstance(kind, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        shares = [i / ranges for i in range(1, ranges)]
        bounds = rows.agg(F.percentile_approx("k", shares, accuracy * ranges)).first()[0] if shares else []
    else:
        bounds = _text_bounds(rows, ranges)
    cuts = sorted(set(bounds or []))
    edges = [None, *cuts, None]
    return [KeyRange(low, high) for low, high in zip(edges, edges[1:], strict=False)] + [KeyRange(nulls=True)]


def _text_bounds(rows: DataFrame, ranges: int) -> list[str]:
    """Bounds from a sorted sample of at most ``ranges`` * 64 values, chosen by their hash: bounds only need
    to be near the quantiles, and every row is placed by comparing, not by the sample."""
    wanted = ranges * 64
    sample = rows.where("k is not null").select("k", F.xxhash64("k", F.monotonically_increasing_id()).alias("h")).orderBy("h").limit(wanted)
    values = sorted(r["k"] for r in sample.collect())
    return [values[i * len(values) // ranges] for i in range(1, ranges)] if values else []


def range_number(ranges: list[KeyRange], key: Column) -> Column:
    """Which range a key is in, from 0."""
    number = F.lit(None).cast("int")
    for i, one in reversed(list(enumerate(ranges))):
        number = F.when(one.condition(key), i).otherwise(number)
    return number
