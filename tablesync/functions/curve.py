"""Places along a space-filling curve, from quantile ranks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tablesync.errors import ConfigError
from tablesync.functions.audit import quoted

_SKETCHED = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)


def z_place(df: DataFrame, columns: Sequence[str], bits: int = 6) -> Column:
    """Where a row lies on the Z curve over the columns' ranks.

    A rank is the number of the value's quantile interval (2 ** ``bits`` of them, from one pass of partial
    aggregates), so skewed columns weigh like even ones; NULL ranks lowest. Bits of the ranks alternate,
    the highest first, so rows near each other on the curve are near in every column."""
    wrong = [c for c in columns if not isinstance(df.schema[c].dataType, _SKETCHED)]
    if wrong:
        raise ConfigError(f"no order along a curve for {', '.join(wrong)}: give numbers, dates or moments")
    shares = [i / 2**bits for i in range(1, 2**bits)]
    cuts = df.agg(*[F.percentile_approx(quoted(c), shares, 100 * 2**bits).alias(f"c{i}") for i, c in enumerate(columns)]).first()
    place = F.lit(0).cast("long")
    for i, column in enumerate(columns):
        known = sorted(set(cuts[i] or []))
        rank = _rank(quoted(column), known, 0, len(known))
        for bit in range(bits):
            at = bit * len(columns) + (len(columns) - 1 - i)
            place = place.bitwiseOR(F.shiftleft(F.shiftright(rank, bit).bitwiseAND(F.lit(1)).cast("long"), at))
    return place


def _rank(value: Column, cuts: list, low: int, high: int) -> Column:
    """How many cuts are at most the value: a binary search, as an expression."""
    if low == high:
        return F.lit(low)
    middle = (low + high) // 2
    return F.when(value >= F.lit(cuts[middle]), _rank(value, cuts, middle + 1, high)).otherwise(_rank(value, cuts, low, middle))


def within(between: dict[str, tuple], columns: Sequence[str]) -> Column:
    """Rows inside all the ranges (bounds included, None open)."""
    tests = []
    for name, (low, high) in between.items():
        tests += [quoted(name) >= F.lit(low)] * (low is not None) + [quoted(name) <= F.lit(high)] * (high is not None)
    return reduce(Column.__and__, tests, F.lit(True))
