"""Incremental windows: which rows of a source are new.

A window is a SQL condition over the iterate columns. It is rendered as text so
that one rule serves both a DataFrame filter (Catalyst pushes it to the scan)
and a query sent to a database; only the literals differ.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone
from decimal import Decimal, InvalidOperation
from typing import Any

from pyspark.sql import DataFrame, functions as F, types as T

from tablesync.errors import ConfigError
from tablesync.spec import TableSpec

DATETIME_FORMAT = "%Y-%m-%d %H:%M:%S.%f"
_ALIASED = re.compile(r"^(?P<expr>.+?)\s+as\s+(?P<alias>\w+)\s*$", re.IGNORECASE | re.DOTALL)

Render = Callable[[str, Any], str]


def split_alias(text: str) -> tuple[str, str | None]:
    """``'expr as name'`` -> (expr, name); anything else -> (text, None)."""
    found = _ALIASED.match(text.strip())
    if found is None:
        return text.strip(), None
    return found["expr"].strip(), found["alias"]


def parse_point(value: Any, kind: str) -> int | datetime:
    """A bound given by the user, the run log or a source, as int or datetime.

    A time with a zone is a moment, kept in UTC with its zone; one without is wall-clock time."""
    try:
        if kind == "int":
            number = Decimal(str(value))
            if number != int(number):
                raise ValueError("not a whole number")
            return int(number)
        if isinstance(value, date) and not isinstance(value, datetime):
            return datetime(value.year, value.month, value.day)
        moment = value if isinstance(value, datetime) else datetime.fromisoformat(str(value).strip())
        return moment if moment.tzinfo is None else moment.astimezone(timezone.utc)
    except (InvalidOperation, OverflowError, ValueError) as bad:
        raise ConfigError(f"{value!r} is not a valid {kind} bound") from bad


def format_point(value: Any, kind: str) -> str:
    """The text form kept in the run log."""
    point = parse_point(value, kind)
    if kind == "int":
        return str(point)
    return point.strftime(DATETIME_FORMAT) + ("" if point.tzinfo is None else "+00:00")


@dataclass(frozen=True)
class Window:
    """``lower`` is inclusive, ``upper`` exclusive; either may be absent."""

    exprs: tuple[str, ...]
    kind: str
    lower: int | datetime | None = None
    upper: int | datetime | None = None
    static: bool = False

    @property
    def bounded(self) -> bool:
        return self.lower is not None or self.upper is not None

    @property
    def mode(self) -> str:
        return "append" if self.bounded else "overwrite"

    def condition(self, render: Render, high: int | datetime | None = None, finer: bool = False) -> str | None:
        """The rows of this window, optionally no later than ``high``.

        Without any bound, rows whose iterate value is NULL belong to the
        window too: no later run could find them. ``finer`` says that the source
        may keep smaller fractions than a mark, which stands for all of its microsecond.
        """
        parts = [self._one(expr, render, high, finer) for expr in self.exprs]
        if parts[0] is None:
            return None
        return parts[0] if len(parts) == 1 else " OR ".join(f"({part})" for part in parts)

    def _one(self, expr: str, render: Render, high: int | datetime | None, finer: bool) -> str | None:
        terms = []
        if self.lower is not None:
            terms.append(f"{expr} >= {render(expr, self.lower)}")
        if self.upper is not None:
            terms.append(f"{expr} < {render(expr, self.upper)}")
        if high is not None:
            if finer and isinstance(high, datetime):
                terms.append(f"{expr} < {render(expr, high + timedelta(microseconds=1))}")
            else:
                terms.append(f"{expr} <= {render(expr, high)}")
        if not terms:
            return None
        if not self.bounded:
            terms.append(f"{expr} IS NULL")
            return " OR ".join(terms)
        return " AND ".join(terms)


def window_for(spec: TableSpec, last_point: str | None) -> Window:
    """Static bounds win over the stored last point; neither means everything."""
    kind = spec.iterate_column_type
    exprs = tuple(split_alias(text)[0] for text in spec.iterate_columns)

    def parsed(value: Any) -> Any:
        return None if value is None else parse_point(value, kind)

    if spec.has_static_bounds:
        return Window(exprs, kind, parsed(spec.filter_lower_bound), parsed(spec.filter_upper_bound), True)
    return Window(exprs, kind, parsed(last_point))


def spark_expr(df: DataFrame, text: str) -> str:
    """Quote ``text`` when it is a column of ``df``; else it is SQL already."""
    return f"`{text}`" if text in df.columns else text


def comparable(df: DataFrame, expr: str, kind: str) -> str:
    """SQL of ``expr`` in a type whose order is that of ``kind``: text is read as a time."""
    if kind == "datetime" and isinstance(df.select(F.expr(expr)).schema[0].dataType, T.StringType):
        return f"CAST({expr} AS TIMESTAMP_NTZ)"
    return expr


def spark_render(df: DataFrame) -> Render:
    """Literals in the type of the column they are compared with.

    A literal of another type would make Spark cast the column, which can keep
    the filter from reaching the file scan.
    """
    types: dict[str, T.DataType] = {}

    def render(expr: str, value: int | datetime) -> str:
        if isinstance(value, int):
            return str(value)
        if expr not in types:
            types[expr] = df.select(F.expr(expr)).schema[0].dataType
        text = value.strftime(DATETIME_FORMAT)
        match types[expr]:
            case T.TimestampType():  # a mark is a moment; a bound without zone is the session's wall-clock time
                return f"TIMESTAMP_LTZ '{text}{'' if value.tzinfo is None else '+00:00'}'"
            case T.DateType() if value.replace(tzinfo=None) == datetime(value.year, value.month, value.day):
                return f"DATE '{value:%Y-%m-%d}'"
            case _:
                return f"TIMESTAMP_NTZ '{text}'"

    return render


def jdbc_render(_expr: str, value: int | datetime) -> str:
    return str(value) if isinstance(value, int) else f"'{value.strftime(DATETIME_FORMAT)}'"


def require_kind(df: DataFrame, window: Window) -> None:
    """Refuse a column whose order is not the order of ``window.kind``: numbers
    kept as text, for one, would give a wrong minimum and maximum."""
    fits = {
        "int": T.NumericType,
        "datetime": (T.TimestampType, T.TimestampNTZType, T.DateType, T.StringType, T.NullType),
    }[window.kind]
    for text in window.exprs:
        found = df.select(F.expr(spark_expr(df, text))).schema[0].dataType
        if not isinstance(found, fits):
            raise ConfigError(f"iterate column {text} is {found.simpleString()}, not {window.kind}")


def slice_bounds(df: DataFrame, exprs: Sequence[str], kind: str = "int") -> DataFrame:
    """One row (lo, hi): least minimum and greatest maximum over ``exprs``."""
    columns = [F.expr(comparable(df, spark_expr(df, text), kind)) for text in exprs]
    if len(columns) == 1:
        return df.agg(F.min(columns[0]).alias("lo"), F.max(columns[0]).alias("hi"))
    return df.agg(
        F.least(*[F.min(c) for c in columns]).alias("lo"),
        F.greatest(*[F.max(c) for c in columns]).alias("hi"),
    )


def in_window(df: DataFrame, window: Window, high: int | datetime | None = None) -> DataFrame:
    """``df`` restricted to the window (and to ``high``, when given)."""
    quoted = Window(
        tuple(comparable(df, spark_expr(df, text), window.kind) for text in window.exprs),
        window.kind, window.lower, window.upper, window.static,
    )
    condition = quoted.condition(spark_render(df), high)
    return df if condition is None else df.where(condition)
