"""Sources that Spark reads as DataFrames: files, catalog tables, SQL over either."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tablesync.functions.custom_sql import filled_query, query_text
from tablesync.functions.window import (
    Window, comparable, format_point, in_window, parse_point, require_kind, slice_bounds, spark_render,
    window_for,
)
from tablesync.sources.footers import footer_bounds, newest_by_footers
from tablesync.spec import Slice, TableSpec

_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def frame_slice(
    df: DataFrame, spec: TableSpec, last_point: str | None = None, newest: Callable[[Window], DataFrame | None] = lambda _: None,
) -> Slice:
    """The rows of ``df`` that ``spec`` asks for, given the stored last point. ``newest`` may know the
    greatest iterate value of a window without reading rows."""
    if spec.replication_method == "full":
        return Slice(df, "overwrite")
    window = window_for(spec, last_point)
    return _incremental(df, window, lambda high: in_window(df, window, high), newest)


def query_slice(
    spark: SparkSession, spec: TableSpec, query: str, last_point: str | None = None,
) -> Slice:
    """As ``frame_slice`` for a ``(...) alias`` query over views and tables."""

    def run(condition: str | None) -> DataFrame:
        return spark.sql(f"SELECT * FROM {filled_query(spec, query, condition)}")

    whole = run(None)
    if spec.replication_method == "full":
        return Slice(whole, "overwrite")
    window = window_for(spec, last_point)
    render = spark_render(whole)
    timed = replace(window, exprs=tuple(comparable(whole, expr, window.kind) for expr in window.exprs))
    return _incremental(whole, window, lambda high: run(timed.condition(render, high)))


def _incremental(
    whole: DataFrame, window: Window, rows_until: Callable[[object], DataFrame],
    newest: Callable[[Window], DataFrame | None] = lambda _: None,
) -> Slice:
    """One pass over the iterate columns, or their footers, fixes the snapshot; the rows follow lazily.

    Bounds come back as text, because a timestamp handed to Python would be
    shifted to the driver's zone. A moment comes back as microseconds since 1970,
    which no time zone and no end of summer time changes.
    """
    require_kind(whole, window)
    bounds = newest(window)
    if bounds is None:
        bounds = slice_bounds(rows_until(None), window.exprs, window.kind)
    zoned = isinstance(bounds.schema["hi"].dataType, T.TimestampType)
    found = bounds.select((F.unix_micros("hi") if zoned else F.col("hi").cast("string")).alias("hi")).first()
    if found["hi"] is None:
        if window.bounded:
            return Slice(None, window.mode)
        return Slice(whole, "overwrite")
    high = _EPOCH + timedelta(microseconds=found["hi"]) if zoned else parse_point(found["hi"], window.kind)
    mark = None if window.static else format_point(high, window.kind)
    return Slice(rows_until(high), window.mode, mark)


@dataclass(frozen=True)
class FileSource:
    """Files under ``path``; a table name is a path relative to it.

    Give ``schemas`` for csv, json and xml: inferring them reads everything
    twice. ``views`` maps view names to table names for custom queries.
    """

    path: str
    format: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)
    schemas: Mapping[str, T.StructType | str] = field(default_factory=dict)
    views: Mapping[str, str] = field(default_factory=dict)

    def frame(self, spark: SparkSession, name: str) -> DataFrame:
        reader = spark.read.format(self.format).options(**self.options)
        if name in self.schemas:
            reader = reader.schema(self.schemas[name])
        return reader.load(self._path(name))

    def _path(self, name: str) -> str:
        return f"{self.path.rstrip('/')}/{name}"

    def bounds(self, spark: SparkSession, name: str, columns: Sequence[str], kind: str = "int") -> DataFrame:
        """One row (lo, hi) of a table's columns, from file footers where they hold it."""
        rows = self.frame(spark, name)
        pushed = footer_bounds(spark, self.format, self.options, self._path(name), rows.schema, columns)
        return slice_bounds(rows, columns, kind) if pushed is None else pushed

    def _newest(self, rows: DataFrame, name: str, window: Window) -> DataFrame | None:
        if window.upper is not None:
            return None
        bounds = footer_bounds(rows.sparkSession, self.format, self.options, self._path(name), rows.schema, window.exprs)
        if bounds is None or window.lower is None:
            return newest_by_footers(bounds, None)
        return newest_by_footers(bounds, f"hi >= {spark_render(bounds)('hi', window.lower)}")

    def extract(
        self, spark: SparkSession, spec: TableSpec, last_point: str | None = None,
        base_dir: str | None = None,
    ) -> Slice:
        query = query_text(spec, base_dir)
        if query is None:
            rows = self.frame(spark, spec.name)
            return frame_slice(rows, spec, last_point, lambda window: self._newest(rows, spec.name, window))
        for view, name in self.views.items():
            self.frame(spark, name).createOrReplaceTempView(view)
        return query_slice(spark, spec, query, last_point)


@dataclass(frozen=True)
class TableSource:
    """Catalog tables and views, by identifier."""

    def extract(
        self, spark: SparkSession, spec: TableSpec, last_point: str | None = None,
        base_dir: str | None = None,
    ) -> Slice:
        query = query_text(spec, base_dir)
        if query is None:
            return frame_slice(spark.table(spec.name), spec, last_point)
        return query_slice(spark, spec, query, last_point)


@dataclass(frozen=True)
class FrameSource:
    """DataFrames the caller already has, by table name."""

    frames: Mapping[str, DataFrame]

    def extract(
        self, spark: SparkSession, spec: TableSpec, last_point: str | None = None,
        base_dir: str | None = None,
    ) -> Slice:
        query = query_text(spec, base_dir)
        if query is None:
            return frame_slice(self.frames[spec.name], spec, last_point)
        for view, frame in self.frames.items():
            frame.createOrReplaceTempView(view)
        return query_slice(spark, spec, query, last_point)
