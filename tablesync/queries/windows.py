"""Full and incremental slices of the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tablesync.connections import Files
from tablesync.functions.window import in_window, slice_bounds, window_for
from tablesync.queries.registry import query, table
from tablesync.sources.frames import FileSource, frame_slice
from tablesync.spec import Slice, TableSpec

# Orders with a creation and a later update time.
CU = (
    "(select *, o_orderdate as created_at, "
    "o_orderdate + to_days(cast(o_orderkey % 90 as integer)) as updated_at from orders)"
)


def created_updated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "*",
        F.col("o_orderdate").alias("created_at"),
        F.expr("o_orderdate + make_dt_interval(cast(o_orderkey % 90 as int))").alias("updated_at"),
    )


def by_time(column, **options) -> TableSpec:
    return TableSpec("t", "t", "incremental", column, "datetime", **options)


def by_number(column, **options) -> TableSpec:
    return TableSpec("t", "t", "incremental", column, "int", **options)


@query("full_scan", "select * from orders")
def full_scan(spark, sf_dir):
    return Files(sf_dir).extract(spark, TableSpec("orders.parquet", "orders")).df


@query("incremental_datetime", "select * from orders where o_orderdate >= TIMESTAMP '2000-01-01'")
def incremental_datetime(spark, sf_dir):
    spec = TableSpec("orders.parquet", "orders", "incremental", "o_orderdate", "datetime")
    return Files(sf_dir).extract(spark, spec, "2000-01-01 00:00:00.000000").df


@query("incremental_int", "select * from events where event_id >= 500")
def incremental_int(spark, sf_dir):
    return frame_slice(table(spark, sf_dir, "events"), by_number("event_id"), "500").df


@query(
    "incremental_multi_or",
    f"select o_orderkey, created_at, updated_at from {CU} "
    "where created_at >= TIMESTAMP '2001-06-01' or updated_at >= TIMESTAMP '2001-06-01'",
)
def incremental_multi_or(spark, sf_dir):
    spec = by_time(["created_at", "updated_at"])
    rows = frame_slice(created_updated(spark, sf_dir), spec, "2001-06-01").df
    return rows.select("o_orderkey", "created_at", "updated_at")


@query(
    "incremental_expression",
    f"select * from {CU} where greatest(created_at, updated_at) >= TIMESTAMP '2000-01-01'",
)
def incremental_expression(spark, sf_dir):
    spec = by_time("greatest(created_at, updated_at)")
    return frame_slice(created_updated(spark, sf_dir), spec, "2000-01-01").df


@query("static_lower", "select * from orders where o_orderdate >= TIMESTAMP '2000-01-01'")
def static_lower(spark, sf_dir):
    spec = by_time("o_orderdate", filter_lower_bound="2000-01-01")
    return frame_slice(table(spark, sf_dir, "orders"), spec, "2001-01-01").df


@query("static_upper", "select * from orders where o_orderdate < TIMESTAMP '2000-01-01'")
def static_upper(spark, sf_dir):
    spec = by_time("o_orderdate", filter_upper_bound="2000-01-01")
    return frame_slice(table(spark, sf_dir, "orders"), spec).df


@query(
    "static_range",
    f"select o_orderkey from {CU} where "
    "(created_at >= TIMESTAMP '2000-01-01' and created_at < TIMESTAMP '2000-02-01') or "
    "(updated_at >= TIMESTAMP '2000-01-01' and updated_at < TIMESTAMP '2000-02-01')",
)
def static_range(spark, sf_dir):
    spec = by_time(
        ["created_at", "updated_at"], filter_lower_bound="2000-01-01", filter_upper_bound="2000-02-01"
    )
    return frame_slice(created_updated(spark, sf_dir), spec).df.select("o_orderkey")


@query("empty_static_range", "select count(*) as n from orders where o_orderdate >= TIMESTAMP '2100-01-01'")
def empty_static_range(spark, sf_dir):
    """An empty static range is an empty slice, never the whole table."""
    spec = by_time("o_orderdate", filter_lower_bound="2100-01-01")
    orders = table(spark, sf_dir, "orders")
    rows = frame_slice(orders, spec).df
    return (in_window(orders, window_for(spec, None)) if rows is None else rows).agg(F.count("*").alias("n"))


@query(
    "snapshot_window",
    "select * from events where ts >= TIMESTAMP '2024-01-15' and ts <= (select max(ts) from events)",
)
def snapshot_window(spark, sf_dir):
    return frame_slice(table(spark, sf_dir, "events"), by_time("ts"), "2024-01-15").df


def nullable_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "F", F.col("o_orderdate")).alias("updated_at"),
    )


NULLABLE = "(select o_orderkey, case when o_orderstatus <> 'F' then o_orderdate end as updated_at from orders)"


@query("null_initial_load", f"select * from {NULLABLE}")
def null_initial_load(spark, sf_dir):
    return frame_slice(nullable_updates(spark, sf_dir), by_time("updated_at")).df


@query("null_incremental", f"select * from {NULLABLE} where updated_at >= TIMESTAMP '2000-01-01'")
def null_incremental(spark, sf_dir):
    return frame_slice(nullable_updates(spark, sf_dir), by_time("updated_at"), "2000-01-01").df


@query("all_null_fallback", "select o_orderkey, cast(null as timestamp) as updated_at from orders")
def all_null_fallback(spark, sf_dir):
    df = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.lit(None).cast("timestamp_ntz").alias("updated_at")
    )
    return frame_slice(df, by_time("updated_at")).df


@query(
    "no_new_data",
    "select count(*) as n, max(event_id) as last_point from events "
    "where event_id > (select max(event_id) from events)",
)
def no_new_data(spark, sf_dir):
    """Nothing past the stored mark: no slice, and the mark stays."""
    events = table(spark, sf_dir, "events")
    mark = int(frame_slice(events, by_number("event_id")).high_water) + 1
    found = frame_slice(events, by_number("event_id"), str(mark))
    rows = in_window(events, window_for(by_number("event_id"), str(mark))) if found.df is None else found.df
    return rows.agg(F.count("*").alias("n"), F.max("event_id").alias("last_point"))


@query("slice_bounds", "select min(ts) as lo, max(ts) as hi from events where event_id >= 500")
def bounds_of_slice(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return slice_bounds(in_window(events, window_for(by_number("event_id"), "500")), ["ts"])


def mark_row(spark: SparkSession, data: Slice) -> DataFrame:
    return spark.createDataFrame([(data.high_water,)], "last_point string")


@query(
    "high_water_mark",
    "select strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') as last_point from events "
    "where ts >= TIMESTAMP '2024-01-15'",
)
def high_water_mark(spark, sf_dir):
    return mark_row(spark, frame_slice(table(spark, sf_dir, "events"), by_time("ts"), "2024-01-15"))


@query(
    "high_water_multi",
    "select strftime(greatest(max(created_at), max(updated_at)), '%Y-%m-%d %H:%M:%S.%f') as last_point "
    f"from {CU}",
)
def high_water_multi(spark, sf_dir):
    return mark_row(spark, frame_slice(created_updated(spark, sf_dir), by_time(["created_at", "updated_at"])))


JOINED = (
    "(SELECT c_mktsegment, o_orderkey, o_orderdate FROM orders "
    "JOIN customer ON o_custkey = c_custkey {query_filter}) q"
)


def _joined(spark, sf_dir, last_point, **options) -> Slice:
    spec = TableSpec("orders", "orders", custom_query=JOINED, **options)
    views = {"orders": "orders.parquet", "customer": "customer.parquet"}
    return Files(sf_dir, views=views).extract(spark, spec, last_point)


@query(
    "custom_query_full",
    "select c_mktsegment, o_orderkey, o_orderdate from orders join customer on o_custkey = c_custkey",
)
def custom_query_full(spark, sf_dir):
    return _joined(spark, sf_dir, None).df


@query(
    "custom_query_incremental",
    "select c_mktsegment, o_orderkey, o_orderdate from orders join customer on o_custkey = c_custkey "
    "where o_orderdate >= TIMESTAMP '2000-01-01'",
)
def custom_query_incremental(spark, sf_dir):
    return _joined(
        spark, sf_dir, "2000-01-01", replication_method="incremental",
        iterate_column="o_orderdate", iterate_column_type="datetime",
    ).df


@query("partition_bounds", "select min(l_orderkey) as lo, max(l_orderkey) as hi from lineitem")
def partition_bounds(spark, sf_dir):
    return FileSource(sf_dir).bounds(spark, "lineitem.parquet", ["l_orderkey"])


@query(
    "incremental_file_marks",
    "select o_orderkey, o_custkey, 'first' as run from orders union all select o_orderkey, o_custkey, 'second' from orders "
    "where greatest(o_orderkey, o_custkey) >= (select max(greatest(o_orderkey, o_custkey)) from orders)",
)
def incremental_file_marks(spark, sf_dir):
    """Whole-number marks of a file table come from its footers, in a first run and in a later one."""
    source = FileSource(sf_dir)
    spec = TableSpec("orders.parquet", "orders", "incremental", ["o_orderkey", "o_custkey"], "int")
    first = source.extract(spark, spec)
    second = source.extract(spark, spec, first.high_water)
    rows = [s.df.select("o_orderkey", "o_custkey", F.lit(run).alias("run")) for s, run in ((first, "first"), (second, "second"))]
    return rows[0].unionByName(rows[1])


@query(
    "partition_bounds_filtered",
    "select min(l_orderkey) as lo, max(l_orderkey) as hi from lineitem where l_shipdate >= TIMESTAMP '2000-01-01'",
)
def partition_bounds_filtered(spark, sf_dir):
    window = window_for(by_time("l_shipdate"), "2000-01-01")
    return slice_bounds(in_window(table(spark, sf_dir, "lineitem"), window), ["l_orderkey"])
