"""Bounds from file footers, and where rows must be read for them."""

import logging
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from places import SMALL
from tablesync.queries import QUERIES
from tablesync.sources import footers, frames
from tablesync.sources.footers import footer_bounds
from tablesync.sources.frames import FileSource
from tablesync.spec import TableSpec


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def marks(name, column, **more):
    return TableSpec(name, "t", "incremental", column, "int", **more)


@pytest.fixture
def scans(monkeypatch):
    """Bounds asked of rows instead of footers."""
    seen, inner = [], frames.slice_bounds
    monkeypatch.setattr(frames, "slice_bounds", lambda *a: seen.append(a[1]) or inner(*a))
    return seen


def test_bounds_are_pushed_to_the_footers(spark):
    text = plan(QUERIES["partition_bounds"](spark, SMALL))
    assert "PushedAggregation: [MIN(l_orderkey), MAX(l_orderkey)]" in text


@pytest.mark.parametrize("format", ["parquet", "orc"])
def test_formats_and_old_marks(spark, tmp_path, scans, format):
    spark.range(100).select("id", (F.col("id") % 7).cast("int").alias("n"), F.lit("x").alias("id2")).repartition(3).write.format(format).save(f"{tmp_path}/t")
    source = FileSource(str(tmp_path), format)
    first = source.extract(spark, marks("t", "id"))
    assert (first.high_water, first.df.count()) == ("99", 100)
    again = source.extract(spark, marks("t", "id"), "99")
    assert (again.high_water, again.df.count(), again.mode) == ("99", 1, "append")
    assert source.extract(spark, marks("t", "id"), "100").df is None
    assert source.extract(spark, marks("t", "n"), "5").df.count() == 28
    assert scans == []
    assert "PushedAggregation" in plan(source.bounds(spark, "t", ["id"]))


def test_an_upper_bound_an_expression_and_a_mix_of_types_read_rows(spark, tmp_path, scans):
    spark.range(50).select("id", F.col("id").cast("int").alias("n"), F.timestamp_seconds("id").cast("timestamp_ntz").alias("t")).write.parquet(f"{tmp_path}/t")
    source = FileSource(str(tmp_path))
    assert source.extract(spark, marks("t", "id", filter_lower_bound=10, filter_upper_bound=20)).df.count() == 10
    assert source.extract(spark, marks("t", "id + 1"), "50").df.count() == 1
    assert source.extract(spark, marks("t", ["id", "n"]), "48").df.count() == 2
    times = TableSpec("t", "t", "incremental", "t", "datetime")
    assert source.extract(spark, times).high_water == "1970-01-01 00:00:49.000000"
    assert len(scans) == 4


def test_row_groups_without_statistics_fall_back(spark, tmp_path, scans):
    rows = spark.createDataFrame([(1, None), (2, None)], "id long, n int")
    rows.write.parquet(f"{tmp_path}/t")
    source = FileSource(str(tmp_path))
    logging.getLogger(footers.__name__).setLevel(logging.INFO)
    whole = source.extract(spark, marks("t", "n"))
    assert whole.high_water is None and whole.df.count() == 2
    assert source.extract(spark, marks("t", "n"), "1").df is None
    rows.limit(0).write.parquet(f"{tmp_path}/none")
    assert source.extract(spark, marks("none", "id")).df.count() == 0
    rows.union(spark.createDataFrame([(3, 9)], rows.schema)).repartition(3).write.parquet(f"{tmp_path}/part")
    some = source.extract(spark, marks("part", "n"))
    assert some.high_water == "9" and some.df.count() == 3


def test_dates_and_narrower_old_files(spark, tmp_path, scans):
    days = spark.createDataFrame([(date(2024, 1, d), d) for d in range(1, 20)], "d date, n int")
    days.write.parquet(f"{tmp_path}/t")
    days.select("d", (F.col("n") + 5_000_000_000).cast("long").alias("n")).write.mode("append").parquet(f"{tmp_path}/t")
    source = FileSource(str(tmp_path), schemas={"t": "d date, n long"})
    spec = TableSpec("t", "t", "incremental", "d", "datetime")
    assert source.extract(spark, spec).high_water == "2024-01-19 00:00:00.000000"
    assert source.extract(spark, spec, "2024-01-18 12:00:00").df.count() == 2
    assert source.extract(spark, spec, str(datetime(2024, 1, 20))).df is None
    assert source.extract(spark, marks("t", "n")).high_water == "5000000019"
    assert source.extract(spark, marks("t", "n"), "5000000019").df.count() == 1


def test_where_footers_cannot_tell(spark):
    lines = spark.read.parquet(f"{SMALL}/lineitem.parquet").schema
    path = f"{SMALL}/lineitem.parquet"
    assert footer_bounds(spark, "csv", {}, path, lines, ["l_orderkey"]) is None
    assert footer_bounds(spark, "parquet", {}, path, lines, ["l_shipdate"]) is None
    assert footer_bounds(spark, "parquet", {}, path, lines, ["l_orderkey + 1"]) is None
    both = footer_bounds(spark, "parquet", {}, path, lines, ["l_orderkey", "l_partkey"]).first()
    rows = spark.read.parquet(path).agg(F.least(F.min("l_orderkey"), F.min("l_partkey")), F.greatest(F.max("l_orderkey"), F.max("l_partkey"))).first()
    assert tuple(both) == tuple(rows)
