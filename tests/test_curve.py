"""Layout along a space-filling curve, and what it lets readers skip."""

import pytest
from pyspark.sql import functions as F

from tablesync.errors import ConfigError
from tablesync.functions.curve import z_place
from tablesync.targets import FileLogTarget


def test_places_interleave_the_bits_of_ranks(spark):
    grid = spark.range(16).select((F.col("id") % 4).alias("x"), F.floor(F.col("id") / 4).alias("y"))
    places = {(r.x, r.y): r.p for r in grid.withColumn("p", z_place(grid, ["x", "y"], bits=2)).collect()}
    # exact quantiles of 0..3: ranks 1, 2, 3, 3 follow the cuts 0, 1, 2
    rank = lambda v: sum(v >= c for c in (0, 1, 2))
    assert places == {(x, y): sum((rank(x) >> b & 1) << 2 * b + 1 | (rank(y) >> b & 1) << 2 * b for b in range(2)) for x, y in places}


def test_a_filter_on_two_columns_opens_few_files(spark, tmp_path):
    """64 files of a skewed and an even column: 1/16 of each column's ranks meets about a quarter of the files at most."""
    rows = spark.range(60_000).select(F.pow(F.pmod(F.xxhash64("id"), F.lit(1000)), F.lit(3)).cast("long").alias("a"), F.pmod(F.hash("id"), F.lit(5000)).alias("b"), "id")
    rows = rows.withColumn("b", F.when(F.col("id") % 50 != 0, F.col("b")))
    table = FileLogTarget(spark, str(tmp_path / "z"), key=["a", "b"], z_order=64)
    table.replace(rows)
    files = table.files()
    assert len(files) == 64
    for between in ({"a": (500**3, 560**3), "b": (2000, 2300)}, {"a": (None, 60**3), "b": (4700, None)}):
        met = table.meeting(table.state(), between)
        assert 0 < len(met) <= 8
        (la, ha), (lb, hb) = between["a"], between["b"]
        want = rows.where((F.col("a") >= (la or 0)) & (F.col("a") <= ha) & (F.col("b") >= lb) & (F.col("b") <= (hb or 10**9)))
        assert sorted(r.id for r in table.read(between).collect()) == sorted(r.id for r in want.collect())
    for one in ({"a": (500**3, 560**3)}, {"b": (2000, 2300)}):  # either column alone prunes as well
        assert len(table.meeting(table.state(), one)) <= 24
    assert table.read().count() == 60_000 and table.read({"id": (5, 9)}).count() == 5


def test_text_has_no_place(spark, tmp_path):
    with pytest.raises(ConfigError):
        FileLogTarget(spark, str(tmp_path / "z"), key=["s"], z_order=4).replace(spark.createDataFrame([("a",)], "s string"))
