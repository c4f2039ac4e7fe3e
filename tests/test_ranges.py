"""Ranges of equal size, and catalog tables under both overwrite modes."""

import uuid

import pytest
from pyspark.sql import functions as F

from tablesync.connections import Files
from tablesync.errors import ConfigError
from tablesync.plans.ranges import balanced_ranges, range_number
from tablesync.spec import TableSpec
from tablesync.targets import FileLogTarget, TableTarget


def sizes(df, ranges, key):
    return {r.part: r["count"] for r in df.groupBy(range_number(ranges, key).alias("part")).count().collect()}


@pytest.mark.parametrize("expression", ["id * id * id", "cast(pow(id, 3) as double)", "date_add(date'2000-01-01', cast(id * id % 9000 as int))", "concat('k', id * id)"])
def test_skewed_keys_give_even_ranges(spark, expression):
    rows = spark.range(20_000).withColumn("k", F.when(F.col("id") % 9 != 0, F.expr(expression)))
    ranges = balanced_ranges(rows, F.col("k"), 8)
    found = sizes(rows, ranges, F.col("k"))
    nulls = found.pop(len(ranges) - 1)
    assert nulls == rows.where("k is null").count() and None not in found and sum(found.values()) + nulls == 20_000
    assert len(found) == 8 and max(found.values()) <= 2 * min(found.values())


def test_hot_value_empty_table_and_one_range(spark):
    rows = spark.range(900).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("k"))
    found = sizes(rows, balanced_ranges(rows, F.col("k"), 10), F.col("k"))
    assert sum(found.values()) == 900 and None not in found
    none = rows.where("false")
    assert sizes(none, balanced_ranges(none, F.col("k"), 10), F.col("k")) == {}
    assert sizes(rows, balanced_ranges(rows, F.col("k"), 1), F.col("k")) == {0: 900}


@pytest.mark.parametrize("mode", ["static", "dynamic"])
def test_truncate_insert_of_a_catalog_table_leaves_no_old_row(spark, setting, mode):
    setting("spark.sql.sources.partitionOverwriteMode", mode)
    name = f"t_{uuid.uuid4().hex}"
    target = TableTarget(spark, name, partition_by=["p"])
    try:
        target.append(spark.range(10).select("id", (F.col("id") % 2).alias("p")))
        target.truncate_insert(spark.range(100, 105).select("id", F.lit(1).cast("long").alias("p")))
        assert sorted(r.id for r in target.read().collect()) == list(range(100, 105))
        assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == mode
    finally:
        spark.sql(f"drop table {name}")


def test_tables_with_a_file_log_are_targets_and_sources(spark, tmp_path):
    files = Files(str(tmp_path))
    spec = TableSpec("t", "t", write_strategy="upsert", write_key=["id"], upsert_unit="marks")
    target = files.target(spark, spec)
    assert isinstance(target, FileLogTarget)
    target.upsert(spark.range(5), ["id"])
    target.upsert(spark.range(3, 8), ["id"])
    assert sorted(r.id for r in files.frame(spark, "t").collect()) == list(range(8))
    for wrong in (dict(upsert_unit="rows"), dict(upsert_unit="files", key_buckets=4, write_key=["id"]), dict(upsert_unit="files", partition_by=["p"])):
        with pytest.raises(ConfigError):
            TableSpec("t", "t", **wrong)
    with pytest.raises(ConfigError):
        Files(str(tmp_path), format="orc").target(spark, spec)
