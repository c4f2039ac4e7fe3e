"""What Spark does with the queries: pushed filters, pruned columns, shuffles."""

import pytest
from pyspark.sql import functions as F

from tablesync.functions.window import slice_bounds
from tablesync.operators import key_violations, latest_per_key, merge_columns, upsert_rows
from tablesync.plans.runlog import RunLog, latest_state
from tablesync.queries import QUERIES
from tablesync.targets import FileTarget, Layout, files
from places import SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def orders(spark):
    return spark.read.parquet(f"{SMALL}/orders.parquet")


def test_incremental_filter_reaches_the_scan_without_a_shuffle(spark, setting):
    setting("spark.sql.maxMetadataStringLength", "1000")
    text = plan(QUERIES["incremental_datetime"](spark, SMALL))
    assert "GreaterThanOrEqual(o_orderdate,2000-01-01T00:00)" in text and "LessThanOrEqual(o_orderdate" in text
    assert "Exchange" not in text


def test_bounds_read_one_column(spark):
    text = plan(slice_bounds(spark.read.parquet(f"{SMALL}/lineitem.parquet"), ["l_orderkey"]))
    assert "ReadSchema: struct<l_orderkey:bigint>" in text


def test_small_batch_never_shuffles_the_target(spark, orders):
    batch = orders.where("o_orderdate >= timestamp_ntz'2001-01-01'")
    for result in (
        upsert_rows(orders, batch, ["o_orderkey"], True),
        merge_columns(orders, batch.select("o_orderkey", "o_orderstatus"), ["o_orderkey"], True),
    ):
        text = plan(result)
        assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text and "hashpartitioning" not in text


def test_large_batch_is_sort_merged_however_small_its_files(spark, orders):
    text = plan(upsert_rows(orders, orders, ["o_orderkey"], False))
    assert "SortMergeJoin" in text and "Broadcast" not in text
    text = plan(merge_columns(orders, orders.select("o_orderkey", "o_orderstatus"), ["o_orderkey"], False))
    assert text.count("SortMergeJoin") == 2 and "LeftOuter" in text and "LeftAnti" in text and "FullOuter" not in text


def test_hot_key_of_a_large_merge_is_split(spark, setting):
    """A third of the target's rows have one key: adaptive execution deals them to several tasks."""
    for name, value in (("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "64KB"), ("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.5"),
                        ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB"), ("spark.sql.adaptive.coalescePartitions.enabled", "false"),
                        ("spark.sql.shuffle.partitions", "12")):
        setting(name, value)
    target = spark.range(0, 90_000, 1, 8).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") + 100).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"), F.lit(0).alias("n"))
    batch = spark.range(0, 60_000, 1, 4).select(F.col("id").alias("k"), F.lit(1).alias("n"))
    merged = merge_columns(target, batch, ["k"], False)
    whole = merged.where("v is not null").groupBy(F.spark_partition_id()).agg(F.count("*").alias("rows"), F.max("v"))  # rows keep their width
    sizes = [r["rows"] for r in whole.collect()]
    assert sum(sizes) == 90_000 and max(sizes) < 20_000
    assert merged.where("v is null").count() == 60_000 - target.join(batch, "k", "left_semi").select("k").distinct().count()


@pytest.mark.parametrize("threshold, join", [("10MB", True), ("1KB", False), ("-1", False)])
def test_size_in_memory_decides_on_the_broadcast(spark, orders, tmp_path, setting, monkeypatch, threshold, join):
    setting("spark.sql.autoBroadcastJoinThreshold", threshold)
    seen = []
    monkeypatch.setattr(files, "upsert_rows", lambda t, b, k, small: seen.append(small) or upsert_rows(t, b, k, small))
    target = FileTarget(spark, str(tmp_path / "t"))
    target.upsert(orders, ["o_orderkey"])
    target.upsert(orders, ["o_orderkey"])
    assert seen == [join] and target.read().count() == orders.count()


def test_only_keys_of_the_batch_enter_the_upsert_join(spark, orders):
    keys = plan(upsert_rows(orders, orders, ["o_orderkey"], False).groupBy().count())
    assert "ReadSchema: struct<o_orderkey:bigint>" in keys


def test_null_keys_skip_the_join(spark, orders):
    assert "PushedFilters: [IsNull(o_orderkey)]" in plan(upsert_rows(orders, orders, ["o_orderkey"], True))


def test_dedup_cuts_groups_before_the_shuffle(spark, orders):
    text = plan(latest_per_key(orders, ["o_custkey"], "o_orderdate"))
    before = text[text.index("Exchange"):]
    assert "WindowGroupLimit" in before and text.count("Exchange hashpartitioning") == 1


def test_counts_and_states_are_aggregated_before_the_shuffle(spark, orders):
    text = plan(key_violations(orders, ["o_custkey"]))
    assert "partial_count" in text and text.count("Exchange") == 1
    text = plan(latest_state(orders.select("o_custkey", "o_orderkey", "o_orderdate"), ["o_custkey"], "o_orderdate"))
    assert "partial_max_by" in text and text.count("Exchange") == 1


def test_states_are_filtered_before_duplicates_are_removed(spark, tmp_path):
    """With loose events beside packed ones, the history of other tables is not shuffled."""
    log = RunLog(spark, str(tmp_path / "log"))
    for k in range(6):
        log.record("p", f"t{k}", "completed", last_point=str(k))
    log.compact(over=3)
    log.record("p", "t1", "failed")
    text = plan(log.events(lambda rows: rows.where("table_name = 't1'")))
    assert "PushedFilters: [IsNotNull(table_name), EqualTo(table_name,t1)]" in text
    assert log.state("p", "t1").status == "failed" and log.state("p", "t1").last_point == "1"
    found = log.states([("p", "t1"), ("p", "t5")])
    assert {k: (s.status, s.last_point) for k, s in found.items()} == {("p", "t1"): ("failed", "1"), ("p", "t5"): ("completed", "5")}


def test_partition_filter_prunes_folders(spark, orders, tmp_path):
    target = FileTarget(spark, str(tmp_path / "t"), layout=Layout(partition_by=("o_orderstatus",)))
    target.replace(orders)
    text = plan(target.read().where("o_orderstatus = 'F'").select("o_orderkey"))
    assert "PartitionFilters: [isnotnull(o_orderstatus" in text
    assert "ReadSchema: struct<o_orderkey:bigint>" in text


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_hot_slot_is_written_by_several_tasks(spark, tmp_path, setting, adaptive):
    """Nine tenths of the rows are in one slot; its rows are split, not gathered."""
    setting("spark.sql.adaptive.enabled", adaptive)
    setting("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200KB")
    setting("spark.sql.adaptive.coalescePartitions.minPartitionSize", "100KB")
    target = FileTarget(spark, str(tmp_path / "t"), layout=Layout(partition_by=("p",)))
    rows = spark.range(0, 300_000, 1, 8).select(
        "id", F.when(F.col("id") % 10 != 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 7)).alias("p"),
        F.sha2(F.col("id").cast("string"), 256).alias("v"),
    )
    target.replace(rows)
    hot = target.read().where("p = 'hot'")
    parts = hot.groupBy(F.input_file_name()).count().collect()
    assert len(parts) > 2 and sum(r["count"] for r in parts) == 270_000
