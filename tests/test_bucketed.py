"""Tables in Spark's own buckets, joined where they lie."""

import re

import pytest
from pyspark.sql import functions as F

from tablesync import Files, TableSpec
from tablesync.errors import ConcurrentWriteError, ConfigError, DuplicateKeyError, LoadError
from tablesync.targets import BucketedTarget, FileTarget


@pytest.fixture
def target(spark, tmp_path):
    return BucketedTarget(spark, str(tmp_path / "t"), key=["k"], buckets=4)


@pytest.fixture
def executed(spark, monkeypatch):
    """Plans of the rows that buckets were written from."""
    plans, inner = [], BucketedTarget._put

    def put(self, storage, df, layout, place):
        if storage is self.storage:
            plans.append(place(df)._jdf.queryExecution().executedPlan().toString())
        return inner(self, storage, df, layout, place)

    monkeypatch.setattr(BucketedTarget, "_put", put)
    return plans


def frame(spark, ids, value):
    return spark.createDataFrame([(i, f"{value}{i}") for i in ids], "k long, v string")


def by_hand(*batches):
    held, loose = {}, []
    for ids, value in batches:
        for i in ids:
            if i is None:
                loose.append((None, f"{value}{i}"))
            else:
                held[i] = f"{value}{i}"
    return sorted([*held.items(), *loose], key=repr)


def test_a_large_batch_does_not_shuffle_the_table(spark, target, rows, executed):
    target.replace(frame(spark, range(500), "a"))
    target.append(frame(spark, range(500, 700), "b"))
    executed.clear()
    target.upsert(frame(spark, [*range(250, 900), None, None], "c"), ["k"])
    (text,) = executed
    assert text.count("SortMergeJoin") == 2 and "Exchange" not in text and "Broadcast" not in text
    assert text.count("Bucketed: true") == 4
    assert rows(target.read()) == by_hand((range(500), "a"), (range(500, 700), "b"), ([*range(250, 900), None, None], "c"))
    executed.clear()
    target.upsert(frame(spark, [1, None, 899, 1000], "d"), ["k"])
    assert "Exchange" not in executed[0]
    want = by_hand((range(500), "a"), (range(500, 700), "b"), ([*range(250, 900), None, None], "c"), ([1, None, 899, 1000], "d"))
    assert rows(target.read()) == want
    assert spark.sql("SHOW TABLES").where("tableName like 'tablesync%'").count() == 0


def test_buckets_do_not_multiply_files(spark, target):
    target.replace(frame(spark, range(400), "a"))
    for n in range(4):
        target.upsert(frame(spark, range(n, 400, 5), "b"), ["k"])
    files = target.read().select(F.input_file_name()).distinct().collect()
    assert len(files) <= 2 * 4


def test_narrower_batches_newest_rows_and_doubled_keys(spark, target, rows, executed):
    wide = spark.createDataFrame([(i, f"v{i}", i % 5) for i in range(60)], "k long, v string, at int")
    target.replace(wide)
    executed.clear()
    target.merge(spark.createDataFrame([(5, "x"), (70, "y"), (None, "z")], "K long, V string"), ["K"])
    assert not re.search(r"Exchange(?!.*SinglePartition)", executed[-1])
    held = {r.k: (r.v, r.at) for r in target.read().collect() if r.k is not None}
    assert held[5] == ("x", 0) and held[70] == ("y", None) and held[6] == ("v6", 1) and len(held) == 61
    batch = spark.createDataFrame([(4, "old", 1), (6, "new", 9)], wide.schema)
    target.upsert(batch, ["k"], order="at", newest=True)
    held = {r.k: r.v for r in target.read().collect()}
    assert held[4] == "v4" and held[6] == "new" and held[None] == "z"
    twice = spark.createDataFrame([(1, "p", 1), (1, "q", 2)], wide.schema)
    with pytest.raises(DuplicateKeyError):
        target.upsert(twice, ["k"])
    target.upsert(twice, ["k"], duplicates="latest", order="at")
    assert {r.k: r.v for r in target.read().collect()}[1] == "q"


def test_a_third_of_all_rows_without_a_key(spark, target):
    rows = spark.range(0, 30_000, 1, 8).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("k"), F.lit("a").alias("v"))
    target.replace(rows)
    lacking = target.read().where("k is null").groupBy(F.input_file_name()).count().collect()
    assert len(lacking) == 8 and sum(r["count"] for r in lacking) == 10_000
    target.upsert(rows.withColumn("v", F.lit("b")), ["k"])
    assert target.read().groupBy("v").count().orderBy("v").collect() == [("a", 10_000), ("b", 30_000)]


def test_empty_tables_and_batches(spark, target, rows):
    target.replace(frame(spark, range(3), "a").where("false"))
    assert target.read().count() == 0
    target.upsert(frame(spark, [1], "a"), ["k"])
    target.upsert(frame(spark, [1], "b").where("false"), ["k"])
    assert rows(target.read()) == [(1, "a1")]
    target.truncate_insert(frame(spark, [2], "c"))
    target.rewrite()
    assert rows(target.read()) == [(2, "c2")]


def test_what_is_refused(spark, target, tmp_path):
    target.replace(spark.createDataFrame([(1, "a")], "k int, v string"))
    with pytest.raises(LoadError):
        target.append(frame(spark, [2], "a"))
    with pytest.raises(LoadError):
        target.upsert(frame(spark, [2], "a"), ["k"])
    with pytest.raises(ConfigError):
        target.upsert(spark.createDataFrame([(1, "a")], "k int, v string"), ["v"])
    with pytest.raises(ConfigError):
        FileTarget(spark, str(tmp_path / "t")).append(spark.createDataFrame([(1, "a")], "k int, v string"))
    with pytest.raises(ConfigError):
        BucketedTarget(spark, str(tmp_path / "u"), key=[], buckets=3)
    with pytest.raises(ConfigError):
        TableSpec("a", "b", write_key=["k"], upsert_unit="buckets")
    spec = TableSpec("a", "b", write_strategy="upsert", write_key=["k"], key_buckets=3, upsert_unit="buckets")
    made = Files(str(tmp_path)).target(spark, spec)
    made.upsert(frame(spark, [1, 2], "a"), ["k"])
    assert isinstance(made, BucketedTarget) and Files(str(tmp_path)).frame(spark, "b").count() == 2


def test_an_upsert_that_comes_second_is_refused(spark, tmp_path, rows, monkeypatch):
    first, second = (BucketedTarget(spark, str(tmp_path / "t"), key=["k"], buckets=2) for _ in range(2))
    first.replace(frame(spark, range(4), "a"))
    inner = second._publish

    def late(*args):
        first.upsert(frame(spark, [1], "b"), ["k"])
        return inner(*args)

    monkeypatch.setattr(second, "_publish", late)
    with pytest.raises(ConcurrentWriteError):
        second.upsert(frame(spark, [1], "c"), ["k"])
    assert rows(first.read())[1] == (1, "b1")
