from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tablesync.errors import ConcurrentWriteError, ConfigError, DuplicateKeyError, LoadError
from tablesync.targets import FileTarget, Layout, files

SCHEMA = "k int, v string"


@pytest.fixture
def target(spark, tmp_path):
    def make(name="t", **options):
        return FileTarget(spark, str(tmp_path / name), **options)

    return make


@pytest.fixture
def frame(spark):
    return lambda data, schema=SCHEMA: spark.createDataFrame(data, schema)


def test_append_adds_and_replace_takes_the_new_schema(target, frame, rows):
    t = target()
    assert not t.exists()
    with pytest.raises(LoadError):
        t.read()
    t.append(frame([(1, "a")]))
    t.append(frame([(1, "a"), (2, "b")]))
    assert rows(t.read()) == [(1, "a"), (1, "a"), (2, "b")]
    t.replace(frame([(5.0,)], "w double"))
    assert t.read().columns == ["w"] and rows(t.read()) == [(5.0,)]


def test_a_table_can_be_replaced_by_a_query_on_itself(target, frame, rows):
    t = target()
    t.replace(frame([(1, "a")]))
    t.replace(t.read().unionByName(t.read()))
    assert rows(t.read()) == [(1, "a"), (1, "a")]


def test_a_reader_keeps_the_state_it_opened(target, frame, rows):
    t = target()
    t.replace(frame([(1, "old")]))
    opened = t.read()
    t.replace(frame([(2, "new")]))
    assert rows(opened) == [(1, "old")]


def test_truncate_insert_keeps_schema_and_layout(target, frame, rows):
    t = target(layout=Layout(partition_by=("v",)))
    t.replace(frame([(1, "a")]))
    FileTarget(t.spark, t.storage.root).truncate_insert(frame([("b", 7)], "V string, K bigint"))
    assert [f.dataType.simpleString() for f in t.read().schema] == ["int", "string"]
    assert rows(t.read()) == [(7, "b")] and list(t.snapshot().slots) == ["v=b"]
    t.truncate_insert(frame([(9,)], "k int"))
    assert rows(t.read()) == [(9, None)]
    with pytest.raises(LoadError, match="extra"):
        t.truncate_insert(frame([(1, 2)], "k int, extra int"))


def test_values_that_do_not_fit_fail_and_leave_the_table(target, frame, rows, setting):
    t = FileTarget(target().spark, target().storage.root, schema_evolution="strict")
    t.replace(frame([(1, "a")]))
    for ansi in ("true", "false"):
        setting("spark.sql.ansi.enabled", ansi)
        with pytest.raises(Exception):
            t.append(frame([(2**40, "b")], "k bigint, v string"))
        t.append(frame([(7, ansi)], "k bigint, v string"))
    assert rows(t.read()) == [(1, "a"), (7, "false"), (7, "true")]


def test_wider_types_widen_the_column(target, frame, rows):
    t = target()
    t.append(frame([(1, 0.5, 3)], "k int, f float, s smallint"))
    t.append(frame([(2**40, 0.1, 4)], "k bigint, f double, s int"))
    t.upsert(frame([(1, 2.5, 2**20)], "k int, f float, s int"), ["k"])
    assert [f.dataType.simpleString() for f in t.read().schema] == ["bigint", "double", "int"]
    assert rows(t.read()) == [(1, 2.5, 2**20), (2**40, 0.1, 4)]


@pytest.mark.parametrize("value, kind", [
    (5.7, "double"), ("5", "string"), (True, "boolean"), (Decimal("1.50"), "decimal(4,2)"), (datetime(2024, 1, 1, 7), "timestamp_ntz"),
])
def test_types_that_could_lose_something_are_refused(target, frame, rows, value, kind):
    t = target()
    t.append(frame([(1, date(2024, 1, 1))], "k bigint, d date"))
    column = ("d", "k") if kind == "timestamp_ntz" else ("k", "d")
    with pytest.raises(LoadError):
        t.append(frame([(value,)], f"{column[0]} {kind}"))
    assert t.read().count() == 1


@pytest.mark.parametrize("name", ["_v", "_BUCKET", "__hit", "__new_x"])
def test_reserved_names_are_refused_on_every_write(target, frame, name):
    t = target()
    with pytest.raises(ConfigError):
        t.append(frame([(1, 2)], f"k int, {name} int"))
    t.append(frame([(1,)], "k int"))
    for write in (t.append, lambda df: t.upsert(df, ["k"])):
        with pytest.raises(ConfigError):
            write(frame([(1, 2)], f"k int, {name} int"))


def test_sorted_files_stay_sorted_when_there_are_few(target, frame):
    t = FileTarget(target().spark, target().storage.root, layout=Layout(sort_by=("k",)), write_partitions=1)
    t.replace(t.spark.range(1000).selectExpr("cast((id * 7919) % 1000 as int) as k", "'x' as v").repartition(5))
    read = [r["k"] for r in t.read().collect()]
    assert read == sorted(read)


def test_newest_on_a_target_that_holds_a_key_twice(target, frame, rows):
    t = target()
    t.append(frame([(1, 1), (1, 2), (2, 1), (2, 9)], "k int, ts int"))
    t.upsert(frame([(1, 5), (2, 5), (3, 1)], "k int, ts int"), ["k"], duplicates="latest", order="ts", newest=True)
    assert rows(t.read()) == [(1, 5), (2, 1), (2, 9), (3, 1)]


LAYOUTS = [
    Layout(), Layout(partition_by=("v",)), Layout(key_buckets=3, key=("k",)),
    Layout(partition_by=("k",), sort_by=("v",)), Layout(cluster_by=("v",)),
    Layout(partition_by=("v",), cluster_by=("k",)),
]


@pytest.mark.parametrize("layout", LAYOUTS, ids=str)
@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_upsert_in_every_layout(target, frame, rows, setting, layout, threshold):
    setting("spark.sql.autoBroadcastJoinThreshold", threshold)
    t = target(layout=layout)
    t.upsert(frame([(1, "a"), (2, "b"), (3, "c"), (None, "n")]), ["k"])
    t.upsert(frame([(2, "B"), (4, "a"), (None, "m"), (3, "a")]), ["K"])
    assert rows(t.read()) == sorted(
        [(1, "a"), (2, "B"), (3, "a"), (4, "a"), (None, "n"), (None, "m")], key=repr
    )


@pytest.mark.parametrize("layout", LAYOUTS, ids=str)
@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_narrow_batch_keeps_other_columns_in_every_layout(target, frame, rows, setting, layout, threshold):
    setting("spark.sql.autoBroadcastJoinThreshold", threshold)
    t = target(layout=layout)
    t.merge(frame([(1, "a", 1), (2, "b", 2), (None, "n", 3)], "k int, v string, w int"), ["k"])
    t.merge(frame([(20, 2), (30, 3), (40, None)], "w int, k int"), ["k"])
    assert rows(t.read()) == sorted(
        [(1, "a", 1), (2, "b", 20), (3, None, 30), (None, "n", 3), (None, None, 40)], key=repr
    )


def test_only_touched_slots_are_rewritten(target, frame):
    t = target(layout=Layout(partition_by=("v",)))
    t.upsert(frame([(1, "a"), (2, "b"), (3, "c")]), ["k"])
    before = t.snapshot().slots
    t.upsert(frame([(1, "b")]), ["k"])
    after = t.snapshot().slots
    assert "v=a" not in after and after["v=c"] == before["v=c"]
    assert after["v=b"][0] == before["v=b"][0] and len(after["v=b"]) == 2


def test_null_keys_are_never_rewritten(target, frame):
    t = target(layout=Layout(key_buckets=2, key=("k",)))
    t.upsert(frame([(None, "a"), (1, "b")]), ["k"])
    first = t.snapshot().slots["_bucket=-1"]
    t.upsert(frame([(None, "c"), (1, "d")]), ["k"])
    assert t.snapshot().slots["_bucket=-1"][:1] == first and len(t.snapshot().slots["_bucket=-1"]) == 2


def test_odd_partition_values_are_found_again(target, frame, rows):
    odd = ["a b", "a+b", "a%b", "a:b", "a/b", "ä", "{x}", "*", "__x", None, "a=b", "007"]
    t = target(layout=Layout(partition_by=("v",)))
    t.upsert(frame(list(enumerate(odd))), ["k"])
    assert rows(t.read()) == sorted(enumerate(odd), key=repr)
    t.upsert(frame([(i, "moved") for i in range(len(odd))]), ["k"])
    assert rows(t.read()) == [(i, "moved") for i in sorted(range(len(odd)), key=lambda i: repr((i,)))]
    assert list(t.snapshot().slots) == ["v=moved"]


def test_empty_partition_values_are_refused(target, frame, rows):
    t = target(layout=Layout(partition_by=("v",)))
    t.append(frame([(1, None)]))
    with pytest.raises(LoadError, match="empty strings"):
        t.append(frame([(2, "")]))
    assert rows(t.read()) == [(1, None)]


@pytest.mark.parametrize("value", [
    "DATE '2024-02-29'", "TIMESTAMP_NTZ '2024-01-01 10:00:00.123456'", "TIMESTAMP '2024-01-01 10:00:00.5'",
    "true", "CAST(-12.30 AS DECIMAL(10,2))", "9007199254740993L", "0.1D", "1.0E300D", "CAST('x' AS STRING)",
])
def test_partition_values_of_every_type(target, spark, value):
    t = target(layout=Layout(partition_by=("p",)))
    df = spark.sql(f"SELECT 1 AS k, {value} AS p UNION ALL SELECT 2, NULL")
    t.upsert(df, ["k"])
    assert t.read().schema["p"].dataType == df.schema["p"].dataType
    assert t.read().exceptAll(df).isEmpty() and df.exceptAll(t.read()).isEmpty()
    t.upsert(df.where("k = 1").withColumn("p", F.lit(None).cast(df.schema["p"].dataType)), ["k"])
    assert t.read().where("p IS NULL").count() == 2


def test_partition_columns_keep_type_and_place(target, frame, rows):
    t = target(layout=Layout(partition_by=("p",)))
    t.replace(frame([("007", 1)], "p string, k int"))
    assert t.read().columns == ["p", "k"] and rows(t.read()) == [("007", 1)]


def test_doubled_keys_are_refused_before_anyone_sees_them(target, frame, rows):
    t = target()
    with pytest.raises(DuplicateKeyError):
        t.upsert(frame([(1, "a"), (1, "b")]), ["k"])
    assert not t.exists()
    t.upsert(frame([(1, "a")]), ["k"])
    with pytest.raises(DuplicateKeyError):
        t.upsert(frame([(1, "b"), (1, "c")]), ["k"])
    assert rows(t.read()) == [(1, "a")]
    left = [n for n in t.storage.names("") if n.startswith("_v=")]
    assert len(left) == 1


def test_doubled_keys_may_be_settled_by_order(target, frame, rows):
    t = target()
    t.upsert(frame([(1, "a"), (1, "b")]), ["k"], duplicates="latest", order="v")
    t.upsert(frame([(2, "c"), (2, "d"), (1, "A")]), ["k"], duplicates="latest", order="v")
    assert rows(t.read()) == [(1, "A"), (2, "d")]
    with pytest.raises(ConfigError):
        t.upsert(frame([(1, "a")]), ["k"], duplicates="latest")


def test_newest_ignores_rows_older_than_the_stored(target, frame, rows):
    t = target(layout=Layout(partition_by=("v",)))
    data = "k int, v string, t int"
    t.upsert(frame([(1, "a", 5), (2, "a", 5)], data), ["k"], order="t", newest=True)
    t.upsert(frame([(1, "b", 4), (2, "b", 6), (3, "b", 1)], data), ["k"], order="t", newest=True)
    assert rows(t.read()) == [(1, "a", 5), (2, "b", 6), (3, "b", 1)]


def test_schema_evolution(target, frame, rows):
    t = target()
    t.append(frame([(1,)], "k int"))
    t.append(frame([(2, "x")]))
    t.upsert(frame([(1, True)], "k int, flag boolean"), ["k"])
    assert t.read().columns == ["k", "v", "flag"]
    assert rows(t.read()) == [(1, None, True), (2, "x", None)]
    strict = FileTarget(t.spark, t.storage.root, schema_evolution="strict")
    with pytest.raises(LoadError):
        strict.append(frame([(1,)], "other int"))


def test_repeated_batch_changes_nothing(target, frame, rows):
    t = target()
    for batch in (("s", 0), ("s", 0), ("s", 1), ("s", 0), ("other", 0)):
        t.append(frame([(1, str(batch))]), batch=batch)
    assert len(rows(t.read())) == 3
    t.upsert(frame([(9, "x")]), ["k"], batch=("s", 1))
    assert len(rows(t.read())) == 3


def test_concurrent_appends_both_stay(target, frame, rows, monkeypatch):
    one, two = target(), target()
    write = FileTarget._write

    def write_and_be_overtaken(self, *args):
        done = write(self, *args)
        if self is one:
            two.append(frame([(2, "b")]))
        return done

    monkeypatch.setattr(FileTarget, "_write", write_and_be_overtaken)
    one.append(frame([(1, "a")]))
    one.append(frame([(3, "c")]))
    assert rows(two.read()) == [(1, "a"), (2, "b"), (2, "b"), (3, "c")]


@pytest.mark.parametrize("layout", [Layout(), Layout(key_buckets=4, key=("k",))], ids=str)
def test_conflicting_upsert_is_refused(target, frame, rows, monkeypatch, layout):
    one, two = target(layout=layout), target(layout=layout)
    one.upsert(frame([(1, "a")]), ["k"])
    publish = FileTarget._publish

    def publish_late(self, *args):
        if self is one:
            two.upsert(frame([(1, "b")]), ["k"])
        publish(self, *args)

    monkeypatch.setattr(FileTarget, "_publish", publish_late)
    with pytest.raises(ConcurrentWriteError):
        one.upsert(frame([(1, "c")]), ["k"])
    assert rows(two.read()) == [(1, "b")]


def test_expire_keeps_what_recent_states_use(target, frame, rows):
    t = target()
    for i in range(4):
        t.replace(frame([(i, "a")]))
    t.append(frame([(9, "b")]))
    t.expire(keep=2, grace=timedelta(0))
    assert rows(t.read()) == [(3, "a"), (9, "b")]
    assert len([n for n in t.storage.names("") if n.startswith("_v=")]) == 2
    assert len(t.storage.names(files.COMMITS)) == 2


def test_expire_leaves_states_within_the_grace(target, frame):
    t = target()
    for i in range(4):
        t.replace(frame([(i, "a")]))
    t.expire(keep=1, grace=timedelta(hours=1))
    assert len(t.storage.names(files.COMMITS)) == 4
    t.expire(keep=1, grace=timedelta(0))
    assert len(t.storage.names(files.COMMITS)) == 1


def test_a_state_that_expires_while_it_is_looked_up(target, frame, rows, monkeypatch):
    t = target()
    t.replace(frame([(1, "a")]))
    listed = t._commits
    answers = [["00000000.json"], listed()]
    monkeypatch.setattr(t, "_commits", lambda: answers.pop(0))
    assert t.snapshot().number == 1


def test_failed_write_leaves_nothing_behind(target, frame, rows):
    t = target()
    t.replace(frame([(1, "a")]))
    with pytest.raises(Exception):
        t.append(frame([("x",)], "v string").selectExpr("raise_error('bad') AS v"))
    assert len([n for n in t.storage.names("") if n.startswith("_v=")]) == 1


def test_expire_spares_a_writer_at_work(target, frame, rows):
    t = target()
    t.replace(frame([(1, "a")]))
    unpublished = t._write(t.storage, frame([(2, "b")]), Layout())
    t.expire()
    assert t.storage.exists(f"_v={unpublished.version}")
    t.expire(orphans_after=timedelta(0))
    assert not t.storage.exists(f"_v={unpublished.version}") and rows(t.read()) == [(1, "a")]


def test_write_partitions_limits_the_files(spark, target):
    t = target(write_partitions=2)
    t.replace(spark.range(0, 100, 1, 8))
    assert len([n for n in t.storage.names(f"_v={t.snapshot().slots[''][0]}") if n.startswith("part-")]) == 2


def test_rewrite_packs_versions(target, frame, rows):
    t = target(write_partitions=1)
    for i in range(3):
        t.append(frame([(i, "a")]))
    t.rewrite()
    assert len(t.snapshot().slots[""]) == 1 and len(rows(t.read())) == 3


def test_empty_batches(target, frame, rows):
    t = target(layout=Layout(partition_by=("v",)))
    t.replace(frame([]))
    assert t.read().columns == ["k", "v"] and rows(t.read()) == []
    t.upsert(frame([(1, "a")]), ["k"])
    t.upsert(frame([]), ["k"])
    t.append(frame([]))
    t.upsert(frame([(5, "z")]).where(F.lit(False)), ["k"])
    t.merge(frame([(5,)], "k int").limit(0), ["k"])
    assert rows(t.read()) == [(1, "a")]


def test_reserved_names_and_bad_layouts_are_refused(target, frame):
    with pytest.raises(ConfigError):
        target().replace(frame([(1,)], "_v int"))
    with pytest.raises(ConfigError):
        Layout(key_buckets=2)
    with pytest.raises(ConfigError):
        Layout(key_buckets=2, key=("k",), partition_by=("p",))


def test_nested_types(target, spark, rows):
    t = target()
    df = spark.sql("SELECT 1 AS k, array(1.5f, 2.5f) AS a, map('x', 1) AS m, named_struct('y', 2) AS s")
    t.upsert(df, ["k"])
    t.upsert(df.withColumn("k", F.lit(2)), ["k"])
    assert t.read().schema["a"].dataType.simpleString() == "array<float>" and t.read().count() == 2


TRICKY = [
    (1, "line\nbreak", datetime(2024, 1, 1, 0, 0, 0, 123456)), (2, " spaces ", None),
    (3, 'quote " and \\ back, comma', datetime(1999, 12, 31, 23, 59, 59, 1)), (4, "", None), (5, None, None),
    (6, "\r\nä<&>", None),
]


@pytest.mark.parametrize("format", ["parquet", "orc", "json", "csv"])
def test_formats_give_back_what_was_written(target, frame, rows, format):
    schema = "k int, v string, t timestamp_ntz"
    t = target(format=format)
    t.append(frame(TRICKY[:3], schema))
    t.append(frame(TRICKY[3:], schema))
    assert rows(t.read()) == sorted(TRICKY, key=repr)
    t.upsert(frame([(1, "x", None)], schema), ["k"])
    assert rows(t.read()) == sorted([(1, "x", None), *TRICKY[1:]], key=repr)


def test_clustering_cuts_through_a_hot_value(spark, tmp_path, setting):
    """One value holds all rows, spread over input tasks: no output task gets them all."""
    setting("spark.sql.adaptive.coalescePartitions.enabled", "false")
    t = FileTarget(spark, str(tmp_path / "hot"), layout=Layout(cluster_by=("flag",), sort_by=("id",)))
    t.replace(spark.range(0, 40_000, 1, 8).select("id", F.lit("F").alias("flag")))
    sizes = [r["n"] for r in t.read().groupBy(F.input_file_name().alias("f")).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 40_000 and len(sizes) > 1 and max(sizes) <= 20_000


def test_no_csv_text_equals_the_marker_of_null(spark, tmp_path, rows):
    """Texts of the marker's character come back, as values, as keys and as names of folders."""
    held = [("\u0001", 1, "\u0001"), ("\u0001\u0001", 2, "p"), ("", 3, "p"), (None, 4, "\u0001"), ("a\u0001", 5, "p"), ("\u0001a", 6, "q")]
    for layout in (Layout(), Layout(partition_by=("p",)), Layout(key_buckets=2, key=("k",))):
        target = FileTarget(spark, str(tmp_path / f"t{layout.key_buckets}{len(layout.partition_by)}"), format="csv", layout=layout)
        target.append(spark.createDataFrame(held, "k string, n int, p string"))
        assert rows(target.read()) == sorted(held, key=repr)
        target.upsert(spark.createDataFrame([("\u0001", 7, "p"), ("\u0001\u0001\u0001", 8, "p")], "k string, n int, p string"), ["k"])
        want = [r for r in held if r[0] != "\u0001"] + [("\u0001", 7, "p"), ("\u0001\u0001\u0001", 8, "p")]
        assert rows(target.read()) == sorted(want, key=repr)


@pytest.mark.parametrize("layout", [Layout(), Layout(sort_by=("k",))])
def test_write_partitions_give_no_task_more_the_larger_the_table(spark, setting, target, tmp_path, layout):
    """Two files while these are small, and as many as it takes when they are not."""
    for name in ("advisoryPartitionSizeInBytes", "coalescePartitions.minPartitionSize"):
        setting(f"spark.sql.adaptive.{name}", "64k")
    setting("spark.sql.files.maxPartitionBytes", "100k")
    largest = []
    for n in (1_000, 20_000, 80_000):
        spark.range(0, n, 1, 4).selectExpr("id as k", "uuid() as v").write.parquet(str(tmp_path / f"from{n}"))
        t = target(f"t{n}", layout=layout, write_partitions=2)
        t.replace(spark.read.parquet(str(tmp_path / f"from{n}")))
        sizes = [r["count"] for r in t.read().groupBy(F.input_file_name()).count().collect()]
        assert sum(sizes) == n and t.read().select("k").distinct().count() == n
        assert len(sizes) == 2 or n > 1_000
        largest.append(max(sizes))
    assert largest[2] < 1.5 * largest[1] < 20_000
