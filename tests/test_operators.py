import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from tablesync.operators import fresh_rows, key_violations, latest_per_key, merge_columns, upsert_rows
from tablesync.operators.merge import memory_bytes

quiet = settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
key = st.one_of(st.none(), st.integers(0, 5))


def unique(pairs):
    seen, kept = set(), []
    for k, v in pairs:
        if k is None or k not in seen:
            seen.add(k)
            kept.append((k, v))
    return kept


tables = st.lists(st.tuples(key, st.integers(0, 9)), max_size=8).map(unique)


def collected(df):
    return sorted(map(tuple, df.collect()), key=repr)


@quiet
@given(old=tables, new=tables, small=st.booleans())
def test_upsert_agrees_with_a_plain_loop(spark, old, new, small):
    keys = {k for k, _ in new if k is not None}
    expected = [row for row in old if row[0] not in keys] + new
    result = upsert_rows(
        spark.createDataFrame(old, "k int, v int"), spark.createDataFrame(new, "k int, v int"), ["k"], small
    )
    assert collected(result) == sorted(expected, key=repr)


@quiet
@given(old=tables, new=tables, small=st.booleans())
def test_partial_merge_agrees_with_a_plain_loop(spark, old, new, small):
    target = [(k, v, v + 100) for k, v in old]
    fresh = {k: v for k, v in new if k is not None}
    known = {k for k, _ in old if k is not None}
    expected = [(k, fresh.get(k, v) if k is not None else v, w) for k, v, w in target]
    expected += [(k, v, None) for k, v in new if k is None or k not in known]
    result = merge_columns(
        spark.createDataFrame(target, "k int, v int, w int"),
        spark.createDataFrame(new, "k int, v int"), ["k"], small,
    )
    assert collected(result) == sorted(expected, key=repr)


@pytest.mark.parametrize("small", [True, False])
def test_merge_takes_null_from_the_batch(spark, small):
    target = spark.createDataFrame([(1, "a", "b")], "k int, v string, w string")
    batch = spark.createDataFrame([(1, None)], "k int, v string")
    assert collected(merge_columns(target, batch, ["k"], small)) == [(1, None, "b")]


@pytest.mark.parametrize("small", [True, False])
def test_merge_of_key_columns_only_inserts_if_absent(spark, small):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    batch = spark.createDataFrame([(1,), (2,)], "k int")
    assert collected(merge_columns(target, batch, ["k"], small)) == [(1, "a"), (2, None)]


def test_partly_null_keys_never_match(spark):
    schema = "a int, b int, v string"
    target = spark.createDataFrame([(1, None, "old"), (1, 2, "old")], schema)
    batch = spark.createDataFrame([(1, None, "new"), (1, 2, "new")], schema)
    assert collected(upsert_rows(target, batch, ["a", "b"], True)) == [(1, 2, "new"), (1, None, "new"), (1, None, "old")]


@quiet
@given(data=st.lists(st.tuples(key, st.one_of(st.none(), st.integers(0, 3)), st.integers(0, 9)), max_size=10))
def test_latest_agrees_with_a_plain_loop(spark, data):
    df = spark.createDataFrame(data, "k int, t int, v int")
    result = [tuple(r) for r in latest_per_key(df, ["k"], "t").collect()]
    assert sorted(map(repr, {k for k, _, _ in data})) == sorted(repr(k) for k, _, _ in result)
    for k, t, v in result:
        assert (k, t, v) in data
        times = [u for j, u, _ in data if j == k and u is not None]
        assert t == (max(times) if times else None)


def test_latest_is_the_same_for_any_row_order(spark):
    data = [(1, 5, v) for v in range(20)]
    picks = {
        tuple(latest_per_key(spark.createDataFrame(rows, "k int, t int, v int").repartition(n), ["k"], "t").first())
        for n, rows in ((1, data), (3, data[::-1]), (4, data[7:] + data[:7]))
    }
    assert len(picks) == 1


def test_latest_with_columns_that_have_no_hash(spark):
    df = spark.sql("SELECT 1 AS k, 1 AS t, map('a', 1) AS m UNION ALL SELECT 1, 2, map('b', 2)")
    assert latest_per_key(df, ["k"], "t").first()["m"] == {"b": 2}


def test_latest_may_keep_every_null_key(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (3, 1), (3, 2)], "k int, t int")
    assert collected(latest_per_key(df, ["k"], "t", null_keys_match=False)) == [(3, 2), (None, 1), (None, 2)]


def test_violations_ignore_null_keys(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), (2, 1), (2, 1), (2, 2), (3, 1)], "k int, j int")
    assert collected(key_violations(df, ["k", "j"])) == [(2, 1, 2)]
    assert collected(key_violations(df, ["K"])) == [(2, 3)]


@pytest.mark.parametrize("small", [True, False])
def test_fresh_rows_drop_what_is_older_than_the_target(spark, small):
    target = spark.createDataFrame([(1, 5), (2, 5), (4, None)], "k int, t int")
    batch = spark.createDataFrame([(1, 4), (2, 5), (3, 1), (4, 0), (None, 0)], "k int, t int")
    assert collected(fresh_rows(target, batch, ["k"], "t", small)) == [(2, 5), (3, 1), (4, 0), (None, 0)]


def test_memory_is_measured_from_values(spark):
    df = spark.sql("SELECT 1 AS k, 'abcd' AS v, array(1) AS a UNION ALL SELECT 2, NULL, NULL")
    sizes = df.select(*[
        memory_bytes(df.schema, columns).alias(str(i)) for i, columns in enumerate((["k"], ["k", "v"], ["k", "a"]))
    ]).collect()
    assert [tuple(r) for r in sizes] == [(32, 52, None), (32, 48, None)]
