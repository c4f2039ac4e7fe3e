from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tablesync.errors import ConfigError
from tablesync.functions.audit import resolve_columns, row_id, with_audit_columns, with_column_case

NOON = datetime(2024, 2, 1, 12)


def test_time_is_last_and_the_id_after_it(spark):
    df = with_audit_columns(spark.createDataFrame([(1, "a")], "k int, v string"), NOON, ["k"])
    assert df.columns == ["k", "v", "_ingested_at", "_row_id"]
    assert [f.dataType.simpleString() for f in df.schema][2:] == ["timestamp", "bigint"]


def test_no_id_without_dedup_columns(spark):
    assert with_audit_columns(spark.range(1), NOON).columns == ["id", "_ingested_at"]


def test_existing_audit_columns_are_replaced_in_any_case(spark):
    df = spark.createDataFrame([(1, "old")], "k int, _INGESTED_AT string")
    assert with_audit_columns(df, NOON).columns == ["k", "_ingested_at"]


@pytest.mark.parametrize("moment", [NOON, datetime(2024, 2, 1, 3, tzinfo=timezone.utc)])
def test_naive_time_is_session_time_and_aware_time_an_instant(spark, setting, moment):
    setting("spark.sql.session.timeZone", "Asia/Tokyo")
    row = with_audit_columns(spark.range(1), moment).select(F.col("_ingested_at").cast("string")).first()
    assert row[0] == "2024-02-01 12:00:00"


def test_null_hashes_like_the_empty_string_but_keeps_its_place(spark):
    df = spark.createDataFrame([("a", None), ("a", ""), (None, "a")], "x string, y string")
    first, second, third = [r[0] for r in df.select(row_id(["x", "y"])).collect()]
    assert first == second != third


def test_id_depends_on_column_order(spark):
    df = spark.createDataFrame([("a", "b")], "x string, y string")
    assert df.select(row_id(["x", "y"])).first() != df.select(row_id(["y", "x"])).first()


def test_id_is_the_public_hash_of_the_text_forms(spark):
    df = spark.createDataFrame([(7, 2.5)], "k int, v double")
    expected = df.select(F.xxhash64(F.lit("7"), F.lit("2.5"))).first()[0]
    assert with_audit_columns(df, NOON, ["k", "v"]).first()["_row_id"] == expected


@pytest.mark.parametrize("case, expected", [("lower", ["ab", "cd"]), ("upper", ["AB", "CD"]), ("as_is", ["aB", "Cd"])])
def test_column_case(spark, case, expected):
    assert with_column_case(spark.createDataFrame([(1, 2)], "aB int, Cd int"), case).columns == expected


def test_clashing_names_are_refused(spark):
    df = spark.createDataFrame([(1, 2)], ["a", "A"])
    with pytest.raises(ConfigError, match="clash"):
        with_column_case(df, "lower")


def test_unknown_case_is_refused(spark):
    with pytest.raises(ConfigError):
        with_column_case(spark.range(1), "title")


def test_resolve_columns():
    assert resolve_columns(["ID", "b"], ["id", "b", "B"]) == ["id", "b"]
    with pytest.raises(ConfigError, match="ambiguous"):
        resolve_columns(["Ab"], ["ab", "AB"])
    with pytest.raises(ConfigError, match="does not exist"):
        resolve_columns(["z"], ["a"])
