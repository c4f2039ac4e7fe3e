"""Evolution of nested columns."""

import pytest
from pyspark.sql import types as T

from tablesync.errors import LoadError
from tablesync.functions.schema import merged_type
from tablesync.targets import FileLogTarget, FileTarget


@pytest.mark.parametrize("old, new, both", [
    ("struct<a:int>", "struct<b:string,A:bigint>", "struct<a:bigint,b:string>"),
    ("struct<a:bigint,b:string>", "struct<a:int>", "struct<a:bigint,b:string>"),
    ("array<struct<a:int>>", "array<struct<a:int,c:array<float>>>", "array<struct<a:int,c:array<float>>>"),
    ("map<string,struct<a:float>>", "map<string,struct<a:double,b:int>>", "map<string,struct<a:double,b:int>>"),
    ("array<int>", "array<bigint>", "array<bigint>"),
    ("struct<a:struct<x:int>>", "struct<a:struct<y:int>>", "struct<a:struct<x:int,y:int>>"),
    ("struct<a:int>", "struct<a:string>", None), ("struct<a:bigint>", "struct<a:double>", None),
    ("array<int>", "struct<a:int>", None), ("map<string,int>", "map<int,int>", None),
])
def test_merged_types(spark, old, new, both):
    kinds = [k and T.StructType.fromDDL(f"v {k}")["v"].dataType for k in (old, new, both)]
    assert merged_type(*kinds[:2]) == kinds[2]


@pytest.mark.parametrize("kind", ["parquet", "orc", "json", "log"])
def test_old_and_new_files_are_read_by_name(spark, tmp_path, kind):
    target = FileLogTarget(spark, str(tmp_path / "t"), key=["k"]) if kind == "log" else FileTarget(spark, str(tmp_path / "t"), format=kind)
    target.append(spark.createDataFrame([(1, (5,), [(1, "x")], {"m": (1.5,)}), (2, None, None, None), (3, (None,), [], {})],
                                        "k long, s struct<a:int>, l array<struct<p:int,q:string>>, m map<string,struct<v:float>>"))
    target.append(spark.createDataFrame([(4, ("b", 2**40), [("r", "y", 7), None], {"n": (2, 0.25)}), (5, None, None, None)],
                                        "k long, S struct<b:string,A:bigint>, l array<struct<r:string,q:string,p:int>>, m map<string,struct<w:int,v:double>>"))
    rows = {r.k: r for r in target.read().collect()}
    assert rows[1].s.asDict() == {"a": 5, "b": None} and rows[4].s.asDict() == {"a": 2**40, "b": "b"}
    assert [x and x.asDict() for x in rows[1].l] == [{"p": 1, "q": "x", "r": None}] and [x and x.asDict() for x in rows[4].l] == [{"p": 7, "q": "y", "r": "r"}, None]
    assert rows[1].m["m"].asDict() == {"v": 1.5, "w": None} and rows[4].m["n"].asDict() == {"v": 0.25, "w": 2}
    assert all(rows[k].s is None and rows[k].l is None and rows[k].m is None for k in (2, 5)) and rows[3].s.asDict() == {"a": None, "b": None}
    target.upsert(spark.createDataFrame([(1, (9,))], "k long, s struct<a:int>"), ["k"])  # fewer fields, fewer columns
    rows = {r.k: r for r in target.read().collect()}
    assert rows[1].s.asDict() == {"a": 9, "b": None} and len(rows[1].l) == 1 and len(rows) == 5
    with pytest.raises(LoadError):
        target.append(spark.createDataFrame([(6, ("x",))], "k long, s struct<a:string>"))
