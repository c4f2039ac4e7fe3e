"""Writes to file tables; every query returns the table as read back.

The scenario is one of replication: a first run loads the orders known before a
date, a second run brings everything from an earlier date on, so that part of
it is known already (updates) and part is new (inserts).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tablesync.connections import Files
from tablesync.functions.audit import with_audit_columns
from tablesync.operators.dedup import latest_per_key
from tablesync.plans.sync import load_slice
from tablesync.queries.registry import query, table
from tablesync.queries.rows import LOADED_AT
from tablesync.session import new_path
from tablesync.spec import Slice, TableSpec
from tablesync.targets import FileTarget, Layout

BEFORE, SINCE = "TIMESTAMP_NTZ '2000-07-01'", "TIMESTAMP_NTZ '2000-01-01'"
BEFORE_SQL, SINCE_SQL = "TIMESTAMP '2000-07-01'", "TIMESTAMP '2000-01-01'"


def fresh(spark: SparkSession, label: str, **options) -> FileTarget:
    return FileTarget(spark, new_path(spark, label), **options)


def first_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").where(f"o_orderdate < {BEFORE}")


def second_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    changed = table(spark, sf_dir, "orders").where(f"o_orderdate >= {SINCE}")
    return changed.withColumn("o_orderstatus", F.lit("X"))


UPSERTED = f"select * replace (case when o_orderdate >= {SINCE_SQL} then 'X' else o_orderstatus end as o_orderstatus) from orders"


@query(
    "write_append",
    f"select * from orders where o_orderdate < {BEFORE_SQL} union all "
    f"select * replace ('X' as o_orderstatus) from orders where o_orderdate >= {SINCE_SQL}",
)
def write_append(spark, sf_dir):
    target = fresh(spark, "append")
    target.append(first_run(spark, sf_dir))
    target.append(second_run(spark, sf_dir))
    return target.read()


@query("append_then_dedup", UPSERTED)
def append_then_dedup(spark, sf_dir):
    """At-least-once loading made exact: append twice, keep the latest per id."""
    target = fresh(spark, "appended")
    for run, rows in enumerate((first_run(spark, sf_dir), second_run(spark, sf_dir))):
        target.append(with_audit_columns(rows, LOADED_AT.replace(day=1 + run), ["o_orderkey"]))
    return latest_per_key(target.read(), ["_row_id"], "_ingested_at").drop("_row_id", "_ingested_at")


@query("write_replace", "select *, o_totalprice * 2 as doubled from orders")
def write_replace(spark, sf_dir):
    """The table takes the schema of the new rows, which are computed from its old ones."""
    target = fresh(spark, "replace")
    target.replace(table(spark, sf_dir, "orders"))
    target.replace(target.read().withColumn("doubled", F.col("o_totalprice") * 2))
    return target.read()


@query(
    "write_truncate_insert",
    "select o_orderkey, o_custkey, cast(null as varchar) as o_orderstatus, o_totalprice, o_orderdate, o_orderpriority from orders",
)
def write_truncate_insert(spark, sf_dir):
    """Columns come in another order and one is missing; the table's schema stays."""
    target = fresh(spark, "truncate")
    spec = TableSpec("orders", "orders", if_exists="append")
    orders = table(spark, sf_dir, "orders")
    load_slice(target, Slice(orders, "overwrite"), spec, moment=LOADED_AT)
    rows = orders.select("o_orderpriority", "o_orderdate", "o_totalprice", "o_custkey", "o_orderkey")
    load_slice(target, Slice(rows, "overwrite"), spec, moment=LOADED_AT)
    return target.read().drop("_ingested_at")


def upserted(spark, sf_dir, target: FileTarget) -> DataFrame:
    target.upsert(first_run(spark, sf_dir), ["o_orderkey"])
    target.upsert(second_run(spark, sf_dir), ["o_orderkey"])
    return target.read()


@query("upsert_single_key", UPSERTED)
def upsert_single_key(spark, sf_dir):
    return upserted(spark, sf_dir, fresh(spark, "upsert"))


@query("upsert_key_buckets", UPSERTED)
def upsert_key_buckets(spark, sf_dir):
    """Spread by key hash: only buckets with a key of the batch are rewritten."""
    layout = Layout(key_buckets=16, key=("o_orderkey",))
    return upserted(spark, sf_dir, fresh(spark, "buckets", layout=layout))


@query("upsert_partitioned", UPSERTED)
def upsert_partitioned(spark, sf_dir):
    """The batch moves rows to another partition: their old place is found and rewritten."""
    layout = Layout(partition_by=("o_orderstatus",))
    return upserted(spark, sf_dir, fresh(spark, "partitions", layout=layout))


@query(
    "upsert_multi_key",
    "select * from conversations c where not exists "
    "(select 1 from conversations p where p.conv_id = c.conv_id and p.turn + 1 = c.turn) "
    "union all select conv_id, turn + 1, 'X', text from conversations",
)
def upsert_multi_key(spark, sf_dir):
    """Every turn comes again as the next one: most exist, the last is new."""
    target = fresh(spark, "conversations")
    turns = table(spark, sf_dir, "conversations")
    target.upsert(turns, ["conv_id", "turn"])
    shifted = turns.withColumns({"turn": F.col("turn") + 1, "role": F.lit("X")})
    target.upsert(shifted, ["conv_id", "turn"])
    return target.read()


@query(
    "upsert_latest_in_batch",
    "select user_id, arg_max(event_type, ts) as event_type, max(ts) as ts from events group by user_id",
)
def upsert_latest_in_batch(spark, sf_dir):
    """A batch with many rows per key: the latest one counts."""
    target = fresh(spark, "latest")
    events = table(spark, sf_dir, "events").select("user_id", "event_type", "ts")
    target.upsert(events.select("user_id", F.lit("new").alias("event_type"), "ts"), ["user_id"],
                  duplicates="latest", order="ts")
    target.upsert(events, ["user_id"], duplicates="latest", order="ts")
    return target.read()


@query("upsert_create", "select * from part")
def upsert_create(spark, sf_dir):
    target = fresh(spark, "create")
    target.upsert(table(spark, sf_dir, "part"), ["p_partkey"])
    return target.read()


NULL_KEYED = "(select * replace (case when o_orderstatus <> 'F' then o_orderkey end as o_orderkey) from orders)"


@query(
    "upsert_null_keys",
    f"select * from {NULL_KEYED} where o_orderkey is null union all "
    f"select * replace ('X' as o_orderpriority) from {NULL_KEYED}",
)
def upsert_null_keys(spark, sf_dir):
    """A third of all keys is NULL on both sides: those rows never match and all stay."""
    target = fresh(spark, "nullkeys")
    orders = table(spark, sf_dir, "orders")
    rows = orders.withColumn("o_orderkey", F.when(F.col("o_orderstatus") != "F", F.col("o_orderkey")))
    target.upsert(rows, ["o_orderkey"])
    target.upsert(rows.withColumn("o_orderpriority", F.lit("X")), ["o_orderkey"])
    return target.read()


@query(
    "merge_partial_columns",
    f"select * replace (case when o_orderdate >= {SINCE_SQL} then 'X' else o_orderstatus end as o_orderstatus, "
    f"case when o_orderdate < {BEFORE_SQL} then o_custkey end as o_custkey, "
    f"case when o_orderdate < {BEFORE_SQL} then o_totalprice end as o_totalprice, "
    f"case when o_orderdate < {BEFORE_SQL} then o_orderdate end as o_orderdate, "
    f"case when o_orderdate < {BEFORE_SQL} then o_orderpriority end as o_orderpriority) from orders",
)
def merge_partial_columns(spark, sf_dir):
    """Known rows get the new status and keep the rest; new rows have only key and status."""
    target = fresh(spark, "merge")
    target.merge(first_run(spark, sf_dir), ["o_orderkey"])
    target.merge(second_run(spark, sf_dir).select("o_orderkey", "o_orderstatus"), ["o_orderkey"])
    return target.read()


@query("layout_partitioned", UPSERTED)
def layout_partitioned(spark, sf_dir):
    """Partitioned by order year; the second run touches two years only."""
    layout = Layout(partition_by=("o_year",), sort_by=("o_orderkey",))
    target = fresh(spark, "years", layout=layout)
    for rows in (first_run(spark, sf_dir), second_run(spark, sf_dir)):
        target.upsert(rows.withColumn("o_year", F.year("o_orderdate")), ["o_year", "o_orderkey"])
    return target.read().drop("o_year")


@query("layout_clustered", "select * from lineitem")
def layout_clustered(spark, sf_dir):
    """Range-clustered on a flag with three values: more tasks than values."""
    layout = Layout(cluster_by=("l_returnflag",), sort_by=("l_shipdate",))
    target = fresh(spark, "clustered", layout=layout)
    target.replace(table(spark, sf_dir, "lineitem"))
    return target.read()


@query("write_partitions", "select * from lineitem")
def write_partitions(spark, sf_dir):
    target = fresh(spark, "narrow", write_partitions=2)
    target.replace(table(spark, sf_dir, "lineitem"))
    return target.read()


@query(
    "schema_evolution_merge",
    f"select o_orderkey, o_orderdate, null as o_orderpriority from orders where o_orderdate < {BEFORE_SQL} union all "
    f"select o_orderkey, null, o_orderpriority from orders where o_orderdate >= {SINCE_SQL}",
)
def schema_evolution_merge(spark, sf_dir):
    target = fresh(spark, "evolving")
    target.append(first_run(spark, sf_dir).select("o_orderkey", "o_orderdate"))
    target.append(second_run(spark, sf_dir).select("o_orderpriority", "o_orderkey"))
    return target.read()


def _written(spark, sf_dir, name: str, format: str) -> DataFrame:
    target = fresh(spark, f"sink-{format}", format=format)
    target.append(table(spark, sf_dir, name))
    return target.read()


def _scanned(spark, sf_dir, name: str, format: str, **options) -> DataFrame:
    rows = table(spark, sf_dir, name)
    path = new_path(spark, f"scan-{format}")
    rows.write.format(format).options(**options).save(f"{path}/{name}")
    schemas = {} if format in ("orc", "parquet") else {name: rows.schema}
    return Files(path, format, options, schemas).extract(spark, TableSpec(name, name)).df


@query("file_sink_parquet", "select * from pages")
def file_sink_parquet(spark, sf_dir):
    return _written(spark, sf_dir, "pages", "parquet")


@query("file_sink_orc", "select * from lineitem")
def file_sink_orc(spark, sf_dir):
    return _written(spark, sf_dir, "lineitem", "orc")


@query("file_sink_json", "select * from conversations")
def file_sink_json(spark, sf_dir):
    return _written(spark, sf_dir, "conversations", "json")


@query("file_sink_csv", "select * from documents")
def file_sink_csv(spark, sf_dir):
    return _written(spark, sf_dir, "documents", "csv")


@query("file_sink_xml", "select * from events")
def file_sink_xml(spark, sf_dir):
    return _written(spark, sf_dir, "events", "xml")


@query("file_scan_parquet", "select * from events")
def file_scan_parquet(spark, sf_dir):
    return _scanned(spark, sf_dir, "events", "parquet")


@query("file_scan_orc", "select * from events")
def file_scan_orc(spark, sf_dir):
    return _scanned(spark, sf_dir, "events", "orc")


@query("file_scan_json", "select * from orders")
def file_scan_json(spark, sf_dir):
    return _scanned(spark, sf_dir, "orders", "json")


@query("file_scan_csv", "select * from orders")
def file_scan_csv(spark, sf_dir):
    return _scanned(spark, sf_dir, "orders", "csv", header="true")


@query("file_scan_xml", "select * from orders")
def file_scan_xml(spark, sf_dir):
    return _scanned(spark, sf_dir, "orders", "xml", rowTag="order")
