"""Queries over several writes to one table: logs, types that widen, many appends, catalog tables."""

from __future__ import annotations

import os
import uuid
from datetime import datetime

from pyspark.sql import functions as F

from tablesync.connections import Files
from tablesync.functions.custom_sql import query_text
from tablesync.plans.runlog import RunLog
from tablesync.plans.sync import run
from tablesync.queries.registry import query, table
from tablesync.session import new_path
from tablesync.sources.frames import FrameSource, frame_slice, query_slice
from tablesync.spec import Project, SyncJob, TableSpec
from tablesync.streaming import ingest_available
from tablesync.targets import FileTarget, Layout
from tablesync.targets.tables import TableTarget


@query(
    "incremental_text_time",
    "select o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') as t, 'first' as run from orders union all "
    "select o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S'), 'second' from orders "
    "where o_orderdate >= (select max(o_orderdate) from orders)",
)
def incremental_text_time(spark, sf_dir):
    """Times kept as text: a first run takes all rows, a second those at the mark."""
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("t"))
    spec = TableSpec("orders", "orders", "incremental", "t", "datetime")
    first = frame_slice(rows, spec)
    second = frame_slice(rows, spec, first.high_water)
    return first.df.withColumn("run", F.lit("first")).unionByName(second.df.withColumn("run", F.lit("second")))


@query(
    "incremental_zoned",
    "with e as (select event_id, epoch_us(ts) as us from events) "
    "select event_id, us, 'first' as run from e union all select event_id, us, 'second' from e where us >= (select max(us) from e)",
)
def incremental_zoned(spark, sf_dir):
    """Moments: marks are UTC, whatever zone the session is in when they are read back."""
    events = table(spark, sf_dir, "events")
    micros = F.unix_micros(F.to_utc_timestamp(F.col("ts").cast("timestamp"), F.current_timezone()))
    rows = events.select("event_id", F.timestamp_micros(micros).alias("t"))
    spec = TableSpec("events", "events", "incremental", "t", "datetime")
    first = frame_slice(rows, spec)
    second = frame_slice(rows, spec, first.high_water)
    both = first.df.withColumn("run", F.lit("first")).unionByName(second.df.withColumn("run", F.lit("second")))
    return both.select("event_id", F.unix_micros("t").alias("us"), "run")


@query(
    "run_log_history",
    "select 'p' as pipeline, n_name as table_name, status, case when status = 'failed' then 'no ' || n_name else '' end as error_message "
    "from nation, (values ('extracting'), ('loading'), ('failed'), ('completed')) s(status)",
)
def run_log_history(spark, sf_dir):
    """Every event of every table is still there after the log was packed, twice."""
    log = RunLog(spark, new_path(spark, "run-log"))
    names = [r["n_name"] for r in table(spark, sf_dir, "nation").select("n_name").collect()]  # tables to sync
    for status in ("extracting", "loading", "failed", "completed"):
        for name in names:
            log.record("p", name, status, error=f"no {name}" if status == "failed" else "")
        log.compact(over=len(names) + 3)
    return log.events().select("pipeline", "table_name", "status", "error_message")


@query(
    "schema_evolution_widen",
    "select l_orderkey, l_linenumber::bigint as n, l_quantity::double as q from lineitem "
    "union all select o_orderkey, o_orderkey + 5000000000, o_totalprice from orders",
)
def schema_evolution_widen(spark, sf_dir):
    """int then bigint, float then double: old and new values are what they were."""
    target = FileTarget(spark, new_path(spark, "widen"))
    items, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    narrow = items.select(F.col("l_orderkey").cast("bigint"), F.col("l_linenumber").cast("int").alias("n"), F.col("l_quantity").cast("float").alias("q"))
    wide = orders.select(F.col("o_orderkey").cast("bigint").alias("l_orderkey"), (F.col("o_orderkey") + 5_000_000_000).alias("n"), F.col("o_totalprice").cast("double").alias("q"))
    target.append(narrow)
    target.append(wide)
    return target.read()


@query(
    "schema_evolution_nested",
    """
select o_orderkey as k, o_custkey::bigint as customer, null as status, o_totalprice::double as price, null as note from orders
union all select -o_orderkey - 1, o_custkey + 5000000000, o_orderstatus, o_totalprice::double, 'n' || o_orderkey from orders where o_orderkey % 3 = 0""",
)
def schema_evolution_nested(spark, sf_dir):
    """A struct gains a field and a wider one, an array of structs a field: old files are read by name."""
    orders = table(spark, sf_dir, "orders")
    target = FileTarget(spark, new_path(spark, "nested"))
    price = F.col("o_totalprice").cast("double").alias("price")
    target.append(orders.select(F.col("o_orderkey").cast("bigint").alias("k"), F.struct(F.col("o_custkey").cast("int").alias("customer")).alias("who"), F.array(F.struct(price)).alias("items")))
    wide = F.struct(F.col("o_orderstatus").alias("status"), (F.col("o_custkey") + 5_000_000_000).cast("bigint").alias("CUSTOMER"))
    items = F.array(F.struct(F.concat(F.lit("n"), F.col("o_orderkey").cast("string")).alias("note"), price))
    target.append(orders.where("o_orderkey % 3 = 0").select((-F.col("o_orderkey") - 1).cast("bigint").alias("k"), items.alias("items"), wide.alias("who")))
    return target.read().select("k", "who.customer", "who.status", F.col("items")[0]["price"].alias("price"), F.col("items")[0]["note"].alias("note"))


@query(
    "stream_into_appended",
    "with latest as (select user_id, max(ts) as ts from events group by user_id) "
    "select distinct e.user_id, e.ts from events e join latest using (user_id, ts)",
)
def stream_into_appended(spark, sf_dir):
    """A stream by key into a table that was appended to, and so holds its keys many times.

    The events come again, so each user's newest one replaces all that was held of the user."""
    events = table(spark, sf_dir, "events")
    target = FileTarget(spark, new_path(spark, "appended"))
    target.append(events)
    incoming = new_path(spark, "incoming")
    events.write.parquet(incoming)
    ingest_available(spark, incoming, events.schema, target, new_path(spark, "checkpoint"), key=["user_id"], order="ts")
    return target.read().select("user_id", "ts")


@query(
    "upsert_many_appends",
    "select o_orderkey, case when o_orderkey % 10 = 0 then -1 else o_totalprice end as o_totalprice from orders",
)
def upsert_many_appends(spark, sf_dir):
    """Two dozen appends, then an upsert of a tenth of the keys."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_totalprice").cast("double"))
    target = FileTarget(spark, new_path(spark, "appends"), layout=Layout(key_buckets=4, key=("o_orderkey",)))
    for part in range(24):
        target.append(orders.where(F.pmod("o_orderkey", F.lit(24)) == part))
    changed = orders.where("o_orderkey % 10 = 0").withColumn("o_totalprice", F.lit(-1.0))
    target.upsert(changed, ["o_orderkey"])
    return target.read()


def _catalog_target(spark, **options):
    return TableTarget(spark, f"tablesync_{uuid.uuid4().hex}", schema_evolution="merge", **options)


@query(
    "catalog_append",
    "select o_orderkey, o_orderstatus, null as note from orders union all select o_orderkey, 'X', 'again' from orders where o_orderkey < 1000",
)
def catalog_append(spark, sf_dir):
    """A catalog table grows by rows and by a column."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    target = _catalog_target(spark)
    target.append(orders)
    target.append(orders.where("o_orderkey < 1000").select(F.lit("again").alias("note"), F.lit("X").alias("O_ORDERSTATUS"), "o_orderkey"))
    return target.read()


@query("catalog_truncate_insert", "select o_orderkey, o_orderstatus from orders where o_orderstatus = 'F'")
def catalog_truncate_insert(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    target = _catalog_target(spark, partition_by=["o_orderstatus"])
    target.append(orders)
    target.truncate_insert(orders.where("o_orderstatus = 'F'").select("o_orderstatus", "o_orderkey"))
    return target.read().select("o_orderkey", "o_orderstatus")


@query("custom_query_from_file", "select o_orderkey, o_totalprice * 2 as twice from orders where o_orderkey >= 500")
def custom_query_from_file(spark, sf_dir):
    """SQL kept in a file beside the project, with a place for the window."""
    table(spark, sf_dir, "orders").createOrReplaceTempView("orders_for_file_query")
    spec = TableSpec("orders", "orders", "incremental", "o_orderkey", "int", custom_query_file="twice.sql")
    return query_slice(spark, spec, query_text(spec, os.path.dirname(__file__)), "500").df


@query(
    "in_progress_gate",
    "select r_name as table_name, case when r_name = 'ASIA' then 'skipped' else 'completed' end as status from region",
)
def in_progress_gate(spark, sf_dir):
    """One table of five is still being loaded by another run: it is skipped, the others run."""
    region = table(spark, sf_dir, "region")
    names = [r["r_name"] for r in region.select("r_name").collect()]
    frames = {name: region.where(F.col("r_name") == name) for name in names}
    folder = new_path(spark, "gate")
    project = Project(f"{folder}/log", {"in": FrameSource(frames), "out": Files(f"{folder}/out")}, [
        SyncJob("p", "in", "out", [TableSpec(name, name.replace(" ", "_")) for name in names])])
    RunLog(spark, project.run_log).record("p", "ASIA", "loading")
    status = {r.table: r.status for r in run(project, spark)}
    seen = F.create_map(*[F.lit(x) for name in names for x in (name, status[name.replace(" ", "_")])])
    return region.select(F.col("r_name").alias("table_name"), seen[F.col("r_name")].alias("status"))


@query(
    "run_log_stale",
    "select 'p' as pipeline, n_name as table_name, 'loading' as status from nation where n_nationkey % 2 = 0",
)
def run_log_stale(spark, sf_dir):
    """Runs left unfinished two days ago, and runs of today."""
    log = RunLog(spark, new_path(spark, "run-log"))
    now = datetime(2024, 3, 10, 12)
    for row in table(spark, sf_dir, "nation").select("n_name", "n_nationkey").collect():
        log.record("p", row["n_name"], "loading", now=datetime(2024, 3, 8) if row["n_nationkey"] % 2 == 0 else now)
    return log.stale_runs(now).select("pipeline", "table_name", "status")


_BY_USER = """
with e as (select user_id, event_id, ts, event_type, case when event_id % 3 = 0 then event_id::varchar end as point from events)
select 'p' as pipeline, user_id::varchar as table_name, arg_max(event_type, event_id) as status,
    arg_max(point, event_id) filter (point is not null) as last_point, max(event_id) as seq from e group by user_id"""


@query("run_state_by_user", _BY_USER)
def run_state_by_user(spark, sf_dir):
    """States of as many tables as there are users, kept while their events are packed in four batches out of order."""
    log = RunLog(spark, new_path(spark, "run-log"))
    point = F.when(F.col("event_id") % 3 == 0, F.col("event_id").cast("string"))
    events = table(spark, sf_dir, "events").select(
        F.lit("p").alias("pipeline"), F.col("user_id").cast("string").alias("table_name"), point.alias("last_point"),
        F.lit("int").alias("value_type"), F.lit("incremental").alias("replication_method"), F.col("event_type").alias("status"),
        F.lit("").alias("error_message"), F.col("ts").alias("updated_time"), F.col("event_id").alias("seq"))
    for batch in (2, 0, 3, 1):
        log.take_over(events.where(F.pmod(F.xxhash64("seq"), F.lit(4)) == batch))
    return log.latest().select("pipeline", "table_name", "status", "last_point", "seq")
