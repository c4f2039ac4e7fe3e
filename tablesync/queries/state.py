"""Run state, whole runs over several tables, and the file stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tablesync.connections import Files
from tablesync.plans.runlog import RunLog, latest_state, stale
from tablesync.plans.sync import extract, load, report, run
from tablesync.queries.registry import query, table
from tablesync.queries.rows import LOADED_AT
from tablesync.session import new_path
from tablesync.sources.frames import FrameSource
from tablesync.spec import Project, SyncJob, TableSpec
from tablesync.streaming.ingest import ingest_available
from tablesync.targets import FileTarget

MARK_SQL = "strftime({}, '%Y-%m-%d %H:%M:%S.%f')"


@query(
    "run_log_latest",
    "select user_id, arg_max(event_type, ts) as status, max(ts) as updated_time from events group by user_id",
)
def run_log_latest(spark, sf_dir):
    """The events table taken as a run log: the latest status per user."""
    log = table(spark, sf_dir, "events").select(
        "user_id", F.col("event_type").alias("status"), F.col("ts").alias("updated_time")
    )
    return latest_state(log, ["user_id"], "updated_time")


@query(
    "latest_checkpoint",
    "select user_id, arg_max(event_id, ts) filter (where event_type <> 'error') as last_point, "
    "max(ts) as updated_time from events group by user_id",
)
def latest_checkpoint(spark, sf_dir):
    """An event without a mark keeps the one before."""
    log = table(spark, sf_dir, "events").select(
        "user_id", F.when(F.col("event_type") != "error", F.col("event_id")).alias("last_point"),
        F.col("ts").alias("updated_time"),
    )
    return latest_state(log, ["user_id"], "updated_time", ["last_point"])


@query(
    "stale_runs",
    "select user_id, max(ts) as updated_time, "
    "TIMESTAMP '2024-01-31' - max(ts) > interval 1 day as stale from events group by user_id",
)
def stale_runs(spark, sf_dir):
    log = table(spark, sf_dir, "events").select("user_id", F.col("ts").alias("updated_time"))
    now = F.lit("2024-01-31").cast("timestamp_ntz")
    latest = latest_state(log, ["user_id"], "updated_time")
    return latest.select("*", stale("updated_time", now).alias("stale"))


def project(spark: SparkSession, source, *tables: TableSpec, **options) -> Project:
    folder = new_path(spark, "project")
    return Project(
        f"{folder}/run_log", {"from": source, "to": Files(f"{folder}/tables")},
        [SyncJob("daily", "from", "to", tables, **options)],
    )


def loaded(spark: SparkSession, plan: Project, name: str) -> DataFrame:
    return FileTarget(spark, f"{plan.connections['to'].path}/{name}").read()


ORDERS = TableSpec(
    "orders", "orders", "incremental", "o_orderdate", "datetime", write_strategy="upsert",
    write_key=["o_orderkey"],
)


@query(
    "sync_two_runs",
    "select * replace (case when o_orderdate >= (select max(o_orderdate) from orders "
    "where o_orderdate < TIMESTAMP '2000-07-01') then 'X' else o_orderstatus end as o_orderstatus) from orders",
)
def sync_two_runs(spark, sf_dir):
    """Initial load, then an incremental upsert from the mark the first run stored."""
    orders = table(spark, sf_dir, "orders")
    early = FrameSource({"orders": orders.where("o_orderdate < TIMESTAMP_NTZ '2000-07-01'")})
    plan = project(spark, early, ORDERS)
    run(plan, spark, moment=LOADED_AT)
    plan.connections["from"] = FrameSource({"orders": orders.withColumn("o_orderstatus", F.lit("X"))})
    run(plan, spark, moment=LOADED_AT)
    return loaded(spark, plan, "orders").drop("_ingested_at")


@query(
    "multi_table_sync",
    f"select 'orders' as table_name, count(*) as n, {MARK_SQL.format('max(o_orderdate)')} as last_point from orders "
    f"union all select 'events', count(*), {MARK_SQL.format('max(ts)')} from events "
    "union all select 'customer', count(*), null from customer",
)
def multi_table_sync(spark, sf_dir):
    plan = project(
        spark, Files(sf_dir),
        TableSpec("orders.parquet", "orders", "incremental", "o_orderdate", "datetime", tags=["daily"],
                  write_strategy="upsert", write_key=["o_orderkey"]),
        TableSpec("events.parquet", "events", "incremental", "ts", "datetime", tags=["daily", "log"]),
        TableSpec("customer.parquet", "customer", tags=["master", "daily"]),
    )
    run(plan, spark, tags=["log", "daily"], moment=LOADED_AT, parallelism=3)
    marks = RunLog(spark, plan.run_log).latest().where("status = 'completed'").select("table_name", "last_point")
    counts = [
        loaded(spark, plan, name).agg(F.lit(name).alias("table_name"), F.count("*").alias("n"))
        for name in ("orders", "events", "customer")
    ]
    return counts[0].union(counts[1]).union(counts[2]).join(marks, "table_name").select("table_name", "n", "last_point")


@query(
    "sync_report",
    f"select 'orders' as table_name, 'completed' as status, {MARK_SQL.format('max(o_orderdate)')} as last_point "
    "from orders union all select 'lineitem', case when count(*) > count(distinct (l_orderkey, l_linenumber)) "
    "then 'failed' else 'completed' end, null from lineitem "
    "union all select 'part', 'completed', null from (select 1 from part limit 1)",
)
def sync_report(spark, sf_dir):
    """One table fails, on keys that are not unique; the others go on."""
    plan = project(
        spark, Files(sf_dir),
        TableSpec("orders.parquet", "orders", "incremental", "o_orderdate", "datetime"),
        TableSpec("lineitem.parquet", "lineitem", write_strategy="upsert",
                  write_key=["l_orderkey", "l_linenumber"], pass_on_error=True),
        TableSpec("part.parquet", "part", write_strategy="merge", write_key=["p_partkey"]),
    )
    return report(spark, run(plan, spark, moment=LOADED_AT)).select("table_name", "status", "last_point")


@query("extract_only", "select * from events where ts >= TIMESTAMP '2024-01-15'")
def extract_only(spark, sf_dir):
    spec = TableSpec("events.parquet", "events", "incremental", "ts", "datetime")
    plan = project(spark, Files(sf_dir), spec)
    log = RunLog(spark, plan.run_log)
    log.record("daily", "events", "completed", method="incremental",
               last_point="2024-01-15 00:00:00.000000", value_type="datetime")
    return extract(plan, spark, "events").df


@query(
    "load_only",
    "select user_id as \"USER_ID\", count(*) as \"N\", TIMESTAMP '2024-02-01' as \"_INGESTED_AT\" "
    "from events group by user_id",
)
def load_only(spark, sf_dir):
    """The caller's own rows, written as the spec says."""
    plan = project(spark, Files(sf_dir), TableSpec("events.parquet", "per_user", column_name_case="upper"))
    rows = table(spark, sf_dir, "events").groupBy("user_id").agg(F.count("*").alias("n"))
    load(plan, spark, "per_user", rows, moment=LOADED_AT)
    return loaded(spark, plan, "per_user").withColumn("_INGESTED_AT", F.col("_INGESTED_AT").cast("timestamp_ntz"))


@query(
    "stream_incremental_latest",
    "select user_id, arg_max(event_type, ts) as status, max(ts) as ts from events group by user_id",
)
def stream_incremental_latest(spark, sf_dir):
    """The events file as a stream of files; a second call finds nothing new."""
    events = table(spark, sf_dir, "events")
    target = FileTarget(spark, new_path(spark, "stream"))
    checkpoint = new_path(spark, "checkpoint")
    for _ in range(2):
        ingest_available(
            spark, sf_dir, events.schema, target, checkpoint, key=["user_id"], order="ts",
            options={"pathGlobFilter": "events.parquet"},
            transform=lambda df: df.select("user_id", F.col("event_type").alias("status"), "ts"),
        )
    return target.read()
