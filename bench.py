"""Headline timings. Prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py
"""

from __future__ import annotations

import json
import os
import shutil
import statistics
import sys
import tempfile
import time
import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from tablesync import (
    Database, FileTarget, Files, Layout, Project, SyncJob, TableSpec, ingest_available, run,
)
from tablesync.operators import key_violations, latest_per_key
from tablesync.queries.databases import stored_orders
from tablesync.sources import frame_slice

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
ROUNDS = int(os.environ.get("BENCH_ROUNDS", "3"))
NOW = datetime(2024, 2, 1)
LINE_KEY = ["l_orderkey", "l_linenumber"]


def consume(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


class Bench:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def path(self) -> str:
        return f"{self.folder}/{uuid.uuid4().hex}"

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{SF_DIR}/{name}.parquet")

    # Each returns what is timed; what comes before the return is not.

    def full_scan_replace(self):
        return lambda: FileTarget(self.spark, self.path()).replace(self.table("lineitem"))

    def incremental_window(self):
        spec = TableSpec("l", "l", "incremental", "l_shipdate", "datetime")
        return lambda: consume(frame_slice(self.table("lineitem"), spec, "2000-01-01").df)

    def incremental_multi_or(self):
        orders = self.table("orders").withColumn(
            "updated", F.expr("o_orderdate + make_dt_interval(cast(o_orderkey % 90 as int))")
        )
        spec = TableSpec("o", "o", "incremental", ["o_orderdate", "updated"], "datetime")
        return lambda: consume(frame_slice(orders, spec, "2000-01-01").df)

    def _upsert(self, since: str, layout: Layout | None = None, columns: tuple[str, ...] = ()):
        target = FileTarget(self.spark, self.path(), layout=layout)
        target.replace(self.table("orders"))
        batch = self.table("orders").where(f"o_orderdate >= TIMESTAMP_NTZ '{since}'")
        batch = batch.withColumn("o_orderstatus", F.lit("X"))
        if columns:
            batch = batch.select(*columns)
        return lambda: target.upsert(batch, ["o_orderkey"])

    def upsert_1_percent(self):
        return self._upsert("2001-07-08")

    def upsert_20_percent(self):
        return self._upsert("2000-04-07")

    def upsert_20_percent_buckets(self):
        return self._upsert("2000-04-07", Layout(key_buckets=8, key=("o_orderkey",)))

    def upsert_1_percent_moving_partitions(self):
        return self._upsert("2001-07-08", Layout(partition_by=("o_orderstatus",)))

    def merge_20_percent_one_column(self):
        return self._upsert("2000-04-07", columns=("o_orderkey", "o_orderstatus"))

    def dedup_row_number(self):
        return lambda: consume(latest_per_key(self.table("lineitem"), LINE_KEY, "l_shipdate"))

    def dedup_max_by(self):
        """The other way to write it, for comparison only."""
        def grouped():
            df = self.table("lineitem")
            rest = F.struct(*[c for c in df.columns if c not in LINE_KEY])
            consume(df.groupBy(*LINE_KEY).agg(F.max_by(rest, "l_shipdate").alias("r")).select(*LINE_KEY, "r.*"))
        return grouped

    def key_violations(self):
        return lambda: consume(key_violations(self.table("lineitem"), LINE_KEY))

    def layout_clustered(self):
        layout = Layout(cluster_by=("l_returnflag",), sort_by=("l_shipdate",))
        return lambda: FileTarget(self.spark, self.path(), layout=layout).replace(self.table("lineitem"))

    def _jdbc_read(self, partitions: int):
        stored = self._stored = getattr(self, "_stored", None) or stored_orders(self.spark, SF_DIR)
        spec = TableSpec(stored.table, "o", partitions_column='"o_orderkey"', partitions_count=partitions)
        return lambda: consume(Database(stored.connection).extract(self.spark, spec).df)

    def jdbc_read_1(self):
        return self._jdbc_read(1)

    def jdbc_read_4(self):
        return self._jdbc_read(4)

    def jdbc_read_10(self):
        return self._jdbc_read(10)

    def sync_initial_then_incremental(self):
        spec = TableSpec("orders.parquet", "orders", "incremental", "o_orderdate", "datetime",
                         write_strategy="upsert", write_key=["o_orderkey"], dedup_columns=["o_orderkey"])
        folder = self.path()
        project = Project(f"{folder}/log", {"a": Files(SF_DIR), "b": Files(f"{folder}/out")},
                          [SyncJob("j", "a", "b", [spec])])

        def twice():
            run(project, self.spark, moment=NOW)
            run(project, self.spark, moment=NOW)
        return twice

    def stream_latest(self):
        def ingest():
            events = self.table("events")
            ingest_available(
                self.spark, SF_DIR, events.schema, FileTarget(self.spark, self.path()), self.path(),
                key=["user_id"], order="ts", options={"pathGlobFilter": "events.parquet"},
            )
        return ingest


QUERIES = [name for name in vars(Bench) if not name.startswith("_") and name not in ("path", "table")]


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]").appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS).config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    folder = tempfile.mkdtemp(prefix="bench-")
    try:
        bench, timings = Bench(spark, folder), {}
        for name in sys.argv[1:] or QUERIES:
            seconds = []
            for attempt in range(ROUNDS + 1):  # the first warms up
                timed = getattr(bench, name)()
                start = time.perf_counter()
                timed()
                if attempt:
                    seconds.append(time.perf_counter() - start)
            timings[name] = round(statistics.median(seconds), 3)
    finally:
        spark.stop()
        shutil.rmtree(folder, ignore_errors=True)
    print(json.dumps({
        "metric": "total of median seconds per query", "value": round(sum(timings.values()), 3),
        "unit": "sec", "queries": timings, "sf": SF_DIR.rsplit("sf", 1)[-1], "cpus": int(CPUS),
    }))


if __name__ == "__main__":
    main()
