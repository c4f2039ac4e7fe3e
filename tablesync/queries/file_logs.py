"""Tables kept as a log of files, balanced ranges, and how a write is resolved."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablesync.plans.ranges import balanced_ranges, range_number
from tablesync.plans.strategy import resolve_strategy
from tablesync.queries.registry import query, table
from tablesync.session import new_path
from tablesync.spec import Settings, TableSpec
from tablesync.targets import BucketedTarget, FileLogTarget


def _orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.col("o_totalprice").cast("double").alias("o_totalprice"))


_CHANGED = "o_orderkey % 101 = 0"
_UPSERTED = f"""
select o_orderkey, o_custkey, case when {_CHANGED} then -1 else o_totalprice::double end as o_totalprice from orders
union all select -o_orderkey - 1, o_custkey, -2 from orders where {_CHANGED}"""


def _upserted(spark, sf_dir, mode):
    """One key in a hundred changes, as many are new."""
    orders = _orders(spark, sf_dir)
    target = FileLogTarget(spark, new_path(spark, "file-log"), key=["o_orderkey"], upsert=mode)
    target.replace(orders.repartitionByRange(8, "o_orderkey"))
    changed = orders.where(_CHANGED)
    batch = changed.withColumn("o_totalprice", F.lit(-1.0)).unionByName(
        changed.withColumn("o_orderkey", -F.col("o_orderkey") - 1).withColumn("o_totalprice", F.lit(-2.0)))
    target.upsert(batch, ["o_orderkey"])
    return target


@query("upsert_by_file", _UPSERTED)
def upsert_by_file(spark, sf_dir):
    """Files that hold a key of the batch are written anew, the others stay."""
    return _upserted(spark, sf_dir, "rewrite").read()


@query("upsert_merge_on_read", f"select r.*, s.state from ({_UPSERTED}) r cross join (values ('marked'), ('packed')) s(state)")
def upsert_merge_on_read(spark, sf_dir):
    """Replaced rows are marked, and subtracted when read; packing folds the marks in."""
    target = _upserted(spark, sf_dir, "mark")
    marked = target.read().withColumn("state", F.lit("marked"))
    target.pack()
    return marked.unionByName(target.read().withColumn("state", F.lit("packed")))


@query("append_log_packed", "select event_id, user_id, event_type from events")
def append_log_packed(spark, sf_dir):
    """Two dozen small appends, checkpoints of the log on the way, then one packing."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    target = FileLogTarget(spark, new_path(spark, "append-log"), key=["event_id"])
    for part in range(24):
        target.append(events.where(F.pmod("event_id", F.lit(24)) == part).hint("rebalance"))
    target.pack()
    return target.read()


@query(
    "layout_z_order",
    "select l_orderkey, l_partkey, l_quantity from lineitem where l_orderkey between 1000 and 2500 and l_partkey between 200 and 700",
)
def layout_z_order(spark, sf_dir):
    """lineitem along the Z curve of order and part, and a range of both: files elsewhere are not opened."""
    target = FileLogTarget(spark, new_path(spark, "z-order"), key=["l_orderkey", "l_partkey"], z_order=32)
    target.replace(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity"))
    return target.read({"l_orderkey": (1000, 2500), "l_partkey": (200, 700)})


_SKEWED = "case when l_orderkey % 11 = 0 then null else l_orderkey * l_orderkey end"


@query(
    "balanced_ranges",
    f"with k as (select {_SKEWED} as k from lineitem) select count(*) as n, min(k) as low, max(k) as high, count(*) - count(k) as nulls, true as balanced from k",
)
def balanced_range_sizes(spark, sf_dir):
    """A key whose values thin out upwards, some of them NULL: every row in one range, sizes within 2x."""
    rows = table(spark, sf_dir, "lineitem").select(F.when(F.col("l_orderkey") % 11 == 0, None).otherwise(F.col("l_orderkey") * F.col("l_orderkey")).alias("k"))
    ranges = balanced_ranges(rows, F.col("k"), 16)
    sizes = rows.groupBy(range_number(ranges, F.col("k")).alias("part")).agg(
        F.count("*").alias("n"), F.count("k").alias("named"), F.min("k").alias("low"), F.max("k").alias("high"))
    keyed = F.when(F.col("named") > 0, F.col("n"))
    return sizes.agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"), F.sum(F.col("n") - F.col("named")).alias("nulls"),
                     (F.max(keyed) <= 2 * F.min(keyed)).alias("balanced"))


@query(
    "strategy_resolution",
    """
with o as (select o_orderkey, o_orderkey % 5 as strategy, o_orderkey // 5 % 2 as full_, o_orderkey // 10 % 3 as own, o_orderkey // 30 % 2 as common from orders)
select o_orderkey, case strategy when 0 then 'append' when 1 then 'replace' when 2 then 'upsert' when 3 then 'merge'
        else case when full_ = 1 then 'replace' else 'append' end end as strategy,
    case own when 0 then 'append' when 1 then 'replace' else case when common = 1 then 'append' else 'replace' end end as if_exists from o""",
)
def strategy_resolution(spark, sf_dir):
    """Every combination of given strategy, kind of slice, and table's or common choice, dealt to the orders."""
    cases = []
    for s, strategy in enumerate(["append", "replace", "upsert", "merge", None]):
        for full in (0, 1):
            for o, own in enumerate(["append", "replace", None]):
                for common in (0, 1):
                    spec = TableSpec("t", "t", write_strategy=strategy, write_key=["k"], if_exists=own)
                    spec = Settings(if_exists="append" if common else "replace").resolve(spec)
                    cases.append((s, full, o, common, resolve_strategy(spec, "overwrite" if full else "append"), spec.if_exists))
    known = spark.createDataFrame(cases, "s long, f long, o long, c long, strategy string, if_exists string")
    part = lambda over, of: F.floor(F.col("o_orderkey") / over).cast("long") % of
    orders = table(spark, sf_dir, "orders").select("o_orderkey", part(1, 5).alias("s"), part(5, 2).alias("f"), part(10, 3).alias("o"), part(30, 2).alias("c"))
    return orders.join(F.broadcast(known), ["s", "f", "o", "c"]).select("o_orderkey", "strategy", "if_exists")


@query(
    "upsert_co_bucketed",
    """select o_orderkey, o_custkey, case when o_orderkey % 2 = 0 then -1 else o_totalprice::double end as o_totalprice from orders
union all select -o_orderkey - 1, o_custkey, -2 from orders where o_orderkey % 2 = 0
union all select null, o_custkey, o_totalprice::double from orders where o_orderkey % 10 = 0
union all select null, o_custkey, -3 from orders where o_orderkey % 20 = 0""",
)
def upsert_co_bucketed(spark, sf_dir):
    """A batch as large as the table, into buckets that are joined where they lie; NULL keys are only added."""
    orders = _orders(spark, sf_dir)
    lacking = F.lit(None).cast(orders.schema["o_orderkey"].dataType)
    target = BucketedTarget(spark, new_path(spark, "bucketed"), key=["o_orderkey"], buckets=8)
    target.replace(orders.where("o_orderkey % 3 > 0").unionByName(orders.where("o_orderkey % 10 = 0").withColumn("o_orderkey", lacking)))
    target.append(orders.where("o_orderkey % 3 = 0"))
    changed = orders.where("o_orderkey % 2 = 0")
    target.upsert(
        changed.withColumn("o_totalprice", F.lit(-1.0))
        .unionByName(changed.withColumn("o_orderkey", -F.col("o_orderkey") - 1).withColumn("o_totalprice", F.lit(-2.0)))
        .unionByName(orders.where("o_orderkey % 20 = 0").withColumn("o_orderkey", lacking).withColumn("o_totalprice", F.lit(-3.0))),
        ["o_orderkey"])
    return target.read()
