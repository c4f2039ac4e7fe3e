"""Helpers the operators share."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.session import new_path

#: What separates words: the space and the ASCII controls 9 to 13.
SPACE = r"[\x20\x09-\x0D]"


_PLACE = str(Path(__file__).resolve().parents[2])


def let_workers_import(spark: SparkSession) -> None:
    """Python workers find this package where the driver did; a cluster has it installed there."""
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if _PLACE not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [_PLACE, known]))


def tidied(work: Callable[[Iterator], Iterator], forget: Callable[[], None] | None = None) -> Callable[[Iterator], Iterator]:
    """``work`` of a task, after which ``forget`` empties what it remembered and free memory goes back to the system.

    A Python worker serves many tasks, those of later stages as well, and what it holds counts against its executor."""

    def run(batches: Iterator) -> Iterator:
        try:
            yield from work(batches)
        finally:
            if forget:
                forget()
            for pool in (pa.default_memory_pool(), pa.system_memory_pool()):  # the latter trims the C heap
                pool.release_unused()

    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh_names(df: DataFrame, *names: str) -> list[str]:
    """Column names that ``df`` does not have, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    made = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        made.append(name)
    return made


def written(df: DataFrame, label: str, large: bool = False) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, safe when executors go.

    ``large`` says that making it shuffled much. Those shuffle files are of no more use, but Spark
    deletes them only when the driver collects its garbage, so it is asked to."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    if large:
        df.sparkSession.sparkContext._jvm.System.gc()
    made = df.sparkSession.read.schema(df.schema).parquet(path)
    made.written_to = path
    return made


def released(*tables: DataFrame) -> None:
    """Deletes what ``written`` wrote. Only for tables that nothing will read again: what was made of them
    must be written itself."""
    for made in tables:
        spark = made.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(made.written_to)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def words_of(text: Column) -> Column:
    """The words of a text, as an array; null for null."""
    for space in "\t\n\x0b\f\r":
        text = F.replace(text, F.lit(space), F.lit(" "))
    return F.filter(F.split(text, " "), lambda w: w != "")  # a single character splits without a regex


def parts_for(rows: int, per_part: int) -> int:
    """How many partitions keep ``per_part`` rows each."""
    return max(1, -(-rows // per_part))


def with_facts(rows: DataFrame, facts: DataFrame, key: list[str], count: str, total: int) -> DataFrame:
    """``rows`` joined with the one fact of their key. ``count`` bounds a key's rows, and the counts of all
    keys sum to at most ``total``: so at most 1,000 keys exceed a thousandth, and those are broadcast."""
    hot = F.broadcast(facts.where(F.col(count) > max(total // 1000, 1000)))
    cold = facts.where(F.col(count) <= max(total // 1000, 1000))
    rest = rows.join(hot.select(*key), key, "left_anti")
    return rows.join(hot, key).unionByName(rest.join(cold.hint("shuffle_hash"), key))
