"""Places and limits read from the running Spark session."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from tablesync.errors import ConfigError

_BYTE_UNITS = {"": 1, "b": 1, "k": 2**10, "kb": 2**10, "m": 2**20, "mb": 2**20, "g": 2**30, "gb": 2**30}
_UNKNOWN = 1 << 50  # bytes; Spark takes what it cannot estimate for huge
_local_root: str | None = None


def configured_shared_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names, or None."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    return named or spark.sparkContext.getCheckpointDir() or None


def shared_dir(spark: SparkSession) -> str:
    """A folder every node sees. Only local mode may fall back to a temporary one."""
    global _local_root
    named = configured_shared_dir(spark)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ConfigError("set spark.checkpoint.dir to a folder all nodes share")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="tablesync-")
    return _local_root


def new_path(spark: SparkSession, label: str) -> str:
    """An unused path under the shared folder."""
    return f"{shared_dir(spark)}/tablesync/{label}-{uuid.uuid4().hex}"


def broadcast_limit(spark: SparkSession) -> int:
    """``spark.sql.autoBroadcastJoinThreshold`` in bytes (negative means never)."""
    return _bytes(spark.conf.get("spark.sql.autoBroadcastJoinThreshold"))


def _bytes(text: str) -> int:
    text = text.strip().lower()
    digits = text.rstrip("bkmg")
    return int(digits) * _BYTE_UNITS[text[len(digits):]]


def narrowed(df: DataFrame, partitions: int, spread: bool = True) -> DataFrame:
    """``df`` in ``partitions`` partitions, or in more where one would be larger than
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes``, so that no task's share grows with the table.

    Spark's estimate of the size decides. What it takes for larger, or cannot tell, is rebalanced and cut
    by what was shuffled; without AQE, or with ``spread`` False (rows lie as they must), it stays as it comes.
    """
    spark = df.sparkSession
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    share = _bytes(spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes"))
    if size <= partitions * share:
        return df.coalesce(partitions)
    if not spread or spark.conf.get("spark.sql.adaptive.enabled") != "true":
        return df
    return df.hint("rebalance", partitions if size > _UNKNOWN else max(partitions, min(-(-size // share), 10_000)))
