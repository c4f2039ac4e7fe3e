"""Incremental file ingest: take the files that are new, upsert, stop."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.streaming import StreamingQuery

from tablesync.targets.files import FileTarget
from tablesync.targets.storage import Storage


def ingest_available(
    spark: SparkSession, path: str, schema: T.StructType, target: FileTarget, checkpoint: str, *,
    key: Sequence[str] = (), order: str | None = None, format: str = "parquet",
    options: Mapping[str, str] | None = None,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    keep_for: timedelta = timedelta(days=7), max_files: int | None = None,
) -> StreamingQuery:
    """Load all files under ``path`` that earlier calls have not loaded.

    With a ``key`` the target keeps, per key, the row with the greatest
    ``order``, whatever order files arrive in; without one rows are appended.
    The checkpoint remembers the files. A batch repeated after a failure has the
    same number and is skipped when the target already holds it. Numbers belong
    to a checkpoint: a new one starts over, and its batches are not mistaken for
    the old one's. States of the target that were the latest within ``keep_for``
    stay readable. ``max_files`` cuts a backlog into batches of so many files; without it a first
    call takes all there is as one batch.
    """
    saved = Storage(spark, checkpoint)

    def apply(batch: DataFrame, batch_id: int) -> None:
        rows = transform(batch) if transform else batch
        stream = json.loads(saved.read_text("metadata"))["id"]
        if key:
            target.upsert(
                rows, key, duplicates="latest", order=order, newest=True, batch=(stream, batch_id)
            )
        else:
            target.append(rows, batch=(stream, batch_id))
        target.expire(grace=keep_for)

    reader = spark.readStream.format(format).schema(schema).options(**(options or {}))
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    query = (
        reader.load(path).writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query
