"""File tables bucketed and sorted by key, so that a batch of any size joins without a shuffle of the table.

Commits and versions are those of ``FileTarget``. A version's rows with a whole key lie in Spark's own
buckets under ``_rows=keyed``, where the planner knows that equal keys share one; rows with a NULL in
the key match nothing and lie beside them under ``_rows=unkeyed``, in as many files as wrote them. The
batch is the only thing that is shuffled: once, into the same number of buckets.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from tablesync.errors import ConcurrentWriteError, ConfigError, LoadError
from tablesync.functions.audit import quoted, resolve_columns
from tablesync.functions.schema import fitted, merged_schema, shared_columns
from tablesync.operators.dedup import any_null
from tablesync.operators.merge import fresh_rows, merge_columns
from tablesync.targets.files import VERSION, FileTarget, Layout, Snapshot, _Written
from tablesync.targets.storage import Storage

KEYED, UNKEYED = "_rows=keyed", "_rows=unkeyed"


class BucketedTarget(FileTarget):
    """Upserts by ``key`` read and write each bucket where it lies; with another key they are refused.

    A bucket is one task's work, so this suits keys that are unique: a table that appends gave many rows of
    one key is better kept in slots."""

    def __init__(
        self, spark: SparkSession, path: str, *, key: Sequence[str], buckets: int, format: str = "parquet",
        options: Mapping[str, str] | None = None, schema_evolution: str = "merge",
    ):
        if buckets < 1 or not key or format not in ("parquet", "orc"):
            raise ConfigError("buckets need a number, a write key, and files of parquet or orc")
        layout = Layout(key_buckets=buckets, key=tuple(key), co_bucketed=True)
        super().__init__(spark, path, format=format, options=options, layout=layout, schema_evolution=schema_evolution)

    # -- reading ---------------------------------------------------------

    @contextmanager
    def _passing_table(self) -> Iterator[str]:
        """A name in the catalog for as long as it takes to write or resolve one external table: only there
        does Spark know of buckets. Dropping it leaves the files."""
        name = f"tablesync_{uuid.uuid4().hex}"
        try:
            yield name
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def _bucketed(self, storage: Storage, version: str, schema: T.StructType, layout: Layout) -> DataFrame:
        """The keyed rows of one version, whose buckets the planner knows."""
        by = ", ".join(f"`{k.replace('`', '``')}`" for k in layout.key)
        place = storage.full(f"{VERSION}={version}/{KEYED}").replace("'", "\\'")
        options = ", ".join(f"'{k}' '{v}'" for k, v in self.options.items())
        with self._passing_table() as name:
            self.spark.sql(
                f"CREATE TABLE {name} ({schema.toDDL()}) USING {self.format} {f'OPTIONS ({options})' if options else ''} "
                f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {layout.key_buckets} BUCKETS LOCATION '{place}'")
            return self.spark.table(name).select(*map(quoted, schema.names))

    def keyed_versions(self, snap: Snapshot, schema: T.StructType | None = None) -> list[DataFrame]:
        """The rows with a whole key, a frame per version that holds some: one after an upsert, more after appends."""
        return [self._bucketed(self.storage, v, schema or snap.schema, snap.layout) for v in snap.slots.get(KEYED, ())]

    # -- writing ---------------------------------------------------------

    def append(self, df: DataFrame, batch: tuple[str, int] | None = None) -> None:
        snap = self.snapshot()
        if snap is not None:
            self._require_same_key(snap, merged_schema(snap.schema, df.schema, self.schema_evolution), snap.layout.key)
        super().append(df, batch)

    def _require_same_key(self, snap: Snapshot, schema: T.StructType, key: Sequence[str]) -> None:
        """Equal keys of another type lie in other buckets."""
        if sorted(key) != sorted(snap.layout.key):
            raise ConfigError(f"{self.storage.root}: bucketed by {', '.join(snap.layout.key)}, not {', '.join(key)}")
        for k in key:
            if schema[k].dataType != snap.schema[k].dataType:
                raise LoadError(f"{self.storage.root}: {k} cannot become {schema[k].dataType.simpleString()}, as rows are bucketed by it")

    def _write(self, storage: Storage, df: DataFrame, layout: Layout) -> _Written:
        def keyed(rows: DataFrame) -> DataFrame:
            return rows.repartition(layout.key_buckets, *[quoted(k) for k in layout.key])

        return self._put(storage, df, layout, keyed)

    def _put(self, storage: Storage, df: DataFrame, layout: Layout, place: Callable[[DataFrame], DataFrame]) -> _Written:
        version = "v" + uuid.uuid4().hex
        folder, seen, again = f"{VERSION}={version}", Observation(), Observation()
        try:
            lacking = any_null(layout.key)
            rows = df.observe(seen, F.count_if(lacking).alias("unkeyed"), F.count_if(~lacking).alias("keyed"))
            writer = place(rows.where(~lacking)).write.format(self.format).options(**self.options)
            with self._passing_table() as name:
                writer.bucketBy(layout.key_buckets, *layout.key).sortBy(*layout.key).option("path", storage.full(f"{folder}/{KEYED}")).saveAsTable(name)
            found = seen.get
            if found["unkeyed"]:  # seldom: NULL keys are counted on the way and written in a second pass
                rest = df.where(lacking).observe(again, F.count(F.lit(1)).alias("n"))
                rest.write.format(self.format).options(**self.options).save(storage.full(f"{folder}/{UNKEYED}"))
                if again.get["n"] != found["unkeyed"]:
                    raise LoadError(f"{storage.root}: the source changed while it was written")
        except Exception:
            storage.delete(folder)
            raise
        slots = [slot for slot, n in ((KEYED, found["keyed"]), (UNKEYED, found["unkeyed"])) if n]
        return _Written(version, tuple(slots))

    def _upsert_into(
        self, snap: Snapshot, staging: Storage, rows: DataFrame, key: list[str],
        duplicates: str, order: str | None, newest: bool, batch: tuple[str, int] | None,
    ) -> None:
        schema = merged_schema(snap.schema, rows.schema, self.schema_evolution)
        columns = shared_columns(schema, rows)
        batch_schema = T.StructType([schema[c] for c in columns])
        key = resolve_columns(key, columns)
        self._require_same_key(snap, schema, key)
        layout, old = snap.layout, self.keyed_versions(snap, schema)
        empty = self.spark.createDataFrame([], batch_schema)

        def staged(df: DataFrame) -> tuple[DataFrame, DataFrame]:
            done = self._write(staging, df, layout)
            held = self._bucketed(staging, done.version, batch_schema, layout) if KEYED in done.slots else empty
            lacking = self._folders(staging, [(done.version, UNKEYED)], batch_schema) if UNKEYED in done.slots else empty
            return held, lacking

        held, lacking = staged(fitted(rows, schema, columns))
        if duplicates == "error":
            self._require_unique(held, key)
        if newest and old:
            held, lacking = staged(fresh_rows(_union(old), held.unionByName(lacking), key, resolve_columns([order], columns)[0], False))
        if not old:
            keyed = fitted(held, schema)
        elif len(columns) == len(schema):
            known = held.select(*map(quoted, key)).hint("merge")
            kept = [version.join(known, key, "left_anti").select(*map(quoted, schema.names)) for version in old]
            keyed = _union([*kept, held.select(*map(quoted, schema.names))])
        else:
            keyed = merge_columns(_union(old), held, key, False)
        # Buckets are where they were: only each task's own rows are sorted again.
        written = self._put(self.storage, keyed.unionByName(fitted(lacking, schema)), layout, lambda df: df)

        def swap(current: Snapshot) -> Snapshot:
            if current.slots.get(KEYED) != snap.slots.get(KEYED):
                raise ConcurrentWriteError(f"{self.storage.root}: another writer changed the same rows")
            slots = {s: v for s, v in current.slots.items() if s != KEYED}
            if KEYED in written.slots:
                slots[KEYED] = (written.version,)
            if UNKEYED in written.slots:
                slots[UNKEYED] = (*current.slots.get(UNKEYED, ()), written.version)
            return replace(current, schema=merged_schema(current.schema, schema, "merge"), slots=slots)

        self._publish(swap, written, batch)


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
