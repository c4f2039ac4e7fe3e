"""Tables kept as files, written with append, replace, upsert and merge.

A write never touches live files. It adds a ``_v=<token>`` folder and then
publishes a small commit file that says which folders make up the table, so a
reader sees all of a write or none of it, a lost executor or driver leaves the
table as it was, and the table may be read while it is being replaced.

    <path>/_commits/00000001.json
    <path>/_v=<token>/part-*                    no layout columns
    <path>/_v=<token>/o_orderstatus=F/part-*    partition_by
    <path>/_v=<token>/_bucket=17/part-*         key_buckets

Each innermost folder name is a *slot*. Upsert and merge read and rewrite only
the slots the batch touches.
"""

from __future__ import annotations

import json
import threading
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from tablesync.errors import ConcurrentWriteError, ConfigError, DuplicateKeyError, LoadError
from tablesync.functions.audit import quoted, resolve_columns
from tablesync.functions.schema import fitted, merged_schema, require_free_names, shared_columns
from tablesync.operators.dedup import any_null, key_violations, latest_per_key
from tablesync.operators.merge import fresh_rows, join_side, memory_bytes, merge_columns, upsert_rows
from tablesync.session import broadcast_limit, configured_shared_dir, narrowed
from tablesync.targets.storage import Storage

VERSION, BUCKET, SALT = "_v", "_bucket", "_salt"
COMMITS = "_commits"
NULL_BUCKET = -1
_READ_TRIES = 5
# Text formats by default cut timestamps to milliseconds, trim strings and split
# a value at its line breaks; a table must give back what was written.
_MICROS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}
FORMAT_OPTIONS = {
    "json": _MICROS,
    "xml": {**_MICROS, "rowTag": "row", "ignoreSurroundingSpaces": "false"},
    "csv": {
        **_MICROS, "header": "true", "multiLine": "true", "escape": '"',
        "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
        "nullValue": "\u0001",  # else the empty string would come back as NULL
    },
}
# A CSV text of nothing but that character is written with one more, so that none can equal the marker.
_MARKERS, _LONGER = "^\u0001+$", "^\u0001\u0001+$"
_publishing = threading.Lock()


@dataclass(frozen=True)
class Layout:
    """How rows are arranged. ``key_buckets`` spreads them by a hash of ``key``."""

    partition_by: tuple[str, ...] = ()
    sort_by: tuple[str, ...] = ()
    cluster_by: tuple[str, ...] = ()
    key_buckets: int = 0
    key: tuple[str, ...] = ()
    co_bucketed: bool = False  # the buckets are Spark's own, and written by ``BucketedTarget`` only

    def __post_init__(self) -> None:
        if self.key_buckets and (self.partition_by or not self.key):
            raise ConfigError("key_buckets needs a write key and excludes partition_by")

    @property
    def slot_columns(self) -> tuple[str, ...]:
        return (BUCKET,) if self.key_buckets else self.partition_by

    def fixed_by(self, key: Sequence[str]) -> bool:
        """Whether rows with equal ``key`` always share a slot."""
        return set(self.key if self.key_buckets else self.partition_by) <= set(key)

    def resolved(self, columns: Sequence[str]) -> Layout:
        return replace(self, **{
            name: tuple(resolve_columns(getattr(self, name), columns))
            for name in ("partition_by", "sort_by", "cluster_by", "key")
        })


@dataclass(frozen=True)
class Snapshot:
    """One published state: per slot, the versions that hold its rows."""

    number: int
    schema: T.StructType
    layout: Layout
    slots: Mapping[str, tuple[str, ...]]
    batches: Mapping[str, int] = field(default_factory=dict)

    def to_json(self) -> str:
        return json.dumps({
            "schema": self.schema.jsonValue(), "layout": vars(self.layout),
            "slots": dict(self.slots), "batches": dict(self.batches),
        })

    @staticmethod
    def from_json(number: int, text: str) -> Snapshot:
        data = json.loads(text)
        layout = {k: tuple(v) if isinstance(v, list) else v for k, v in data["layout"].items()}
        slots = {slot: tuple(versions) for slot, versions in data["slots"].items()}
        return Snapshot(number, T.StructType.fromJson(data["schema"]), Layout(**layout), slots, data["batches"])


@dataclass(frozen=True)
class _Written:
    version: str
    slots: tuple[str, ...]


@dataclass(frozen=True)
class _Staged:
    """A batch as a written table, with what it takes in memory."""

    rows: DataFrame
    slots: tuple[str, ...]
    key_bytes: int | None
    row_bytes: int | None


class FileTarget:
    """A table at ``path``, in any format Spark both writes and reads by schema."""

    def __init__(
        self, spark: SparkSession, path: str, *, format: str = "parquet",
        options: Mapping[str, str] | None = None, layout: Layout | None = None,
        schema_evolution: str = "merge", write_partitions: int | None = None,
    ):
        self.spark = spark
        self.storage = Storage(spark, path)
        self.format = format
        self.options = {**FORMAT_OPTIONS.get(format, {}), **(options or {})}
        self.layout = layout or Layout()
        self.schema_evolution = schema_evolution
        self.write_partitions = write_partitions
        self.guard: Callable[[], None] = lambda: None  # raises where this writer may no longer publish

    # -- reading ---------------------------------------------------------

    def snapshot(self) -> Snapshot | None:
        """The latest published state, or None when nothing was published."""
        for _ in range(_READ_TRIES):  # the last commit listed may have expired meanwhile
            commits = self._commits()
            if not commits:
                return None
            snap = self._state(commits[-1])
            if snap is not None:
                return snap
        raise LoadError(f"{self.storage.root}: the state changes faster than it can be read")

    def _commits(self) -> list[str]:
        return sorted(n for n in self.storage.names(COMMITS) if n.endswith(".json"))

    def _state(self, commit: str) -> Snapshot | None:
        try:
            text = self.storage.read_text(f"{COMMITS}/{commit}")
        except FileNotFoundError:
            return None
        return Snapshot.from_json(int(commit.removesuffix(".json")), text)

    def exists(self) -> bool:
        return self.snapshot() is not None

    def read(self) -> DataFrame:
        snap = self.snapshot()
        if snap is None:
            raise LoadError(f"no table at {self.storage.root}")
        return self._rows(snap, snap.slots)

    def _rows(self, snap: Snapshot, slots: Sequence[str], schema: T.StructType | None = None) -> DataFrame:
        return self._folders(self.storage, self._live(snap, slots), schema or snap.schema)

    @staticmethod
    def _live(snap: Snapshot, slots: Sequence[str]) -> list[tuple[str, str]]:
        return [(version, slot) for slot in slots for version in snap.slots.get(slot, ())]

    def _folders(
        self, storage: Storage, folders: Sequence[tuple[str, str]], schema: T.StructType,
    ) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self._open(storage, folders, schema).select(*[self._unmarked(f).alias(f.name) for f in schema])

    def _unmarked(self, field: T.StructField) -> Column:
        """A stored column as its value."""
        value = quoted(field.name)
        if self.format != "csv" or not isinstance(field.dataType, T.StringType):
            return value
        return F.when(value.rlike(_LONGER), F.substr(value, F.lit(2))).otherwise(value)

    def _marked(self, df: DataFrame) -> DataFrame:
        """Rows as they are stored."""
        if self.format != "csv":
            return df
        texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
        return df.withColumns({c: F.when(quoted(c).rlike(_MARKERS), F.concat(F.lit("\u0001"), quoted(c))).otherwise(quoted(c)) for c in texts})

    def _open(
        self, storage: Storage, folders: Sequence[tuple[str, str]], schema: T.StructType,
    ) -> DataFrame:
        """The stored schema is given to the reader, so no file is opened to infer it."""
        paths = [storage.full(f"{VERSION}={version}/{slot}".rstrip("/")) for version, slot in folders]
        reader = self.spark.read.format(self.format).options(**self.options).schema(schema)
        return reader.option("basePath", storage.root).load(paths)

    # -- writing ---------------------------------------------------------

    def append(self, df: DataFrame, batch: tuple[str, int] | None = None) -> None:
        """Add all rows. ``batch`` = (stream, id) makes a repeated call a no-op."""
        snap = self.snapshot()
        if snap is None:
            self._first(df, self.layout, batch, join=True)
            return
        if self._seen(snap, batch):
            return
        schema = merged_schema(snap.schema, df.schema, self.schema_evolution)
        written = self._write(self.storage, fitted(df, schema), snap.layout)
        self._publish(lambda current: self._joined(current, schema, snap.layout, written), written, batch)

    def _joined(
        self, current: Snapshot, schema: T.StructType, layout: Layout, written: _Written,
    ) -> Snapshot:
        """The latest state with one more version in each slot written."""
        if current.layout != layout:
            raise ConcurrentWriteError(f"{self.storage.root}: another writer changed the layout")
        union = merged_schema(current.schema, schema, self.schema_evolution)
        grown = {s: (*current.slots.get(s, ()), written.version) for s in written.slots}
        return replace(current, schema=union, slots={**current.slots, **grown})

    def replace(self, df: DataFrame) -> None:
        """Drop and create: the table takes the schema and layout of this write."""
        self._first(df, self.layout, None)

    def rewrite(self, change: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> None:
        """Replace the rows by a function of them, or just pack them into fewer files.

        Refused when another writer published meanwhile.
        """
        snap = self.snapshot()
        if snap is None:
            raise LoadError(f"no table at {self.storage.root}")
        rows = change(self._rows(snap, snap.slots))
        written = self._write(self.storage, rows, snap.layout)

        def swap(current: Snapshot) -> Snapshot:
            if current.number != snap.number:
                raise ConcurrentWriteError(f"{self.storage.root}: another writer was first")
            return replace(current, slots={slot: (written.version,) for slot in written.slots})

        self._publish(swap, written, None)

    def truncate_insert(self, df: DataFrame) -> None:
        """New rows in the table as it is: its schema and layout stay."""
        snap = self.snapshot()
        if snap is None:
            self._first(df, self.layout, None)
            return
        merged_schema(snap.schema, df.schema, "strict")
        written = self._write(self.storage, fitted(df, snap.schema), snap.layout)
        slots = {slot: (written.version,) for slot in written.slots}
        self._publish(lambda current: replace(current, slots=slots), written, None)

    def upsert(
        self, df: DataFrame, key: Sequence[str], *, duplicates: str = "error",
        order: str | None = None, newest: bool = False, batch: tuple[str, int] | None = None,
    ) -> None:
        """Update rows whose key exists, insert the rest.

        A batch with all columns of the target replaces whole rows; a narrower
        one updates the columns it has. Keys doubled within the batch are an
        error, or settled by the greatest ``order`` (``duplicates='latest'``).
        With ``newest`` a batch row older than the stored one is ignored.
        """
        key = resolve_columns(key, df.columns)
        if (newest or duplicates == "latest") and order is None:
            raise ConfigError("duplicates='latest' and newest need an order column")
        rows = latest_per_key(df, key, order, null_keys_match=False) if duplicates == "latest" else df
        snap = self.snapshot()
        if snap is None:
            self._first(rows, self.layout, batch, unique=key if duplicates == "error" else None, create=True)
            return
        if self._seen(snap, batch):
            return
        staging = self._staging()
        try:
            self._upsert_into(snap, staging, rows, key, duplicates, order, newest, batch)
        finally:
            staging.delete("")

    merge = upsert

    def _upsert_into(
        self, snap: Snapshot, staging: Storage, rows: DataFrame, key: list[str],
        duplicates: str, order: str | None, newest: bool, batch: tuple[str, int] | None,
    ) -> None:
        """The batch is staged first: it is read several times below, and a
        source read again might answer differently."""
        schema = merged_schema(snap.schema, rows.schema, self.schema_evolution)
        columns = shared_columns(schema, rows)
        batch_schema = T.StructType([schema[c] for c in columns])
        key = resolve_columns(key, columns)
        placed = set(snap.layout.key if snap.layout.key_buckets else snap.layout.partition_by)
        # Without its layout columns a batch cannot say which slots it touches.
        stage_layout = snap.layout if placed <= set(columns) else Layout()
        located = stage_layout.slot_columns == snap.layout.slot_columns
        staged = self._stage(staging, fitted(rows, schema, columns), stage_layout, batch_schema, key)
        if duplicates == "error":
            self._require_unique(staged.rows, key)
        if located and snap.layout.fixed_by(key):
            # Keys with a NULL match nothing, so their bucket is only ever added to.
            watched = set(staged.slots) - {f"{BUCKET}={NULL_BUCKET}"}
            touched = watched & set(snap.slots)
        else:
            watched = None  # a key may turn up in any slot
            touched = self._matched_slots(snap, staged, key)
        old = self._rows(snap, [s for s in snap.slots if s in touched], schema)
        if newest:
            order = resolve_columns([order], columns)[0]
            fresh = fresh_rows(old, staged.rows, key, order, self._fits(staged.key_bytes))
            staged = self._stage(staging, fresh, stage_layout, batch_schema, key)
        if len(columns) == len(schema):
            result = upsert_rows(old, staged.rows, key, self._fits(staged.key_bytes))
        else:
            result = merge_columns(old, staged.rows, key, self._fits(staged.row_bytes))
        written = self._write(self.storage, result, snap.layout)

        def swap(current: Snapshot) -> Snapshot:
            seen = set(snap.slots) | set(current.slots) if watched is None else watched
            if any(current.slots.get(s) != snap.slots.get(s) for s in seen):
                raise ConcurrentWriteError(f"{self.storage.root}: another writer changed the same rows")
            kept = {s: v for s, v in current.slots.items() if s not in touched}
            # Rows may also arrive in a slot whose old rows were not read: both stay.
            new = {s: (*kept.get(s, ()), written.version) for s in written.slots}
            union = merged_schema(current.schema, schema, "merge")
            return replace(current, schema=union, slots={**kept, **new})

        self._publish(swap, written, batch)

    # -- parts of a write ------------------------------------------------

    @staticmethod
    def _seen(snap: Snapshot, batch: tuple[str, int] | None) -> bool:
        return batch is not None and snap.batches.get(batch[0], -1) >= batch[1]

    def _first(
        self, df: DataFrame, layout: Layout, batch: tuple[str, int] | None,
        unique: Sequence[str] | None = None, join: bool = False, create: bool = False,
    ) -> None:
        """Write all of ``df`` and publish it as the whole table.

        A table that another writer created meanwhile is joined, replaced, or
        with ``create`` left alone.
        """
        require_free_names(df.columns)
        layout = layout.resolved(df.columns)
        schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema])
        written = self._write(self.storage, df, layout)
        if unique:
            # Checked on what was written, before anyone can see it.
            folders = [(written.version, slot) for slot in written.slots]
            try:
                self._require_unique(self._folders(self.storage, folders, schema), unique)
            except Exception:
                self.storage.delete(f"{VERSION}={written.version}")
                raise
        slots = {slot: (written.version,) for slot in written.slots}

        def whole(current: Snapshot | None) -> Snapshot:
            if current is None:
                return Snapshot(0, schema, layout, slots)
            if join:
                return self._joined(current, schema, layout, written)
            if create:
                raise ConcurrentWriteError(f"{self.storage.root}: created by another writer")
            return Snapshot(current.number, schema, layout, slots, current.batches)

        self._publish(whole, written, batch)

    def _write(self, storage: Storage, df: DataFrame, layout: Layout) -> _Written:
        if layout.co_bucketed:
            raise ConfigError(f"{self.storage.root}: a bucketed table is written with upsert_unit='buckets'")
        version = "v" + uuid.uuid4().hex
        folder = f"{VERSION}={version}"
        rows = self._arranged(self._marked(df), layout)
        texts = [c for c in layout.partition_by if isinstance(df.schema[c].dataType, T.StringType)]
        seen = Observation()
        if texts:
            blank = reduce(Column.__or__, [quoted(c) == "" for c in texts])
            rows = rows.observe(seen, F.count_if(blank).alias("blank"))
        writer = rows.write.format(self.format).options(**self.options)
        if layout.slot_columns:
            writer = writer.partitionBy(*layout.slot_columns)
        try:
            writer.mode("errorifexists").save(storage.full(folder))
            if texts and seen.get["blank"]:
                # A folder name cannot tell the empty string from NULL.
                raise LoadError(f"{storage.root}: empty strings in partition columns {', '.join(texts)}")
        except Exception:
            storage.delete(folder)
            raise
        return _Written(version, tuple(storage.folders(folder, len(layout.slot_columns))))

    def _arranged(self, df: DataFrame, layout: Layout) -> DataFrame:
        """Place rows for the layout without letting one hot value fill one task.

        Slots are gathered with a rebalance, which AQE splits where a slot is
        large; without AQE they are spread by the input task. Range clustering has the input's task number as last sort key:
        it cuts through a hot value, and a re-run task gets the same number.
        """
        if layout.key_buckets:
            hashed = F.pmod(F.xxhash64(*[quoted(k) for k in layout.key]), F.lit(layout.key_buckets))
            bucket = F.when(any_null(layout.key), F.lit(NULL_BUCKET)).otherwise(hashed)
            df = df.withColumn(BUCKET, bucket.cast("int"))
        if layout.cluster_by:
            ranges = [quoted(c) for c in (*layout.slot_columns, *layout.cluster_by)]
            df = df.withColumn(SALT, F.spark_partition_id())
            df = df.repartitionByRange(*ranges, SALT).drop(SALT)
        elif layout.slot_columns:
            slots = [quoted(c) for c in layout.slot_columns]
            if self.spark.conf.get("spark.sql.adaptive.enabled") == "true":
                df = df.hint("rebalance", *slots)
            else:  # nothing would split a large slot at run time
                df = df.withColumn(SALT, F.spark_partition_id()).repartition(*slots, SALT).drop(SALT)
        if self.write_partitions:
            df = narrowed(df, self.write_partitions, spread=not (layout.slot_columns or layout.cluster_by))
        ordered = [*layout.slot_columns, *layout.cluster_by, *layout.sort_by]
        if layout.cluster_by or layout.sort_by:
            df = df.sortWithinPartitions(*[quoted(c) for c in ordered])
        return df

    def _staging(self) -> Storage:
        shared = configured_shared_dir(self.spark)
        base = f"{shared.rstrip('/')}/tablesync" if shared else self.storage.full("_staging")
        return Storage(self.spark, f"{base}/batch-{uuid.uuid4().hex}")

    def _stage(
        self, staging: Storage, df: DataFrame, layout: Layout, schema: T.StructType, key: list[str],
    ) -> _Staged:
        seen = Observation()
        measured = df.observe(
            seen,
            F.count(F.lit(1)).alias("n"),
            F.sum(memory_bytes(schema, key)).alias("key"),
            F.sum(memory_bytes(schema, schema.names)).alias("row"),
        )
        done = self._write(staging, measured, replace(layout, sort_by=(), cluster_by=()))
        rows = self._folders(staging, [(done.version, slot) for slot in done.slots], schema)
        sizes = seen.get if done.slots else {"n": 0}
        if not sizes["n"]:
            return _Staged(rows, done.slots, 0, 0)
        return _Staged(rows, done.slots, sizes["key"], sizes["row"])

    def _fits(self, size: int | None) -> bool:
        """Whether something of this size in memory may be broadcast."""
        return size is not None and size <= broadcast_limit(self.spark)

    def _require_unique(self, df: DataFrame, key: Sequence[str]) -> None:
        example = key_violations(df, key).first()
        if example is not None:
            raise DuplicateKeyError(f"{self.storage.root}: key occurs more than once, e.g. {example.asDict()}")

    def _matched_slots(self, snap: Snapshot, staged: _Staged, key: list[str]) -> set[str]:
        """Slots that hold a key of the batch, found from file names.

        Only key columns are read, and only slot names (as many as the table
        has partitions) reach the driver.
        """
        if not snap.layout.slot_columns:
            return set(snap.slots)
        names = [quoted(k) for k in key]
        # The file path is URL-encoded, with "+" standing for itself.
        path = F.url_decode(F.regexp_replace("_metadata.file_path", r"\+", "%2B"))
        slot = F.regexp_extract(path, f"/{VERSION}=[^/]+/(.*)/[^/]+$", 1).alias("__slot")
        keys = [self._unmarked(snap.schema[k]).alias(k) for k in resolve_columns(key, snap.schema.names)]
        held = self._open(self.storage, self._live(snap, snap.slots), snap.schema).select(*keys, slot)
        new_keys = staged.rows.where(~any_null(key)).select(*names)
        matched = held.join(join_side(new_keys, self._fits(staged.key_bytes)), key, "left_semi")
        return {row["__slot"] for row in matched.select("__slot").distinct().collect()}

    def _publish(
        self, change: Callable[[Snapshot | None], Snapshot], written: _Written,
        batch: tuple[str, int] | None,
    ) -> None:
        """Publish ``change`` of the latest state; again when another writer was first."""
        published = False
        try:
            with _publishing:
                while not published:
                    current = self.snapshot()
                    after = change(current)
                    if batch is not None:
                        after = replace(after, batches={**after.batches, batch[0]: batch[1]})
                    number = 1 if current is None else current.number + 1
                    self.guard()
                    published = self.storage.publish_text(f"{COMMITS}/{number:08d}.json", after.to_json())
        finally:
            if not published:
                self.storage.delete(f"{VERSION}={written.version}")

    def expire(
        self, keep: int = 2, grace: timedelta = timedelta(days=7),
        orphans_after: timedelta = timedelta(days=7),
    ) -> None:
        """Delete versions that no state in use needs.

        In use are the last ``keep`` states and all that were the latest within
        ``grace``, as long as a reader may take with a state it opened. A folder
        no state ever named is left by a writer that died, or belongs to one
        still at work: it goes once it is old.
        """
        commits = self._commits()
        old = []
        for commit, successor in zip(commits[:-keep], commits[1:]):
            if self.storage.age(f"{COMMITS}/{successor}") < grace:
                break
            old.append(commit)
        live, dead = self._versions(commits[len(old):]), self._versions(old)
        for folder in self.storage.names(""):
            version = folder.removeprefix(f"{VERSION}=")
            if version == folder or version in live:
                continue
            if version in dead or self.storage.age(folder) > orphans_after:
                self.storage.delete(folder)
        for name in old:
            self.storage.delete(f"{COMMITS}/{name}")

    def _versions(self, commits: Sequence[str]) -> set[str]:
        states = [snap for snap in map(self._state, commits) if snap is not None]
        return {version for snap in states for versions in snap.slots.values() for version in versions}
