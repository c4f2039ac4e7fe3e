"""Tables kept as a log of files: upserts rewrite or mark single files, not slots.

    <path>/data/<token>/part-*.parquet     rows; a file never changes
    <path>/marks/<token>/                  (file, pos): rows that an upsert replaced
    <path>/_log/entries-<token>/           what a commit says of files, as a table Spark writes
    <path>/_log/00000001.json              the commit: which entries, which schema
    <path>/_log/00000010.checkpoint.json   all live files after commit 10, in one entries table

An entry names a file, its rows and bytes, the least and greatest value of each key column, and a Bloom
filter of its keys. A commit is one small file whatever the table's size; a state is the last
checkpoint and the commits after it, the newest entry of each file counting. Only names of files reach
the driver.

An upsert looks for its keys in three steps: files whose key ranges do not meet the batch's are left
out, then (for batches of up to ``BLOOM_KEYS`` keys) those whose Bloom filter has none of them; the key
columns of the rest are joined. With ``upsert="rewrite"`` the files that hold a key are written anew;
with ``upsert="mark"`` only the batch is written, and the places of the rows it replaces, which readers
subtract by an anti join until ``pack`` folds them in. ``pack`` also joins small files into full ones.
Commits are published by a rename that fails where the name is taken; a writer that finds others were
first publishes again after them, or fails if they changed a file it read.
"""

from __future__ import annotations

import json
import threading
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from tablesync.errors import ConcurrentWriteError, ConfigError, DuplicateKeyError, LoadError
from tablesync.functions.audit import quoted, resolve_columns
from tablesync.functions.curve import within, z_place
from tablesync.functions.schema import fitted, merged_schema, require_free_names, shared_columns
from tablesync.operators.dedup import any_null, key_violations, latest_per_key
from tablesync.operators.merge import join_side, memory_bytes, merge_columns, upsert_rows
from tablesync.session import broadcast_limit, configured_shared_dir, narrowed
from tablesync.targets.storage import Storage

_FILE, _POS = "__file", "__pos"
_BITS = 32768  # of one bitmap, which is what Spark's bitmap functions make
#: Keys of a batch up to which Bloom filters are asked; of more, chance would find some in every file.
BLOOM_KEYS = 4096
#: Bytes of rows, as a task that packs holds them to sort them (some 24 a column), up to which files are joined.
TASK_MEMORY = 256 << 20
#: Intervals that sum up where a batch's keys lie.
_RANGES = 64
_publishing = threading.Lock()


@dataclass(frozen=True)
class LogState:
    number: int
    schema: T.StructType
    key: tuple[str, ...]
    batches: dict[str, int]
    tables: tuple[tuple[int, str], ...]  # commit number and entries table, oldest first


@dataclass(frozen=True)
class LiveFile:
    name: str
    marks: tuple[str, ...] = ()
    size: int = field(default=0, compare=False)
    rows: int = field(default=0, compare=False)


class FileLogTarget:
    def __init__(
        self, spark: SparkSession, path: str, *, key: Sequence[str] = (), upsert: str = "rewrite",
        schema_evolution: str = "merge", file_bytes: int = 128 << 20, checkpoint_every: int = 10,
        blooms: int = 8, write_partitions: int | None = None, z_order: int = 0,
    ):
        """``key`` are the columns that entries index. With ``z_order`` > 0 a write deals its rows to that many
        files along the Z curve over them, so that ranges of any of these columns meet few files."""
        if upsert not in ("rewrite", "mark"):
            raise ConfigError("upsert is 'rewrite' or 'mark'")
        self.spark, self.storage, self.key, self.mode = spark, Storage(spark, path), tuple(key), upsert
        self.schema_evolution, self.file_bytes, self.checkpoint_every = schema_evolution, file_bytes, checkpoint_every
        self.blooms, self.write_partitions, self.z_order = blooms, write_partitions, z_order
        self.guard: Callable[[], None] = lambda: None  # raises where this writer may no longer publish

    # -- reading ---------------------------------------------------------

    def _numbers(self) -> tuple[list[int], list[int]]:
        names = self.storage.names("_log")
        commits = sorted(int(n[:8]) for n in names if n.endswith(".json") and n.count(".") == 1)
        return commits, sorted(int(n[:8]) for n in names if n.endswith(".checkpoint.json"))

    def state(self) -> LogState | None:
        commits, checkpoints = self._numbers()
        if not commits:
            return None
        last = commits[-1]
        base = max((c for c in checkpoints if c <= last), default=0)
        tables: list[tuple[int, str]] = []
        head: dict = {}
        if base:
            head = json.loads(self.storage.read_text(f"_log/{base:08d}.checkpoint.json"))
            tables.append((base, head["entries"]))
        for number in range(base + 1, last + 1):
            head = json.loads(self.storage.read_text(f"_log/{number:08d}.json"))
            if head["reset"]:
                tables = []
            tables.append((number, head["entries"]))
        return LogState(last, T.StructType.fromJson(head["schema"]), tuple(head["key"]), head["batches"], tuple(tables))

    def exists(self) -> bool:
        return bool(self._numbers()[0])

    def _entries_type(self, schema: T.StructType, key: Sequence[str]) -> T.StructType:
        fixed = "file string, live boolean, rows long, bytes long, marks array<string>, bloom map<long,binary>"
        made = T.StructType.fromDDL(fixed)
        for i, name in enumerate(key):
            made = made.add(f"lo{i}", schema[name].dataType).add(f"hi{i}", schema[name].dataType)
        return made

    def entries(self, state: LogState, *columns: str) -> DataFrame:
        """The live files; with ``columns`` only those of each."""
        kind = self._entries_type(state.schema, state.key)
        columns = columns or tuple(n for n in kind.names if n not in ("file", "live"))
        said = [self.spark.read.schema(kind).parquet(self.storage.full(f"_log/{table}")).select(
            "file", "live", *columns, F.lit(number).alias("commit")) for number, table in state.tables]
        newest = reduce(DataFrame.unionByName, said).groupBy("file").agg(F.max_by(F.struct("live", *columns), "commit").alias("e"))
        return newest.where("e.live").select("file", *[F.col(f"e.{c}").alias(c) for c in columns])

    def files(self, state: LogState | None = None, which: DataFrame | None = None) -> list[LiveFile]:
        state = state or self.state()
        found = which if which is not None else self.entries(state, "marks", "bytes", "rows")
        return [LiveFile(r["file"], tuple(r["marks"] or ()), r["bytes"], r["rows"]) for r in found.select("file", "marks", "bytes", "rows").collect()]

    def read(self, between: dict[str, tuple] | None = None) -> DataFrame:
        """The rows; with ``between`` (column: (lowest, highest), None open) those inside, and only files
        whose ranges of indexed columns meet them are opened."""
        state = self.state()
        if state is None:
            raise LoadError(f"no table at {self.storage.root}")
        if not between:
            return self._rows(state.schema, self.files(state))
        return self._rows(state.schema, self.meeting(state, between)).where(within(between, state.schema.names))

    def meeting(self, state: LogState, between: dict[str, tuple]) -> list[LiveFile]:
        told = self.entries(state)
        for i, name in enumerate(state.key):
            low, high = between.get(name, (None, None))
            told = told if low is None else told.where(F.col(f"hi{i}") >= F.lit(low))
            told = told if high is None else told.where(F.col(f"lo{i}") <= F.lit(high))
        return self.files(state, told)

    def _rows(self, schema: T.StructType, files: Iterable[LiveFile]) -> DataFrame:
        files = list(files)
        columns = [quoted(c) for c in schema.names]
        whole = [f for f in files if not f.marks]
        parts = [self._opened(schema, whole).select(*columns)] if whole else []
        if len(whole) < len(files):
            parts.append(self._placed(schema, [f for f in files if f.marks]).select(*columns))
        return reduce(DataFrame.unionByName, parts) if parts else self.spark.createDataFrame([], schema)

    def _opened(self, schema: T.StructType, files: Sequence[LiveFile]) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*[self.storage.full(f"data/{f.name}") for f in files])

    def _placed(self, schema: T.StructType, files: Sequence[LiveFile]) -> DataFrame:
        """Rows that are not marked, each with its file and its place there."""
        rows = self._opened(schema, files).select(
            "*", F.regexp_extract("_metadata.file_path", "([^/]+/[^/]+)$", 1).alias(_FILE), F.col("_metadata.row_index").alias(_POS))
        tables = sorted({m for f in files for m in f.marks})
        if not tables:
            return rows
        marks = self.spark.read.schema(f"{_FILE} string, {_POS} long").parquet(*[self.storage.full(f"marks/{m}") for m in tables])
        small = marks.count() * 128 <= broadcast_limit(self.spark)  # a count of Parquet rows reads footers only
        return rows.join(join_side(marks, small), [_FILE, _POS], "left_anti")

    # -- writing ---------------------------------------------------------

    def append(self, df: DataFrame, batch: tuple[str, int] | None = None) -> None:
        state = self.state()
        if state is None:
            self._first(df, batch)
            return
        if batch is not None and state.batches.get(batch[0], -1) >= batch[1]:
            return
        schema = merged_schema(state.schema, df.schema, self.schema_evolution)
        token = self._write(fitted(df, schema))
        self._publish(state, schema, state.key, self._described(token, schema, state.key), batch)

    def replace(self, df: DataFrame) -> None:
        self._first(df, None)

    def truncate_insert(self, df: DataFrame) -> None:
        state = self.state()
        if state is None:
            self._first(df, None)
            return
        merged_schema(state.schema, df.schema, "strict")
        token = self._write(fitted(df, state.schema))
        self._publish(state, state.schema, state.key, self._described(token, state.schema, state.key), None, reset=True)

    def upsert(
        self, df: DataFrame, key: Sequence[str], *, duplicates: str = "error", order: str | None = None,
        batch: tuple[str, int] | None = None,
    ) -> None:
        """Update rows whose key exists, insert the rest; a narrower batch updates the columns it has."""
        key = resolve_columns(key, df.columns)
        if duplicates == "latest" and order is None:
            raise ConfigError("duplicates='latest' needs an order column")
        df = latest_per_key(df, key, order, null_keys_match=False) if duplicates == "latest" else df
        state = self.state()
        if state is None:
            self._first(df, batch, unique=key if duplicates == "error" else None)
            return
        if batch is not None and state.batches.get(batch[0], -1) >= batch[1]:
            return
        schema = merged_schema(state.schema, df.schema, self.schema_evolution)
        columns = shared_columns(schema, df)
        key = resolve_columns(key, columns)
        shared = configured_shared_dir(self.spark)
        stage = Storage(self.spark, f"{shared.rstrip('/') + '/tablesync' if shared else self.storage.full('_staging')}/batch-{uuid.uuid4().hex}")
        try:
            rows, n, key_bytes, row_bytes = self._staged(stage, fitted(df, schema, columns), T.StructType([schema[c] for c in columns]), key)
            if duplicates == "error":
                self._require_unique(rows, key)
            self._upsert(state, schema, rows, n, key, self._fits(key_bytes), self._fits(row_bytes), batch)
        finally:
            stage.delete("")

    merge = upsert

    def _upsert(
        self, state: LogState, schema: T.StructType, rows: DataFrame, n: int, key: list[str],
        keys_fit: bool, rows_fit: bool, batch: tuple[str, int] | None,
    ) -> None:
        narrow = len(rows.columns) < len(schema)
        keys = rows.where(~any_null(key)).select(*map(quoted, key))
        maybe = self.candidates(state, keys, n, key)
        held = self._placed(schema, maybe).join(join_side(keys, keys_fit), key, "left_semi") if maybe else None
        if self.mode == "rewrite" or held is None:
            names = {r[0] for r in held.select(_FILE).distinct().collect()} if held is not None else set()
            old = self._rows(schema, [f for f in maybe if f.name in names])
            result = merge_columns(old, rows, key, rows_fit) if narrow else upsert_rows(old, rows, key, keys_fit)
            changed = self._said(state, names, lambda e: e.withColumn("live", F.lit(False)))
        else:
            marks = uuid.uuid4().hex
            held.select(_FILE, _POS).sort(_FILE, _POS).write.parquet(self.storage.full(f"marks/{marks}"))
            names = {r[0] for r in self.spark.read.parquet(self.storage.full(f"marks/{marks}")).select(_FILE).distinct().collect()}
            result = merge_columns(held.select(*map(quoted, schema.names)), rows, key, rows_fit) if narrow else rows
            also = F.concat(F.coalesce("marks", F.array().cast("array<string>")), F.array(F.lit(marks)))
            changed = self._said(state, names, lambda e: e.withColumn("live", F.lit(True)).withColumn("marks", also))
        token = self._write(fitted(result, schema))
        new = self._described(token, schema, state.key)
        self._publish(state, schema, state.key, new if changed is None else new.unionByName(changed), batch, touched=names, alone=True)

    def pack(self, file_bytes: int | None = None) -> int:
        """Joins small files, and files with marked rows, into full ones; returns how many were replaced.
        A file is full by its bytes, or by ``TASK_MEMORY`` of rows, which a task sorts.

        Appends meanwhile stay; if another writer replaced or marked one of these files, nothing happens
        and ``ConcurrentWriteError`` is raised."""
        size = file_bytes or self.file_bytes
        state = self.state()
        live = self.files(state)
        most = max(2, TASK_MEMORY // (24 * (1 + len(state.schema))))
        chosen = [f for f in live if f.marks or (f.size < size // 2 and f.rows < most // 2)]
        if not any(f.marks for f in chosen) and len(chosen) < 2:
            return 0
        into = max(1, -(-sum(f.size for f in chosen) // size), -(-sum(f.rows for f in chosen) // most))
        rows = self._rows(state.schema, chosen)
        ordered = rows.repartitionByRange(into, *map(quoted, state.key)).sortWithinPartitions(*map(quoted, state.key)) if state.key else rows.coalesce(into)
        token = self._write(ordered, arranged=False)
        names = {f.name for f in chosen}
        gone = self._said(state, names, lambda e: e.withColumn("live", F.lit(False)))
        self._publish(state, state.schema, state.key, self._described(token, state.schema, state.key).unionByName(gone), None, touched=names)
        return len(chosen)

    # -- parts of a write ------------------------------------------------

    def candidates(self, state: LogState, keys: DataFrame, n: int, key: Sequence[str]) -> list[LiveFile]:
        """Files that may hold one of ``keys``, by ranges and Bloom filters, without opening any."""
        if list(state.key) != list(key):
            return self.files(state)
        told = self.entries(state)
        lows = [f"lo{i}" for i in range(len(key))]
        first = quoted(key[0])
        # The batch's keys, cut at quantiles into a few intervals; numbers and dates only, others make one interval
        parts = keys.select(first.alias("k"))
        if isinstance(keys.schema[0].dataType, T.NumericType):
            cuts = parts.agg(F.percentile_approx("k", [i / _RANGES for i in range(1, _RANGES)], 10_000)).first()[0] or []
            part = reduce(Column.__add__, [(F.col("k") > F.lit(c)).cast("int") for c in sorted(set(cuts))], F.lit(0))
        else:
            part = F.lit(0)
        spans = parts.groupBy(part.alias("part")).agg(F.min("k").alias("low"), F.max("k").alias("high"))
        spans = spans.agg(F.collect_list(F.struct("low", "high")).alias("spans"))  # one row, at most _RANGES spans
        meets = F.exists("spans", lambda s: (s.low <= F.col("hi0")) & (s.high >= F.col("lo0")))
        others = keys.agg(*[f(quoted(k)).alias(f"{name}{i}") for i, k in enumerate(key) if i for f, name in ((F.min, "from"), (F.max, "upto"))]) if len(key) > 1 else None
        told = told.join(F.broadcast(spans)).where(meets)
        if others is not None:
            inside = reduce(Column.__and__, [(F.col(f"from{i}") <= F.col(f"hi{i}")) & (F.col(f"upto{i}") >= F.col(f"lo{i}")) for i in range(1, len(lows))])
            told = told.join(F.broadcast(others)).where(inside)
        if n <= BLOOM_KEYS:
            places = keys.agg(F.collect_set(self._place(key)).alias("places"))  # one row, at most BLOOM_KEYS numbers
            byte = lambda p: F.substring(F.element_at("bloom", (p / _BITS).cast("long")), ((p % _BITS) / 8).cast("int") + 1, 1)
            bit = lambda p: F.conv(F.hex(byte(p)), 16, 10).cast("int").bitwiseAND(F.pow(F.lit(2), p % 8).cast("int")) != 0
            told = told.join(F.broadcast(places)).where(F.exists("places", bit))
        return self.files(state, told)

    def _place(self, key: Sequence[str]) -> Column:
        """The bit of a key. Values are hashed as text, so a column that was widened keeps its bits."""
        return F.pmod(F.xxhash64(*[quoted(k).cast("string") for k in key]), F.lit(self.blooms * _BITS))

    def _said(self, state: LogState, names: set[str], change) -> DataFrame | None:
        """Entries of some files, changed."""
        if not names:
            return None
        some = self.spark.createDataFrame([(n,) for n in names], "file string")
        kind = self._entries_type(state.schema, state.key)
        return change(self.entries(state).join(F.broadcast(some), "file")).select(*kind.names)

    def _write(self, df: DataFrame, arranged: bool = True) -> str:
        token = uuid.uuid4().hex
        key = [quoted(k) for k in self.key if k in df.columns]
        if self.write_partitions and arranged:
            df = narrowed(df, self.write_partitions)
        if self.z_order and arranged and key:
            place = z_place(df, [k for k in self.key if k in df.columns])
            df = df.withColumn("_salt", place).repartitionByRange(self.z_order, "_salt").sortWithinPartitions("_salt").drop("_salt")
        elif key and arranged:
            df = df.sortWithinPartitions(*key)
        df.write.parquet(self.storage.full(f"data/{token}"))
        return token

    def _described(self, token: str, schema: T.StructType, key: Sequence[str]) -> DataFrame:
        """Entries of the files just written. Reads their key columns only."""
        kind = self._entries_type(schema, key)
        folder = self.storage.full(f"data/{token}")
        rows = self.spark.read.schema(schema).parquet(folder).select(
            *[quoted(k) for k in key], F.concat(F.lit(f"{token}/"), F.col("_metadata.file_name")).alias("file"), F.col("_metadata.file_size").alias("bytes"))
        stats = rows.groupBy("file").agg(
            F.count("*").alias("rows"), F.max("bytes").alias("bytes"),
            *[f(quoted(k)).alias(f"{name}{i}") for i, k in enumerate(key) for f, name in ((F.min, "lo"), (F.max, "hi"))])
        stats = stats.withColumn("live", F.lit(True)).withColumn("marks", F.lit(None).cast("array<string>"))
        if not key:
            return stats.withColumn("bloom", F.lit(None).cast("map<bigint,binary>")).select(*kind.names)
        place = rows.where(~any_null(key)).select("file", self._place(key).alias("p"))
        bits = place.groupBy("file", (F.col("p") / _BITS).cast("long").alias("b")).agg(F.bitmap_construct_agg(F.col("p") % _BITS).alias("bits"))
        bloom = bits.groupBy("file").agg(F.map_from_entries(F.collect_list(F.struct("b", "bits"))).alias("bloom"))  # at most ``blooms`` of 4 KB
        return stats.join(bloom, "file", "left").select(*kind.names)

    def _first(self, df: DataFrame, batch: tuple[str, int] | None, unique: Sequence[str] | None = None) -> None:
        require_free_names(df.columns)
        schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema])
        key = tuple(resolve_columns(self.key, df.columns)) or tuple(unique or ())
        token = self._write(df)
        if unique:
            self._require_unique(self.spark.read.schema(schema).parquet(self.storage.full(f"data/{token}")), unique)
        state = self.state()
        self._publish(state, schema, key, self._described(token, schema, key), batch, reset=True)

    def _staged(self, stage: Storage, df: DataFrame, schema: T.StructType, key: list[str]) -> tuple[DataFrame, int, int | None, int | None]:
        seen = Observation()
        measured = df.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(memory_bytes(schema, key)).alias("key"), F.sum(memory_bytes(schema, schema.names)).alias("row"))
        measured.write.parquet(stage.full("rows"))
        sizes = seen.get
        return self.spark.read.schema(schema).parquet(stage.full("rows")), sizes["n"], sizes["key"] or 0, sizes["row"] if sizes["n"] else 0

    def _fits(self, size: int | None) -> bool:
        return size is not None and size <= broadcast_limit(self.spark)

    def _require_unique(self, df: DataFrame, key: Sequence[str]) -> None:
        example = key_violations(df, key).first()
        if example is not None:
            raise DuplicateKeyError(f"{self.storage.root}: key occurs more than once, e.g. {example.asDict()}")

    def _publish(
        self, state: LogState | None, schema: T.StructType, key: Sequence[str], entries: DataFrame,
        batch: tuple[str, int] | None, *, reset: bool = False, touched: set[str] | None = None, alone: bool = False,
    ) -> None:
        """Publish after the newest commit. ``touched`` files must be as they were; ``alone`` refuses any other
        writer's rows as well, as they might hold the batch's keys."""
        table = f"entries-{uuid.uuid4().hex}"
        entries.coalesce(1).write.parquet(self.storage.full(f"_log/{table}"))  # a row a file of this write
        with _publishing:
            while True:
                now = self.state()
                if now is not None and state is not None and not reset and now.number > state.number:
                    self._still_fits(state, now, touched or set(), alone)
                    schema = merged_schema(now.schema, schema, self.schema_evolution)
                number = 1 if now is None else now.number + 1
                self.guard()
                batches = {} if now is None else dict(now.batches)
                if batch is not None:
                    batches[batch[0]] = batch[1]
                head = {"schema": schema.jsonValue(), "key": list(key), "batches": batches, "reset": reset, "entries": table}
                if self.storage.publish_text(f"_log/{number:08d}.json", json.dumps(head)):
                    break
        if number % self.checkpoint_every == 0:
            self.checkpoint()

    def _still_fits(self, then: LogState, now: LogState, touched: set[str], alone: bool) -> None:
        newer = [(n, t) for n, t in now.tables if n > then.number]
        if now.tables[0][0] > then.number:  # a checkpoint or a reset lies between: compare whole states
            live = {f.name: f for f in self.files(now)}
            before = {f.name: f for f in self.files(then)}
            clash = {n for n in touched if live.get(n) != before.get(n)}
            added = live.keys() - before.keys()
        else:
            said = self.files(now, reduce(DataFrame.unionByName, [
                self.spark.read.schema(self._entries_type(now.schema, now.key)).parquet(self.storage.full(f"_log/{t}")) for _, t in newer]))
            clash, added = touched & {f.name for f in said}, {f.name for f in said}
        if clash or (alone and added):
            raise ConcurrentWriteError(f"{self.storage.root}: another writer changed the same rows")

    def checkpoint(self) -> None:
        """All live files in one entries table, so that older commits need not be read."""
        state = self.state()
        table = f"entries-{uuid.uuid4().hex}"
        kind = self._entries_type(state.schema, state.key)
        self.entries(state).withColumn("live", F.lit(True)).select(*kind.names).write.parquet(self.storage.full(f"_log/{table}"))
        head = {"schema": state.schema.jsonValue(), "key": list(state.key), "batches": dict(state.batches), "reset": False, "entries": table}
        self.storage.publish_text(f"_log/{state.number:08d}.checkpoint.json", json.dumps(head))
