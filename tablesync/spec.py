"""What to replicate: tables, jobs, settings, and the slice an extract returns."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from datetime import timedelta
from typing import Any

from pyspark.sql import DataFrame

from tablesync.errors import ConfigError

# Fixed option values.
REPLICATION_METHODS = ("full", "incremental")
ITERATE_TYPES = ("int", "datetime")
WRITE_STRATEGIES = ("append", "replace", "upsert", "merge")
IF_EXISTS = ("replace", "append")
COLUMN_CASES = ("lower", "upper", "as_is")
DUPLICATE_POLICIES = ("error", "latest")
SCHEMA_EVOLUTIONS = ("merge", "strict")
UPSERT_UNITS = ("slots", "files", "marks", "buckets")


def _one_of(option: str, value: Any, allowed: Sequence[str], optional: bool = False) -> None:
    if value is None and optional:
        return
    if value not in allowed:
        raise ConfigError(f"{option}={value!r}: expected one of {', '.join(allowed)}")


@dataclass(frozen=True)
class TableSpec:
    """One table to replicate. Only ``name`` and ``target_name`` are required.

    ``iterate_column`` is a column, a SQL expression, or a list of either; a
    list means a row is new when any of them passes the last point.
    """

    name: str
    target_name: str
    replication_method: str = "full"
    iterate_column: str | Sequence[str] | None = None
    iterate_column_type: str | None = None
    filter_lower_bound: int | str | None = None
    filter_upper_bound: int | str | None = None
    partitions_column: str | None = None
    partitions_column_type: str | None = None
    partitions_count: int = 10
    partitions_lower_bound: int | str | None = None
    partitions_upper_bound: int | str | None = None
    partitions_bounds_filtered: bool = False
    fetchsize: int = 100_000
    batchsize: int = 10_000
    write_partitions: int | None = None
    custom_query: str | None = None
    custom_query_file: str | None = None
    transform: Callable[[DataFrame], DataFrame] | str | None = None
    tags: Sequence[str] = ()
    pass_on_error: bool = False
    dedup_columns: Sequence[str] | None = None
    write_strategy: str | None = None
    write_key: Sequence[str] | None = None
    duplicate_keys: str = "error"
    order_column: str | None = None
    if_exists: str | None = None
    column_name_case: str | None = None
    partition_by: Sequence[str] = ()
    sort_by: Sequence[str] = ()
    cluster_by: Sequence[str] = ()
    key_buckets: int = 0
    upsert_unit: str = "slots"
    schema_evolution: str = "merge"

    def __post_init__(self) -> None:
        _one_of("replication_method", self.replication_method, REPLICATION_METHODS)
        _one_of("write_strategy", self.write_strategy, WRITE_STRATEGIES, optional=True)
        _one_of("if_exists", self.if_exists, IF_EXISTS, optional=True)
        _one_of("column_name_case", self.column_name_case, COLUMN_CASES, optional=True)
        _one_of("duplicate_keys", self.duplicate_keys, DUPLICATE_POLICIES)
        _one_of("schema_evolution", self.schema_evolution, SCHEMA_EVOLUTIONS)
        _one_of("upsert_unit", self.upsert_unit, UPSERT_UNITS)
        if self.upsert_unit != "slots" and (self.partition_by or self.cluster_by or self.sort_by or (self.key_buckets and self.upsert_unit != "buckets")):
            raise ConfigError(f"{self.name}: upsert_unit {self.upsert_unit} takes no other layout")
        if self.upsert_unit == "buckets" and not (self.key_buckets and self.write_key):
            raise ConfigError(f"{self.name}: upsert_unit buckets needs key_buckets and write_key")
        if self.replication_method == "incremental":
            if not self.iterate_columns:
                raise ConfigError(f"{self.name}: incremental replication needs iterate_column")
            _one_of("iterate_column_type", self.iterate_column_type, ITERATE_TYPES)
        if self.write_strategy in ("upsert", "merge") and not self.write_key:
            raise ConfigError(f"{self.name}: write_strategy {self.write_strategy} needs write_key")
        if self.duplicate_keys == "latest" and not self.order_column:
            raise ConfigError(f"{self.name}: duplicate_keys='latest' needs order_column")
        if self.partitions_count < 1:
            raise ConfigError(f"{self.name}: partitions_count must be at least 1")

    @property
    def iterate_columns(self) -> tuple[str, ...]:
        if self.iterate_column is None:
            return ()
        if isinstance(self.iterate_column, str):
            return (self.iterate_column,)
        return tuple(self.iterate_column)

    @property
    def has_static_bounds(self) -> bool:
        return self.filter_lower_bound is not None or self.filter_upper_bound is not None

    def answers_to(self, name: str) -> bool:
        return name in (self.name, self.target_name)


@dataclass(frozen=True)
class Settings:
    """Defaults a table may override, and names of the audit columns.

    For readers that have it open, a file table keeps its last ``keep_states``
    states (0: all of them) and any that was the latest within ``keep_for``.
    """

    ingested_at_column: str = "_ingested_at"
    ingestion_id_column: str = "_row_id"
    column_name_case: str = "as_is"
    if_exists: str = "replace"
    keep_states: int = 2
    keep_for: timedelta = timedelta(days=7)

    def __post_init__(self) -> None:
        _one_of("column_name_case", self.column_name_case, COLUMN_CASES)
        _one_of("if_exists", self.if_exists, IF_EXISTS)

    def resolve(self, spec: TableSpec) -> TableSpec:
        """The table's own value where given, else the default from here."""
        return replace(
            spec,
            column_name_case=spec.column_name_case or self.column_name_case,
            if_exists=spec.if_exists or self.if_exists,
        )


@dataclass(frozen=True)
class SyncJob:
    """A named group of tables that go from one connection to another."""

    name: str
    source: str
    destination: str
    tables: Sequence[TableSpec]
    pass_on_error: bool = False


@dataclass(frozen=True)
class Project:
    """Jobs plus the connections they name. ``run_log`` is a folder all nodes see."""

    run_log: str
    connections: Mapping[str, Any] = field(default_factory=dict)
    jobs: Sequence[SyncJob] = ()
    settings: Settings = field(default_factory=Settings)
    base_dir: str | None = None

    def connection(self, name: str) -> Any:
        try:
            return self.connections[name]
        except KeyError:
            known = ", ".join(sorted(self.connections)) or "none"
            raise ConfigError(f"connection {name!r} is not defined (known: {known})") from None


@dataclass(frozen=True)
class Slice:
    """Rows to load. ``df`` is None when nothing is new.

    ``mode`` is ``overwrite`` or ``append``; ``high_water`` is the mark to store
    once the load has finished, or None to keep the stored one.
    """

    df: DataFrame | None
    mode: str
    high_water: str | None = None
