"""Connections a project names: where rows come from and where they go.

Each has ``extract`` (read a slice) and ``target`` (open a table to write).
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tablesync.errors import ConfigError
from tablesync.sources.frames import FileSource, TableSource
from tablesync.sources.jdbc import JdbcConnection, JdbcSource
from tablesync.spec import TableSpec
from tablesync.targets import BucketedTarget, FileLogTarget, FileTarget, JdbcTarget, Layout, TableTarget


@dataclass(frozen=True)
class Files(FileSource):
    """A folder of files, as source and as destination.

    A table this library wrote is read by its published state, so that one
    job's target can be another's source.
    """

    write_options: Mapping[str, str] = field(default_factory=dict)

    def frame(self, spark: SparkSession, name: str) -> DataFrame:
        logged = FileLogTarget(spark, f"{self.path.rstrip('/')}/{name}")
        if logged.exists():
            return logged.read()
        stored = FileTarget(
            spark, f"{self.path.rstrip('/')}/{name}", format=self.format, options=self.options
        )
        return stored.read() if stored.exists() else super().frame(spark, name)

    def target(self, spark: SparkSession, spec: TableSpec) -> FileTarget | FileLogTarget:
        key = tuple(spec.write_key or ())
        if spec.upsert_unit != "slots":
            if self.format != "parquet":
                raise ConfigError(f"{spec.name}: upsert_unit {spec.upsert_unit} needs parquet files")
            if spec.upsert_unit == "buckets":
                return BucketedTarget(
                    spark, f"{self.path.rstrip('/')}/{spec.target_name}", key=key, buckets=spec.key_buckets,
                    options={**self.options, **self.write_options}, schema_evolution=spec.schema_evolution)
            return FileLogTarget(
                spark, f"{self.path.rstrip('/')}/{spec.target_name}", key=key, upsert={"files": "rewrite", "marks": "mark"}[spec.upsert_unit],
                schema_evolution=spec.schema_evolution, write_partitions=spec.write_partitions)
        return FileTarget(
            spark, f"{self.path.rstrip('/')}/{spec.target_name}", format=self.format,
            options={**self.options, **self.write_options},
            layout=Layout(
                tuple(spec.partition_by), tuple(spec.sort_by), tuple(spec.cluster_by),
                spec.key_buckets, key if spec.key_buckets else (),
            ),
            schema_evolution=spec.schema_evolution, write_partitions=spec.write_partitions,
        )


def _refuse(spec: TableSpec, kind: str, *names: str) -> None:
    """An option that would be dropped in silence is an error."""
    given = [name for name in names if getattr(spec, name)]
    if given:
        raise ConfigError(f"{spec.name}: {kind} take no {', '.join(given)}")


@dataclass(frozen=True)
class Tables(TableSource):
    """The session's catalog."""

    format: str = "parquet"

    def target(self, spark: SparkSession, spec: TableSpec) -> TableTarget:
        _refuse(spec, "catalog tables", "sort_by", "cluster_by", "key_buckets")
        return TableTarget(
            spark, spec.target_name, format=self.format, partition_by=spec.partition_by,
            write_partitions=spec.write_partitions, schema_evolution=spec.schema_evolution,
        )


@dataclass(frozen=True)
class Database(JdbcSource):
    """A database reached through JDBC. ``column_types`` gives, per target name
    and column, the SQL type where Spark's choice does not fit."""

    column_types: Mapping[str, Mapping[str, str]] = field(default_factory=dict)

    def target(self, spark: SparkSession, spec: TableSpec) -> JdbcTarget:
        _refuse(spec, "databases", "partition_by", "sort_by", "cluster_by", "key_buckets")
        return JdbcTarget(
            spark, self.connection, spec.target_name, batchsize=spec.batchsize,
            write_partitions=spec.write_partitions,
            column_types=self.column_types.get(spec.target_name),
        )


__all__ = ["Database", "Files", "JdbcConnection", "Tables"]
