"""Tables of the session's catalog."""

from __future__ import annotations

import threading
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tablesync.errors import ConfigError
from tablesync.functions.schema import fitted, merged_schema
from tablesync.session import narrowed


_overwriting = threading.Lock()


class TableTarget:
    """Append, replace, and truncate-and-insert.

    The plain file formats of a catalog have no row-level changes, so upsert and
    merge are refused here; ``FileTarget`` offers them.
    """

    def __init__(
        self, spark: SparkSession, name: str, *, format: str = "parquet",
        partition_by: Sequence[str] = (), write_partitions: int | None = None, schema_evolution: str = "strict",
    ):
        self.spark = spark
        self.name = name
        self.format = format
        self.partition_by = tuple(partition_by)
        self.write_partitions = write_partitions
        self.schema_evolution = schema_evolution

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def _narrowed(self, df: DataFrame) -> DataFrame:
        return narrowed(df, self.write_partitions) if self.write_partitions else df

    def _fitted(self, df: DataFrame) -> DataFrame:
        schema = self.read().schema
        known = {c.lower() for c in schema.names}
        new = [f for f in df.schema if f.name.lower() not in known]
        if new and self.schema_evolution == "merge":  # the catalog adds columns, but changes no types
            added = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in new)
            self.spark.sql(f"ALTER TABLE {self.name} ADD COLUMNS ({added})")
            schema = self.read().schema
        merged_schema(schema, df.schema, "strict")
        return self._narrowed(fitted(df, schema))

    def append(self, df: DataFrame) -> None:
        if self.exists():
            self._fitted(df).write.insertInto(self.name)
        else:
            self.replace(df)

    def replace(self, df: DataFrame) -> None:
        writer = self._narrowed(df).write.format(self.format).mode("overwrite")
        if self.partition_by:
            writer = writer.partitionBy(*self.partition_by)
        writer.saveAsTable(self.name)

    def truncate_insert(self, df: DataFrame) -> None:
        if self.exists():
            self._overwritten(self._fitted(df))
        else:
            self.replace(df)

    def _overwritten(self, rows: DataFrame) -> None:
        """All old rows go, also those in partitions without a new one, whatever the session's overwrite mode."""
        name = "spark.sql.sources.partitionOverwriteMode"
        with _overwriting:  # the mode is read from the session, which threads share
            mode = self.spark.conf.get(name)
            self.spark.conf.set(name, "static")
            try:
                rows.write.insertInto(self.name, overwrite=True)
            finally:
                self.spark.conf.set(name, mode)

    def upsert(self, df: DataFrame, key: Sequence[str], **_: object) -> None:
        raise ConfigError(f"{self.name}: a catalog table of format {self.format} takes no upsert or merge")

    merge = upsert
