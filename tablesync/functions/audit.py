"""Columns added to every loaded row, and column naming."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from tablesync.errors import ConfigError


def resolve_columns(wanted: Iterable[str], columns: Sequence[str]) -> list[str]:
    """The actual spelling of each wanted column; names match in any case."""
    by_lower: dict[str, list[str]] = {}
    for column in columns:
        by_lower.setdefault(column.lower(), []).append(column)
    resolved = []
    for name in wanted:
        matches = by_lower.get(name.lower(), [])
        if name in matches:
            resolved.append(name)
        elif len(matches) == 1:
            resolved.append(matches[0])
        else:
            problem = "is ambiguous" if matches else "does not exist"
            raise ConfigError(f"column {name!r} {problem}; columns are {', '.join(columns)}")
    return resolved


def quoted(name: str) -> Column:
    """The column of exactly this name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def row_id(columns: Sequence[str]) -> Column:
    """64-bit content hash. NULL counts as the empty string, so that a NULL in
    one column cannot shift the values of the next."""
    return F.xxhash64(*[F.coalesce(quoted(c).cast("string"), F.lit("")) for c in columns])


def ingestion_time(moment: datetime) -> Column:
    """A timestamp literal; a naive ``moment`` is wall-clock in the session's zone."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp")


def with_audit_columns(
    df: DataFrame,
    moment: datetime,
    dedup_columns: Sequence[str] | None = None,
    ingested_at_column: str = "_ingested_at",
    ingestion_id_column: str = "_row_id",
) -> DataFrame:
    """Add the ingestion time and, for ``dedup_columns``, the content hash."""
    hashed = resolve_columns(dedup_columns or (), df.columns)
    added = {ingested_at_column: ingestion_time(moment)}
    if hashed:
        added[ingestion_id_column] = row_id(hashed)
    taken = {name.lower() for name in added}
    kept = [quoted(c) for c in df.columns if c.lower() not in taken]
    return df.select(*kept, *[value.alias(name) for name, value in added.items()])


def with_column_case(df: DataFrame, case: str = "as_is") -> DataFrame:
    """All column names in lower or upper case; names that would clash are refused."""
    if case == "as_is":
        return df
    if case not in ("lower", "upper"):
        raise ConfigError(f"column_name_case={case!r}: expected lower, upper or as_is")
    renamed = [c.lower() if case == "lower" else c.upper() for c in df.columns]
    clashes = sorted({name for name in renamed if renamed.count(name) > 1})
    if clashes:
        raise ConfigError(f"columns clash in {case} case: {', '.join(clashes)}")
    return df.toDF(*renamed)
