"""Custom source queries and the place they keep for the range condition."""

from __future__ import annotations

import os

from tablesync.errors import ConfigError
from tablesync.spec import TableSpec

QUERY_FILTER = "{query_filter}"


def query_text(spec: TableSpec, base_dir: str | None = None) -> str | None:
    """The custom query: inline text first, then the file, relative to ``base_dir``."""
    if spec.custom_query:
        return spec.custom_query
    if not spec.custom_query_file:
        return None
    path = spec.custom_query_file
    if not os.path.isabs(path):
        if base_dir is None:
            raise ConfigError(f"{spec.name}: a relative custom_query_file needs a base directory")
        path = os.path.join(base_dir, path)
    with open(path, encoding="utf-8") as handle:
        return handle.read()


def filled_query(spec: TableSpec, query: str, condition: str | None) -> str:
    """Put the range condition where the query asks for it."""
    if QUERY_FILTER not in query and spec.replication_method == "incremental":
        raise ConfigError(f"{spec.name}: an incremental custom query needs {QUERY_FILTER}")
    return query.replace(QUERY_FILTER, f" WHERE {condition or '1=1'} ")
