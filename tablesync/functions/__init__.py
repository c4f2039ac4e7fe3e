from tablesync.functions.audit import (
    ingestion_time, resolve_columns, row_id, with_audit_columns, with_column_case,
)
from tablesync.functions.window import (
    Window, format_point, in_window, parse_point, slice_bounds, split_alias, window_for,
)

__all__ = [
    "Window", "format_point", "in_window", "ingestion_time", "parse_point", "resolve_columns",
    "row_id", "slice_bounds", "split_alias", "window_for", "with_audit_columns", "with_column_case",
]
