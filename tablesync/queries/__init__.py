from tablesync.queries import databases, file_logs, history, loads, rows, state, windows  # noqa: F401 - they register
from tablesync.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
