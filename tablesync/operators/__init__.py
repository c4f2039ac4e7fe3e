from tablesync.operators.dedup import key_violations, latest_per_key
from tablesync.operators.merge import fresh_rows, merge_columns, upsert_rows

__all__ = ["fresh_rows", "key_violations", "latest_per_key", "merge_columns", "upsert_rows"]
