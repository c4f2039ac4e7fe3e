from tablesync.streaming.ingest import ingest_available

__all__ = ["ingest_available"]
