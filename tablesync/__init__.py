"""Replicate and reconcile tables with Spark."""

from tablesync.connections import Database, Files, JdbcConnection, Tables
from tablesync.errors import (
    ConcurrentWriteError, ConfigError, DuplicateKeyError, ExtractError, LoadError, SyncError,
    TransformError,
)
from tablesync.plans.runlog import RunLog
from tablesync.plans.sync import SyncResult, extract, load, load_slice, report, run, sync_table
from tablesync.sources import FrameSource
from tablesync.spec import Project, Settings, Slice, SyncJob, TableSpec
from tablesync.streaming import ingest_available
from tablesync.targets import FileTarget, JdbcTarget, Layout, TableTarget

__all__ = [
    "ConcurrentWriteError", "ConfigError", "Database", "DuplicateKeyError", "ExtractError",
    "FileTarget", "Files", "FrameSource", "JdbcConnection", "JdbcTarget", "Layout", "LoadError", "Project",
    "RunLog", "Settings", "Slice", "SyncError", "SyncJob", "SyncResult", "TableSpec",
    "TableTarget", "Tables", "TransformError", "extract", "ingest_available", "load",
    "load_slice", "report", "run", "sync_table",
]
