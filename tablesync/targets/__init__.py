from tablesync.targets.bucketed import BucketedTarget
from tablesync.targets.file_log import FileLogTarget
from tablesync.targets.files import FileTarget, Layout
from tablesync.targets.jdbc import JdbcTarget
from tablesync.targets.tables import TableTarget

__all__ = ["BucketedTarget", "FileLogTarget", "FileTarget", "JdbcTarget", "Layout", "TableTarget"]
