from tablesync.sources.frames import FileSource, FrameSource, TableSource, frame_slice, query_slice
from tablesync.sources.jdbc import JdbcConnection, JdbcSource

__all__ = ["FileSource", "FrameSource", "JdbcConnection", "JdbcSource", "TableSource", "frame_slice", "query_slice"]
