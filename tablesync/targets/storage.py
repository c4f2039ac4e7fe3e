"""The few file operations a target needs, on whatever file system Hadoop knows."""

from __future__ import annotations

import time
import uuid
from datetime import timedelta

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Storage:
    """Paths are relative to ``root``, which all nodes must see."""

    def __init__(self, spark: SparkSession, root: str):
        self.root = root.rstrip("/")
        self._jvm = spark._jvm
        self._fs = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def full(self, relative: str) -> str:
        return f"{self.root}/{relative}" if relative else self.root

    def _path(self, relative: str):
        return self._jvm.org.apache.hadoop.fs.Path(self.full(relative))

    def exists(self, relative: str) -> bool:
        return self._fs.exists(self._path(relative))

    def names(self, relative: str) -> list[str]:
        """Names directly under a folder; none when the folder is absent."""
        if not self.exists(relative):
            return []
        return [status.getPath().getName() for status in self._fs.listStatus(self._path(relative))]

    def age(self, relative: str) -> timedelta:
        """Time since the last change of a folder's listing."""
        changed = self._fs.getFileStatus(self._path(relative)).getModificationTime()
        return timedelta(seconds=time.time() - changed / 1000)

    def folders(self, relative: str, depth: int) -> list[str]:
        """Folders ``depth`` levels down, relative to ``relative``."""
        if depth == 0:
            return [""]
        base = self._fs.makeQualified(self._path(relative)).toString()
        found = self._fs.globStatus(self._path(relative + "/*=*" * depth)) or []
        return sorted(
            status.getPath().toString()[len(base) + 1:] for status in found if status.isDirectory()
        )

    def size(self, relative: str) -> int:
        return self._fs.getContentSummary(self._path(relative)).getLength()

    def read_text(self, relative: str) -> str:
        try:
            stream = self._fs.open(self._path(relative))
        except Py4JJavaError as problem:
            if "FileNotFoundException" in problem.java_exception.getClass().getName():
                raise FileNotFoundError(self.full(relative)) from problem
            raise
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def publish_text(self, relative: str, text: str) -> bool:
        """Write a new file in one step; False when the name is taken."""
        if self.exists(relative):
            return False
        draft = f"{relative}.{uuid.uuid4().hex}.tmp"
        stream = self._fs.create(self._path(draft), False)
        try:
            stream.write(text.encode("utf-8"))
        finally:
            stream.close()
        if self._fs.rename(self._path(draft), self._path(relative)):
            return True
        self._fs.delete(self._path(draft), False)
        return False

    def delete(self, relative: str) -> None:
        self._fs.delete(self._path(relative), True)
