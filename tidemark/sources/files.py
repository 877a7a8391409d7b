"""Small files and folders on whatever store the session's paths name."""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Folder:
    """A folder, seen through Hadoop's file API, which knows every store that Spark can write to."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.path = path.rstrip("/")
        self._fs = self._at().getFileSystem(conf)
        self._context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), conf)
        self._no_options = spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0)

    def _at(self, name: str = ""):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def exists(self, name: str = "") -> bool:
        return self._fs.exists(self._at(name))

    def names(self) -> list[str]:
        """What lies directly in the folder; nothing if there is no folder."""
        if not self.exists():
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._at()))

    def bytes(self, name: str = "") -> int:
        return self._fs.getContentSummary(self._at(name)).getLength()

    def changed_before(self, name: str, moment: datetime) -> bool:
        return self._fs.getFileStatus(self._at(name)).getModificationTime() < moment.timestamp() * 1000

    def read(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """Put a whole file in place, unless there is one of that name: then False, and nothing changed.

        It is written aside and renamed, so nobody sees a part of it.  On a store that renames at once,
        as HDFS does, only one of several writers succeeds.
        """
        aside = f".{name}.{uuid.uuid4().hex}"
        self._fs.mkdirs(self._at())
        stream = self._fs.create(self._at(aside), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        try:
            self._context.rename(self._at(aside), self._at(name), self._no_options)
        except Py4JJavaError as error:
            self._fs.delete(self._at(aside), False)
            if error.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
                return False
            raise
        return True

    def remove(self, name: str) -> None:
        self._fs.delete(self._at(name), True)

    def remove_old(self, older_than: timedelta, keep: set[str] = frozenset()) -> list[str]:
        """Remove what has not changed for that long, other than ``keep``; the names removed."""
        before = datetime.now() - older_than
        old = [n for n in self.names() if n not in keep and self.changed_before(n, before)]
        for name in old:
            self.remove(name)
        return old
