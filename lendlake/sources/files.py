"""Small driver-side file operations through Hadoop's file systems, so that they
work wherever Spark itself reads and writes."""

from __future__ import annotations

import posixpath
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Conflict(RuntimeError):
    """Another writer took the name first."""


class Files:
    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark.sparkContext._jvm
        self._hadoop = self._jvm.org.apache.hadoop
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path(root).getFileSystem(self._conf)

    def _path(self, path: str):
        return self._hadoop.fs.Path(path)

    def names(self, folder: str) -> list[str]:
        """Names in a folder, sorted; none if it isn't there."""
        path = self._path(folder)
        if not self._fs.exists(path):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(path))

    def lengths(self, folder: str) -> dict[str, int]:
        """Bytes of each file in a folder."""
        listed = self._fs.listStatus(self._path(folder))
        return {s.getPath().getName(): s.getLen() for s in listed if s.isFile()}

    def read_text(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, path: str, text: str) -> None:
        """A new file with its whole content at once: written beside its place,
        then renamed without overwriting. Raises Conflict if the name is taken."""
        folder, name = posixpath.split(path)
        beside = self._path(posixpath.join(folder, f".{name}-{uuid.uuid4().hex}"))
        stream = self._fs.create(beside, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        context = self._hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._conf)
        none = self._jvm.java.lang.reflect.Array.newInstance(
            self._jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 0
        )
        try:
            context.rename(self._fs.makeQualified(beside), self._fs.makeQualified(self._path(path)), none)
        except Py4JJavaError as e:
            self._fs.delete(beside, False)
            if "FileAlreadyExistsException" in str(e.java_exception.getClass()):
                raise Conflict(path) from None
            raise

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)
