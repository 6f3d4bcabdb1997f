"""Small files and folders on whatever file system Spark writes to."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Files:
    """File operations of the driver through Hadoop's file systems."""

    def __init__(self, spark: SparkSession):
        self._jvm = spark.sparkContext._jvm
        self._gateway = spark.sparkContext._gateway
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _open(self, path: str):
        place = self._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self._conf), place

    def names(self, folder: str) -> list[str]:
        """Names in a folder; none if there is no such folder."""
        system, place = self._open(folder)
        if not system.exists(place):
            return []
        return sorted(status.getPath().getName() for status in system.listStatus(place))

    def age(self, path: str) -> float:
        """Seconds since the last change of a file or folder."""
        system, place = self._open(path)
        return (self._jvm.System.currentTimeMillis() - system.getFileStatus(place).getModificationTime()) / 1000

    def read(self, path: str) -> str:
        system, place = self._open(path)
        stream = system.open(place)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, path: str, text: str) -> bool:
        """Make a file that readers see whole or not at all; False if there is one of this name already.

        The text is written beside it and renamed, which file systems do in one step and refuse if the
        target exists, so of several writers exactly one succeeds.
        """
        folder, name = path.rsplit("/", 1)
        draft = f"{folder}/.{name}.{uuid.uuid4().hex}"
        system, place = self._open(draft)
        out = system.create(place, False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        fs = self._jvm.org.apache.hadoop.fs
        context = fs.FileContext.getFileContext(system.getUri(), self._conf)
        plain = self._gateway.new_array(getattr(fs, "Options$Rename"), 0)
        try:
            context.rename(system.makeQualified(place), system.makeQualified(fs.Path(path)), plain)
        except Py4JJavaError as error:
            system.delete(place, False)
            if "FileAlreadyExistsException" in str(error.java_exception):
                return False
            raise
        return True

    def move(self, path: str, target: str) -> None:
        """Give a file another name; folders that lack are made."""
        system, place = self._open(path)
        end = self._jvm.org.apache.hadoop.fs.Path(target)
        system.mkdirs(end.getParent())
        if not system.rename(place, end):
            raise OSError(f"cannot move '{path}' to '{target}'")

    def delete(self, path: str) -> None:
        system, place = self._open(path)
        system.delete(place, True)
