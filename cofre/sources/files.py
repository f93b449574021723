"""Small text files that several processes agree on: created once, or replaced as a whole."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Files:
    """Text files below ``base`` on any file system Spark can write.

    A file is written under another name and renamed, so nobody sees a part of it. On stores without a rename that fails
    when the target exists, only one process may create files of a folder at a time.
    """

    def __init__(self, spark: SparkSession, base: str):
        self.base = base
        self._gateway = spark.sparkContext._gateway
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._path = lambda name: hadoop.Path(f"{base}/{name}")
        self._system = hadoop.Path(base).getFileSystem(conf)
        base_path = self._system.makeQualified(hadoop.Path(base))
        self._context = hadoop.FileContext.getFileContext(base_path.toUri(), conf)
        self._rename = getattr(hadoop, "Options$Rename")
        self._to_text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString

    def _put(self, name: str, text: str, how) -> None:
        passing = self._path(f"_passing-{uuid.uuid4().hex}")
        out = self._system.create(passing, True)
        out.write(bytearray(text.encode()))
        out.close()
        options = self._gateway.new_array(self._rename, 1)
        options[0] = how
        try:
            self._context.rename(self._system.makeQualified(passing), self._system.makeQualified(self._path(name)), options)
        finally:
            self._system.delete(passing, False)

    def create(self, name: str, text: str) -> bool:
        """Write a file that isn't there yet; False when it is."""
        try:
            self._put(name, text, self._rename.NONE)
        except Py4JJavaError as error:
            if "FileAlreadyExistsException" in str(error.java_exception):
                return False
            raise
        return True

    def replace(self, name: str, text: str) -> None:
        """Write a file, in place of one of that name."""
        self._put(name, text, self._rename.OVERWRITE)

    def read(self, name: str) -> str | None:
        """Content of a file, None when there is none."""
        try:
            stream = self._system.open(self._path(name))
        except Py4JJavaError as error:
            if "FileNotFoundException" in str(error.java_exception):
                return None
            raise
        try:
            return self._to_text(stream, "UTF-8")
        finally:
            stream.close()
