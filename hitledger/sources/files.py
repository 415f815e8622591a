"""Small files in whatever file system Spark reads, for what has to appear at once or not."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Folder:
    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark.sparkContext._jvm
        self._gateway = spark.sparkContext._gateway
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.path = path.rstrip("/")
        self._files = self._at("").getFileSystem(self._conf)

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self) -> list[str]:
        """What is in the folder, in order; nothing if it isn't there."""
        found = self._files.globStatus(self._at("*"))
        return sorted(status.getPath().getName() for status in found or ())

    def read(self, name: str) -> str:
        stream = self._files.open(self._at(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def publish(self, name: str, text: str) -> bool:
        """The file with all its text, by a rename; false if there is one of that name."""
        draft = f".{name}.{uuid.uuid4().hex}"
        stream = self._files.create(self._at(draft), False)
        stream.write(bytearray(text.encode()))
        stream.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._at("").toUri(), self._conf)
        careful = self._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(self._at(draft), self._at(name), careful)
        except Py4JJavaError as problem:
            self.delete(draft)
            if "FileAlreadyExists" in problem.java_exception.getClass().getName():
                return False
            raise
        return True

    def delete(self, name: str) -> None:
        self._files.delete(self._at(name), True)
