"""Numbered versions of a small JSON description, of which only one writer can make each."""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

#: Descriptions that stay behind the current one.
KEPT = 10


class Versions:
    """Files 000000000001.json and on under a folder; the greatest number is the current one.

    A version is written beside the others and renamed to its number, which Hadoop's file systems refuse if the
    number is taken: of two writers that read the same version, one makes the next and the other is told.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _path(self, name: str):  # noqa: ANN202
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _numbers(self) -> list[int]:
        path, fs = self._path("")
        if not fs.exists(path):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(path)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n.removesuffix(".json").isdigit())

    def current(self) -> tuple[int, dict]:
        """The current number and description; 0 and an empty one if there is none."""
        numbers = self._numbers()
        if not numbers:
            return 0, {}
        path, fs = self._path(f"{numbers[-1]:012d}.json")
        stream = fs.open(path)
        try:
            return numbers[-1], json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def made(self, number: int, description: dict) -> bool:
        """Makes this version; False if another writer has."""
        target, fs = self._path(f"{number:012d}.json")
        own, _ = self._path(f".{uuid.uuid4().hex}")
        stream = fs.create(own, False)
        stream.write(bytearray(json.dumps(description).encode()))
        stream.close()
        jvm = self.spark._jvm
        never = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self.spark._jsc.hadoopConfiguration()).rename(fs.makeQualified(own), fs.makeQualified(target), never)
        except Py4JJavaError as e:
            fs.delete(own, False)
            if "FileAlreadyExistsException" in str(e.java_exception):
                return False
            raise
        for old in self._numbers()[: -KEPT - 1]:
            fs.delete(self._path(f"{old:012d}.json")[0], False)
        return True
