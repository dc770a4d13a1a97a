"""One small file that says what a store of many tables currently consists of."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


class Manifest:
    """A JSON file that is replaced as a whole.

    Runs write new folders beside the old ones; readers only follow the manifest, so they see
    all tables of a finished run or none of it. The new text is written beside the file and
    renamed over it, by the file system that the path belongs to.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _at(self, path: str):
        jvm = self.spark.sparkContext._jvm
        place = jvm.org.apache.hadoop.fs.Path(path)
        return place, place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def read(self) -> dict | None:
        """The content, or None before the first run."""
        place, files = self._at(self.path)
        if not files.exists(place):
            return None
        return json.loads(self.spark.read.text(self.path, wholetext=True).first().value)

    def replace(self, content: dict) -> None:
        jvm, gateway = self.spark.sparkContext._jvm, self.spark.sparkContext._gateway
        place, _ = self._at(self.path)
        draft, files = self._at(f"{self.path}.{uuid.uuid4().hex}")
        stream = files.create(draft, True)
        stream.write(bytearray(json.dumps(content, sort_keys=True).encode()))
        stream.close()
        how = gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        how[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            files.makeQualified(place).toUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        context.rename(draft, place, how)
