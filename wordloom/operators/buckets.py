"""Tables in hashed buckets: an upsert reads and replaces only the buckets its rows fall in."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.session import staged

BUCKET = "_bucket"


@dataclass(frozen=True)
class BucketTable:
    """Where each bucket of a table lies; a bucket without a folder is empty.

    A table is a value: an upsert writes new folders and gives a new table, and who still has the
    old one reads the old rows. ``paths`` is small (one entry per bucket) and goes into a manifest.
    """

    spark: SparkSession
    schema: str
    key: tuple[str, ...]
    buckets: int
    paths: dict[str, str] = field(default_factory=dict)

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("string")

    def read(self, only: Sequence[str] | None = None) -> DataFrame:
        paths = [p for b, p in self.paths.items() if only is None or b in only]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def upsert(self, new: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame], folder: str) -> "BucketTable":
        """``merge(old rows of the buckets that are hit, new rows)`` becomes these buckets' rows, below ``folder``."""
        new = staged(new.select(*[c for c in new.columns]), "upsert")
        hit = sorted(r[0] for r in new.select(self.bucket()).distinct().collect())
        if not hit:
            return self
        columns = self.spark.createDataFrame([], self.schema).columns
        rows = merge(self.read(hit), new).select(*columns).withColumn(BUCKET, self.bucket())
        rows.repartition(len(hit), BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(folder)
        moved = {b: f"{folder}/{BUCKET}={b}" for b in hit}
        return BucketTable(self.spark, self.schema, self.key, self.buckets, {**self.paths, **moved})
