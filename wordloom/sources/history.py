"""Keys of all batches so far, stored so that a new batch finds its own without moving them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.sources.files import read_or_empty

BUCKETS = 64


class History:
    """A table of ``key, batch_id`` below a folder, partitioned by batch, bucketed and sorted by key.

    A batch is dealt out by the same buckets and joined where they lie, so only the batch is
    shuffled, however long the history is. Every batch replaces its own partition.
    """

    def __init__(self, spark: SparkSession, folder: str, name: str, key: str = "url", buckets: int = BUCKETS):
        self.spark, self.folder, self.name, self.key = spark, folder, name, key
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({key} STRING, batch_id STRING) USING parquet PARTITIONED BY (batch_id) "
            f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS LOCATION '{folder}'")
        if not read_or_empty(spark, folder, f"{key} STRING, batch_id STRING").isEmpty():
            spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")  # of batches that other sessions wrote

    def keys(self) -> DataFrame:
        return self.spark.table(self.name)

    def unseen(self, rows: DataFrame, batches: Sequence[str]) -> DataFrame:
        """Rows whose key none of the given batches has; rows with a null key always pass."""
        earlier = self.keys().where(F.col("batch_id").isin(*[str(b) for b in batches])).select(self.key)
        return rows.join(earlier.hint("merge"), self.key, "left_anti")

    def record(self, rows: DataFrame, batch_id: str) -> None:
        """Replace one batch's keys; doing it again changes nothing."""
        keys = rows.where(F.col(self.key).isNotNull()).select(self.key).distinct()
        view = f"_{self.name}_batch"
        keys.createOrReplaceTempView(view)
        self.spark.sql(f"INSERT OVERWRITE TABLE {self.name} PARTITION (batch_id = '{batch_id}') SELECT {self.key} FROM {view}")
        self.spark.catalog.dropTempView(view)
