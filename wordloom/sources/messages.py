"""Topic messages as tables and streams.

A message log is any DataFrame with ``topic, partition, offset, timestamp, value``. With
the Kafka connector on the class path ``read_log`` and ``write_log`` use it; without it
the same calls work on JSON files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wordloom.sources.schemas import MESSAGE

_LOG_COLUMNS = ("topic", "partition", "offset", "timestamp")


def read_log(spark: SparkSession, fmt: str, path: str | None = None, **options: str) -> DataFrame:
    """Message log in batch mode; the value comes as text."""
    if fmt == "kafka":
        raw = spark.read.format("kafka").options(**options).load()
        return raw.select(*_LOG_COLUMNS, F.col("value").cast("string").alias("value"))
    return spark.read.schema(MESSAGE).format(fmt).options(**options).load(path)


def stream_log(spark: SparkSession, fmt: str, path: str | None = None, **options: str) -> DataFrame:
    """Message log as a stream from its earliest offset."""
    if fmt == "kafka":
        raw = (
            spark.readStream.format("kafka").options(**{"startingOffsets": "earliest", **options}).load()
        )
        return raw.select(*_LOG_COLUMNS, F.col("value").cast("string").alias("value"))
    return spark.readStream.schema(MESSAGE).format(fmt).options(**options).load(path)


def as_messages(rows: DataFrame, topic: str | Column, partition: int = 0) -> DataFrame:
    """One JSON message per row."""
    topic = F.lit(topic) if isinstance(topic, str) else topic
    return rows.select(
        topic.alias("topic"),
        F.lit(partition).alias("partition"),
        F.to_json(F.struct(*[F.col(c) for c in rows.columns])).alias("value"),
    )


def write_log(messages: DataFrame, fmt: str, path: str | None = None, **options: str) -> None:
    messages.write.format(fmt).mode("append").options(**options).save(path)


def latest_per_topic(log: DataFrame, by: Sequence[str] = ("topic",)) -> DataFrame:
    """Last message of each topic (and partition, where asked); an empty topic has none.

    ``max_by`` combines map-side, so a topic with most of the rows costs no more.
    """
    rest = [c for c in log.columns if c not in by and c != "offset"]
    last = F.max_by(F.struct("offset", *rest), "offset").alias("m")
    return log.groupBy(*by).agg(last).select(*by, "m.*")


def first_n_per_topic(log: DataFrame, n: int) -> DataFrame:
    """The first ``n`` messages of each topic by offset.

    The rank filter is applied on the map side too, so each task sends at most ``n``
    rows per topic to the shuffle.
    """
    rank = F.row_number().over(Window.partitionBy("topic").orderBy("offset"))
    return log.withColumn("rank", rank).where(F.col("rank") <= n)
