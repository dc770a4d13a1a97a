"""Streaming jobs with replay-safe sinks.

Every sink writes one folder per micro-batch and replaces it when the batch is run again
after a failure, so a replay leaves the same table. Batches belong to the stream's identity, which
is stored with its checkpoint. Readers fold the batches of the current stream.
"""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.types import StructType

from wordloom.operators.lexicon import fold_ledger
from wordloom.operators.records import first_per_key
from wordloom.operators.textprep import text_tokens, word_count
from wordloom.sources.files import read_batches, read_or_empty, write_batch
from wordloom.sources.messages import latest_per_topic
from wordloom.sources.state import newer_than


def _start(stream: DataFrame, name: str, sink, checkpoint: str, every: str | None) -> StreamingQuery:
    writer = stream.writeStream.queryName(name).option("checkpointLocation", checkpoint).foreachBatch(sink)
    if every:
        return writer.trigger(processingTime=every).start()
    return writer.trigger(availableNow=True).start()


def parsed_values(log: DataFrame, schema: str) -> DataFrame:
    """Message values parsed by a declared schema; JSON nulls stay nulls."""
    return log.select("topic", "offset", "timestamp", F.from_json("value", schema).alias("result"))


def keep_rows(stream: DataFrame, table: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Append-only file sink, exactly once."""
    writer = (
        stream.writeStream.format("parquet").outputMode("append")
        .option("path", table).option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def _lineage(spark: SparkSession, table: str, checkpoint: str) -> str:
    """The folder of a table that a stream writes to, named by an identity kept with its checkpoint.

    A stream that lost its checkpoint reads its source anew, perhaps in other batches. It gets a
    new identity, so its batches do not mix with the old ones, and the table's pointer
    moves to it.
    """
    row = read_or_empty(spark, f"{checkpoint}/identity", "id STRING").first()
    identity = row["id"] if row else uuid.uuid4().hex
    if not row:
        named = spark.createDataFrame([(identity,)], "id STRING").coalesce(1)
        named.write.mode("overwrite").parquet(f"{checkpoint}/identity")
        named.write.mode("overwrite").parquet(f"{table}/_current")
    return f"{table}/stream={identity}"


def _current(spark: SparkSession, table: str) -> str | None:
    row = read_or_empty(spark, f"{table}/_current", "id STRING").first()
    return f"{table}/stream={row['id']}" if row else None


def _finished(spark: SparkSession, table: str, schema: str) -> DataFrame:
    """All rows of the table's current stream: the folded batches and those after them."""
    folder = _current(spark, table)
    if folder is None:
        return spark.createDataFrame([], schema)
    upto = read_or_empty(spark, f"{folder}/_folds", "upto BIGINT").agg(F.max("upto")).first()[0]
    upto = -1 if upto is None else upto
    later = read_batches(spark, f"{folder}/batches", schema).where(F.col("batch_id").cast("bigint") > upto).drop("batch_id")
    return later if upto < 0 else later.unionByName(read_or_empty(spark, f"{folder}/_folded/{upto}", schema))


def _fold(spark: SparkSession, table: str, schema: str, fold) -> None:
    folder = _current(spark, table)
    if folder is None:
        return
    ids = read_batches(spark, f"{folder}/batches", schema).select(F.col("batch_id").cast("bigint").alias("id"))
    newest = ids.agg(F.max("id")).first()[0]
    before = ids.where(F.col("id") < newest).agg(F.max("id")).first()[0] if newest is not None else None
    done = read_or_empty(spark, f"{folder}/_folds", "upto BIGINT").agg(F.max("upto")).first()[0]
    if before is None or (done is not None and before <= done):
        return
    rows = read_batches(spark, f"{folder}/batches", schema).where(
        (F.col("batch_id").cast("bigint") <= before) & (F.col("batch_id").cast("bigint") > (-1 if done is None else done))
    ).drop("batch_id")
    if done is not None:
        rows = rows.unionByName(read_or_empty(spark, f"{folder}/_folded/{done}", schema))
    fold(rows).write.mode("overwrite").parquet(f"{folder}/_folded/{before}")
    spark.createDataFrame([(before,)], "upto BIGINT").coalesce(1).write.mode("append").parquet(f"{folder}/_folds")


def keep_latest(log: DataFrame, table: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Latest message per topic. ``every`` keeps it running; without, it ends at the log's end."""
    folder = _lineage(log.sparkSession, table, checkpoint)

    def sink(batch: DataFrame, batch_id: int) -> None:
        write_batch(latest_per_topic(batch), f"{folder}/batches", batch_id)

    return _start(log, "keep_latest", sink, checkpoint, every)


def read_latest(spark: SparkSession, table: str, schema: str) -> DataFrame:
    return latest_per_topic(_finished(spark, table, schema))


def fold_latest(spark: SparkSession, table: str, schema: str) -> None:
    """Put the finished batches into one, so that readers do not read ever more of them.

    The newest batch stays, as a restarted stream may write it again.
    """
    _fold(spark, table, schema, latest_per_topic)


class _Ending(StreamingQueryListener):
    """Ends a query when its sink has enough rows, or when no row came for a while."""

    def __init__(self, clock=time.monotonic):
        self.clock, self.run, self.last, self.enough = clock, None, clock(), threading.Event()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        if str(event.progress.runId) == self.run and event.progress.numInputRows:
            self.last = self.clock()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def consume(log: DataFrame, table: str, checkpoint: str, records: int | None = None, idle: float | None = None,
            every: str = "1 second") -> int:
    """Read a log until the table has ``records`` messages, or until none came for ``idle`` seconds.

    Returns how many the table then has for a reader (``read_consumed``). Batches are written whole, and the
    reader cuts inside the last one, so a later call that asks for more goes on exactly where this one ended.
    """
    if records is None and idle is None:
        raise ValueError("say records or idle, or the stream never ends")
    spark = log.sparkSession
    folder, ending = _lineage(spark, table, checkpoint), _Ending()

    def sink(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, f"{folder}/batches", batch_id)
        if records is not None and _taken(spark, folder, batch.schema) >= records:
            ending.enough.set()

    if records is not None and _taken(spark, folder, log.schema) >= records:
        return records
    spark.streams.addListener(ending)
    query = _start(log, "consume", sink, checkpoint, every)
    ending.run = str(query.runId)
    ending.last = ending.clock()
    try:
        while query.isActive and not ending.enough.wait(0.2):
            if idle is not None and ending.clock() - ending.last > idle:
                break
        if query.isActive:
            query.stop()
        elif query.exception():
            raise query.exception()
    finally:
        spark.streams.removeListener(ending)
    taken = _taken(spark, folder, log.schema)
    return taken if records is None else min(taken, records)


def _taken(spark: SparkSession, folder: str, schema: StructType) -> int:
    return read_batches(spark, f"{folder}/batches", _ddl(schema)).count()


def _ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)


def read_consumed(spark: SparkSession, table: str, schema: str, records: int | None = None) -> DataFrame:
    """What ``consume`` has taken: all, or the first ``records`` by batch, topic, partition and offset."""
    folder = _current(spark, table)
    if folder is None:
        return spark.createDataFrame([], schema)
    rows = read_batches(spark, f"{folder}/batches", schema)
    if records is not None:
        rows = rows.orderBy(F.col("batch_id").cast("bigint"), "topic", "partition", "offset").limit(records)
    return rows.drop("batch_id")


COUNTS = "word STRING, count BIGINT"


def count_words(stream: DataFrame, text: str, table: str, checkpoint: str,
                every: str | None = None, key: str | None = None) -> StreamingQuery:
    """Word counts of a feed as a ledger of (batch, word, count).

    With ``key``, rows whose key an earlier batch or row had are not counted again. The keys of
    every batch are stored before its counts and compared with those of earlier batches only,
    so a batch that is run again gives the same.
    """
    folder = _lineage(stream.sparkSession, table, checkpoint)

    def sink(batch: DataFrame, batch_id: int) -> None:
        if key:
            name = f"{key} {batch.schema[key].dataType.simpleString()}"
            seen = read_batches(batch.sparkSession, f"{folder}/keys", name).where(
                F.col("batch_id").cast("bigint") < batch_id).select(key).distinct()
            batch = first_per_key(batch.select(key, text), key, F.col(text)).join(seen, key, "left_anti")
            write_batch(batch.select(key), f"{folder}/keys", batch_id)
        write_batch(word_count(text_tokens(batch, text)), f"{folder}/batches", batch_id)

    return _start(stream, "count_words", sink, checkpoint, every)


def read_counts(spark: SparkSession, table: str) -> DataFrame:
    return fold_ledger(_finished(spark, table, COUNTS))


def fold_counts(spark: SparkSession, table: str) -> None:
    """Put the finished batches of counts into one; the newest stays, as it may be written again."""
    _fold(spark, table, COUNTS, fold_ledger)


def first_sightings(stream: DataFrame, time: str, since, keys: Sequence[str], delay: str) -> DataFrame:
    """Items newer than the mark, each key once within the watermark delay.

    State holds one entry per key and is dropped once the watermark has passed.
    """
    return (
        newer_than(stream, time, since).withWatermark(time, delay)
        .dropDuplicatesWithinWatermark(list(keys)).select(*keys)
    )


def as_log(stream: DataFrame, topic: Column, offset: Column, timestamp: Column, value: Column) -> DataFrame:
    """Any feed as a message log."""
    return stream.select(
        topic.alias("topic"), F.lit(0).alias("partition"), offset.cast("bigint").alias("offset"),
        timestamp.cast("timestamp").alias("timestamp"), value.alias("value"),
    )
