"""Registered queries: streaming jobs run to the end of their input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.plans import standins as si
from wordloom.plans.oracle import with_ctes
from wordloom.session import work_folder
from wordloom.sources.schemas import MESSAGE
from wordloom.streaming import jobs

SINCE = "2024-01-15 00:00:00"
DELAY = "60 days"


def _stream(spark: SparkSession, sf: str, name: str) -> DataFrame:
    schema = si.table(spark, sf, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf}/{name}.parq*")


def _log(spark: SparkSession, sf: str) -> DataFrame:
    return jobs.as_log(
        _stream(spark, sf, "events"), F.col("event_type"), F.col("event_id"), F.col("ts"), F.col("props")
    )


def _wall_clock() -> Column:
    return F.col("timestamp").cast("timestamp_ntz").alias("timestamp")


def results(spark: SparkSession, sf: str) -> DataFrame:
    folder = work_folder(spark, "results")
    parsed = jobs.parsed_values(_log(spark, sf), "k INT").select("topic", "offset", _wall_clock(), "result.k")
    jobs.keep_rows(parsed, f"{folder}/rows", f"{folder}/checkpoint").awaitTermination()
    return spark.read.schema(parsed.schema).parquet(f"{folder}/rows")


def latest(spark: SparkSession, sf: str) -> DataFrame:
    folder = work_folder(spark, "latest")
    jobs.keep_latest(_log(spark, sf), f"{folder}/rows", f"{folder}/checkpoint").awaitTermination()
    return jobs.read_latest(spark, f"{folder}/rows", MESSAGE).select("topic", "offset", _wall_clock(), "value")


def incremental(spark: SparkSession, sf: str) -> DataFrame:
    folder = work_folder(spark, "incremental")
    since = F.lit(SINCE).cast("timestamp")
    timed = _stream(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    fresh = jobs.first_sightings(
        timed, "ts", since, ["event_type", "user_id"], DELAY
    )
    jobs.keep_rows(fresh, f"{folder}/rows", f"{folder}/checkpoint").awaitTermination()
    return spark.read.schema(fresh.schema).parquet(f"{folder}/rows")


def counted(spark: SparkSession, sf: str) -> DataFrame:
    folder = work_folder(spark, "words")
    docs = _stream(spark, sf, "documents")
    jobs.count_words(docs, "text", f"{folder}/ledger", f"{folder}/checkpoint").awaitTermination()
    return jobs.read_counts(spark, f"{folder}/ledger")


QUERIES = {
    "stream_results": results,
    "stream_latest": latest,
    "stream_incremental": incremental,
    "stream_word_count": counted,
}

ORACLES = {
    "stream_results": """
        SELECT event_type AS topic, event_id AS "offset", ts AS "timestamp",
               CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events""",
    "stream_latest": """
        SELECT event_type AS topic, max(event_id) AS "offset", arg_max(ts, event_id) AS "timestamp",
               arg_max(props, event_id) AS "value"
        FROM events GROUP BY event_type""",
    "stream_incremental": f"""
        SELECT DISTINCT event_type, user_id FROM events WHERE ts > TIMESTAMP '{SINCE}'""",
    "stream_word_count": with_ctes("wc") + "SELECT word, n AS count FROM wc",
}
