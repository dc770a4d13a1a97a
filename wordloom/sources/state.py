"""High-water mark of incremental runs."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.sources.files import read_or_empty

MARK = "run BIGINT, since TIMESTAMP, proverbs_done BIGINT"


def newer_than(df: DataFrame, time_column: str, since) -> DataFrame:
    """Strictly newer than the mark."""
    return df.where(F.col(time_column) > F.lit(since))


class RunMark:
    """One small row per finished run; the last row is the state.

    The mark moves to the *start* time of the crawl, not to the newest item, so that
    items published meanwhile are seen next time.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def current(self):
        rows = read_or_empty(self.spark, self.path, MARK)
        return rows.orderBy(F.desc("run")).first()

    def advance(self, crawl_start: datetime, proverbs: int = 0) -> None:
        """Add a step for this crawl; saying it again for the same crawl replaces the step."""
        last = self.current()
        if last and last.since == crawl_start:
            earlier = read_or_empty(self.spark, self.path, MARK).where(F.col("run") < last.run)
            run, before = last.run, earlier.orderBy(F.desc("run")).first()
        else:
            run, before = (last.run + 1 if last else 0), last
        done = (before.proverbs_done if before else 0) + proverbs
        row = self.spark.createDataFrame([(run, crawl_start, done)], MARK)
        row.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/step={run}")
