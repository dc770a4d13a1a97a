"""Deduplication, anti-join against history and listing cuts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, key: str, order: Column) -> DataFrame:
    """One row per key: the first by ``order``. Null keys count as one key.

    An aggregate, not a window: each task first reduces its own rows to one per key, so
    a key that holds a third of the table is no heavier than the others.
    """
    rest = [c for c in df.columns if c != key]
    first = F.min_by(F.struct(*rest), order).alias("r")
    return df.groupBy(key).agg(first).select(key, "r.*").select(*df.columns)


def not_yet_processed(new: DataFrame, history: DataFrame, key: str) -> DataFrame:
    """Rows whose key the history lacks; rows with a null key always pass."""
    return new.join(history.select(key).distinct(), key, "left_anti")


def newer_prefix(items: DataFrame, listing: str, rank: str, time: str, since) -> DataFrame:
    """Items of each listing before its first item that is not newer than ``since``.

    ``rank`` grows down the listing. Only one number per listing crosses the shuffle.
    """
    stop = (
        items.where(F.col(time) <= F.lit(since))
        .groupBy(listing).agg(F.min(rank).alias("_stop"))
    )
    newer = items.where(F.col(time) > F.lit(since))
    return (
        newer.join(stop, listing, "left")
        .where(F.col("_stop").isNull() | (F.col(rank) < F.col("_stop")))
        .drop("_stop")
    )
