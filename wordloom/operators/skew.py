"""Joins that stay balanced when a few keys hold most rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key with more than one in so many hits is hot.
HOT_SHARE = 1000
#: From so many keys on the right side is no broadcast by any estimate, and is hashed by partition.
MANY_KEYS = 1 << 19


def hashed_if_many(right: DataFrame) -> DataFrame:
    """A stored right side of one row per key, with the hint to hash it by partition if it has many keys."""
    return right.hint("shuffle_hash") if right.count() > MANY_KEYS else right


def hot_join(left: DataFrame, right: DataFrame, key: str, hits: str, spread: str) -> DataFrame:
    """Inner join of many rows per key (``left``) with one row per key (``right``).

    ``hits`` on the right says how many left rows a key meets, or a number in proportion
    to it. A key with more than one in ``HOT_SHARE`` of all hits is hot; there are fewer
    than ``HOT_SHARE`` of them whatever the data size, so their list is broadcast. Hot
    keys are spread by ``spread`` over as many sub-keys as make each of them meet about one in
    ``HOT_SHARE`` of the hits, and their right rows are copied to each; every other key joins as
    usual. No row is lost or doubled. The right side is read four times, so it should be a
    stored table. With more than ``MANY_KEYS`` keys it is hashed by partition, where it has one row per
    key and sub-key; the many left rows are then not sorted, nor spilled to be sorted.
    """
    total = right.agg(F.sum(hits)).scalar()
    shares = F.ceil(F.try_divide(F.col(hits) * HOT_SHARE, total)).cast("bigint")
    is_hot = F.col(hits) * HOT_SHARE > total
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    hot = F.broadcast(right.where(is_hot).select(key, shares.alias("_salts")))
    salted_left = left.join(hot, key, "left").withColumn(
        "_salt", F.pmod(F.xxhash64(spread), F.coalesce("_salts", one))
    ).drop("_salts")
    salts = F.when(is_hot, F.sequence(zero, shares - 1)).otherwise(F.array(zero))
    salted_right = right.withColumn("_salt", F.explode(salts))
    if right.count() > MANY_KEYS:
        salted_right = salted_right.hint("shuffle_hash")
    return salted_left.join(salted_right, [key, "_salt"]).drop("_salt")
