"""Row numbers over a whole table without gathering it in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

RANGES = 64
CELLS = 64


def number_rows(df: DataFrame, order: str, name: str = "no", first: int = 1) -> DataFrame:
    """Number the rows by a unique numeric column; rows where it is null come last, in any order.

    The column's quantiles (a list of fixed length) cut the table into even ranges, and
    each range is cut into cells of equal width: some 4,000 ordered cells. Rows are
    numbered inside their cell, and the rows of earlier cells, whose sizes are a table of
    fixed length too, are added.
    """
    shares = [i / RANGES for i in range(1, RANGES)]
    low, high, cuts = df.agg(
        F.min(order), F.max(order), F.percentile_approx(order, shares)
    ).first()
    if low is None:  # nothing to order by: any order will do
        low, high, cuts = 0, 0, []
    cuts = sorted(set(cuts) - {high})
    key = F.col(order)
    # Rows without a place in the order are spread over cells of their own behind all others.
    behind = (len(cuts) + 1) * CELLS + F.pmod(F.xxhash64(F.struct("*")), F.lit(CELLS)).cast("int")
    start = F.array(*[F.lit(v) for v in [low, *cuts]])
    end = F.array(*[F.lit(v) for v in [*cuts, high]])
    part = sum(((key > c).cast("int") for c in cuts), F.lit(0))
    ranged = df.withColumn("_range", part)
    from_value, to_value = F.get(start, F.col("_range")), F.get(end, F.col("_range"))
    inside = (key - from_value).cast("double") / (to_value - from_value + 1)
    cell = F.col("_range") * CELLS + F.floor(inside * CELLS).cast("int")
    placed = ranged.withColumn("_cell", F.when(key.isNull(), behind).otherwise(cell)).drop(
        "_range"
    )
    sizes = placed.groupBy("_cell").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_cell", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")
    )
    rank = F.row_number().over(Window.partitionBy("_cell").orderBy(order))
    return (
        placed.join(F.broadcast(offsets), "_cell")
        .withColumn(name, (F.col("_before") + rank + F.lit(first - 1)).cast("bigint"))
        .drop("_cell", "_before")
    )


def page_rows(df: DataFrame, order: str, first: int, size: int) -> DataFrame:
    """Skip ``first`` rows of the ordered table, take ``size``."""
    numbered = number_rows(df, order, "_no", first=0)
    return numbered.where(F.col("_no").between(first, first + size - 1)).orderBy("_no").drop("_no")
