"""Reading the given tables and small helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(key: Column) -> Column:
    """True for the fifth of the keys whose labels are never learned from."""
    return F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(5)) == 0


def narrow(docs: DataFrame, key: str, text: str, carry: bool = False) -> DataFrame:
    """``doc_id`` and ``text``, a null text read as empty; other columns cannot clash.

    With ``carry`` the row itself comes along as the struct ``row``.
    """
    columns = [docs[key].alias("doc_id"), F.coalesce(docs[text].cast("string"), F.lit("")).alias("text")]
    if carry:
        columns.append(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    return docs.select(*columns)


#: Sub-keys of a group in the first of two rankings, so that no task ranks all rows of a group.
RANK_SALTS = 32


def first_ranks(rows: DataFrame, group: list[str], order: list[Column], k: int, spread: str) -> DataFrame:
    """The first ``k`` rows of each group with their ``rank`` (from 1): first per sub-key, then of those."""
    salted = Window.partitionBy(*group, F.pmod(F.xxhash64(spread), F.lit(RANK_SALTS))).orderBy(*order)
    few = rows.withColumn("rank", F.row_number().over(salted)).where(F.col("rank") <= k)
    whole = Window.partitionBy(*group).orderBy(*order)
    return few.withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= k)
