"""Classifier evaluation from confusion counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def confusion_counts(predictions: DataFrame, actual: str, predicted: str) -> DataFrame:
    """``actual, predicted, n``: at most one row per pair of classes."""
    return predictions.groupBy(
        F.col(actual).alias("actual"), F.col(predicted).alias("predicted")
    ).agg(F.count(F.lit(1)).alias("n"))


def accuracy(counts: DataFrame) -> DataFrame:
    right = F.sum(F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0))
    return counts.agg(F.sum("n").alias("total"), F.try_divide(right, F.sum("n")).alias("accuracy"))


def class_report(counts: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class of either column, then the two means.

    A ratio with nothing below the line is 0.
    """
    hit = F.col("actual") == F.col("predicted")
    sides = counts.select(
        F.explode(
            F.array(
                F.struct(F.col("actual").alias("label"), F.col("n").alias("support"),
                         F.lit(0).cast("bigint").alias("found"),
                         F.when(hit, F.col("n")).otherwise(0).alias("right")),
                F.struct(F.col("predicted").alias("label"), F.lit(0).cast("bigint").alias("support"),
                         F.col("n").alias("found"), F.lit(0).cast("bigint").alias("right")),
            )
        ).alias("s")
    ).select("s.*")
    sums = sides.groupBy("label").agg(
        F.sum("support").alias("support"), F.sum("found").alias("found"), F.sum("right").alias("right")
    )

    def ratio(over, below):
        return F.coalesce(F.try_divide(over, below), F.lit(0.0))

    per_class = sums.select(
        F.col("label").cast("string").alias("label"),
        ratio(F.col("right"), F.col("found")).alias("precision"),
        ratio(F.col("right"), F.col("support")).alias("recall"),
        ratio(2 * F.col("right"), F.col("found") + F.col("support")).alias("f1"),
        "support",
    )
    measures = ("precision", "recall", "f1")
    macro = per_class.agg(*[F.avg(m).alias(m) for m in measures], F.sum("support").alias("support"))
    weighted = per_class.agg(
        *[ratio(F.sum(F.col(m) * F.col("support")), F.sum("support")).alias(m) for m in measures],
        F.sum("support").alias("support"),
    )
    return (
        per_class.unionByName(macro.withColumn("label", F.lit("macro avg")))
        .unionByName(weighted.withColumn("label", F.lit("weighted avg")))
    )


def confusion_matrix(counts: DataFrame, labels: Sequence) -> DataFrame:
    """One row per actual class and one column per predicted class, zeros included."""
    cells = [
        F.sum(F.when(F.col("predicted") == name, F.col("n")).otherwise(0)).alias(f"pred_{name}")
        for name in labels
    ]
    filled = counts.where(F.col("actual").isin(*labels)).groupBy("actual").agg(*cells)
    order = F.lit(None).cast("int")
    for i, name in enumerate(labels):
        order = F.when(F.col("actual") == name, i).otherwise(order)
    every = counts.sparkSession.createDataFrame([(name,) for name in labels], ["actual"])
    return (
        every.join(filled, "actual", "left").na.fill(0)
        .select("actual", *[f"pred_{n}" for n in labels]).orderBy(order)
    )
