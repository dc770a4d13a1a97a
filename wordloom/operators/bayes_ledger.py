"""Naive Bayes learned batch by batch: the counts a model is made of, kept per batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.operators.bayes import BayesModel, from_counts
from wordloom.sources.files import read_batches, write_batch

COUNTS = "term STRING, label_no INT, hits BIGINT, weight DOUBLE"


class BayesLedger:
    """Rows of ``term, label_no, hits, weight`` per batch; rows without a term count a class's documents.

    What is learned is a sum, so batches can come in any order, be learned again in other words or be
    withdrawn, and only the counts of that batch are worked out. A batch is one folder that is
    replaced as a whole. A document belongs to one batch.
    """

    def __init__(self, spark: SparkSession, folder: str, labels: Sequence):
        self.spark, self.folder, self.labels = spark, folder, tuple(sorted(labels))

    def learn(self, batch_id: int | str, docs: DataFrame, terms: DataFrame, label: str) -> None:
        """Take a batch in, or replace it. ``docs`` and ``terms`` as for ``bayes.train``; other labels are left out."""
        number = (F.array_position(F.array(*[F.lit(n) for n in self.labels]), F.col(label)) - 1).cast("int").alias("label_no")
        zero = F.lit(0).cast("bigint")
        words = terms.where(F.col(label).isin(*self.labels) & F.col("term").isNotNull()).groupBy("term", number).agg(
            F.count(F.lit(1)).alias("hits"), F.sum("x").alias("weight"))
        sizes = docs.where(F.col(label).isin(*self.labels)).groupBy(number).agg(F.count(F.lit(1)).alias("n"))
        rows = words.unionByName(sizes.select(
            F.lit(None).cast("string").alias("term"), "label_no", zero.alias("hits"), F.col("n").cast("double").alias("weight")))
        write_batch(rows, self.folder, batch_id)

    def withdraw(self, batch_id: int | str) -> None:
        """Forget a batch; one that was never learned is no error."""
        write_batch(self.spark.createDataFrame([], COUNTS), self.folder, batch_id)

    def model(self) -> BayesModel:
        """The model of all batches, as training on all their documents would give it."""
        rows = read_batches(self.spark, self.folder, COUNTS)
        per_class = [F.sum(F.when(F.col("label_no") == i, F.col("weight")).otherwise(0.0)).alias(f"w{i}") for i in range(len(self.labels))]
        terms = rows.where(F.col("term").isNotNull()).groupBy("term").agg(F.sum("hits").alias("hits"), *per_class)
        docs = rows.where(F.col("term").isNull()).groupBy("label_no").agg(F.sum("weight").cast("bigint").alias("docs"))
        return from_counts(self.labels, terms, docs)
