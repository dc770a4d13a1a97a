"""Multinomial Naive Bayes over term weights, as joins and aggregates."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.operators.skew import hot_join
from wordloom.session import staged


@dataclass(frozen=True)
class BayesModel:
    """``terms``: ``term, hits, w0, w1 ...``; ``classes``: ``label_no, docs, weight, vocabulary``.

    Classes are numbered in the order of ``labels``, which is kept ascending.
    """

    labels: tuple
    terms: DataFrame
    classes: DataFrame

    def save(self, path: str) -> None:
        """Write both tables; ``train`` stored the terms, so that this does not train again."""
        self.terms.write.mode("overwrite").parquet(f"{path}/terms")
        self.classes.write.mode("overwrite").parquet(f"{path}/classes")

    @staticmethod
    def load(spark: SparkSession, path: str, labels: Sequence) -> BayesModel:
        return BayesModel(
            tuple(sorted(labels)), spark.read.parquet(f"{path}/terms"),
            spark.read.parquet(f"{path}/classes"),
        )


def train(docs: DataFrame, terms: DataFrame, label: str, labels: Sequence) -> BayesModel:
    """``docs``: one row per training document with its label; ``terms``: ``label, term, x``.

    The terms are stored as they are counted; the classes are derived from the stored table.
    """
    labels = tuple(sorted(labels))
    per_class = [
        F.sum(F.when(F.col(label) == name, F.col("x")).otherwise(0.0)).alias(f"w{i}")
        for i, name in enumerate(labels)
    ]
    known = terms.where(F.col(label).isin(*labels)).groupBy("term").agg(F.count(F.lit(1)).alias("hits"), *per_class)
    number = F.array_position(F.array(*[F.lit(n) for n in labels]), F.col(label)) - 1
    counted = docs.where(F.col(label).isin(*labels)).groupBy(number.cast("int").alias("label_no")).agg(
        F.count(F.lit(1)).alias("docs")
    )
    return from_counts(labels, known, counted)


def from_counts(labels: tuple, terms: DataFrame, docs: DataFrame) -> BayesModel:
    """The model of counted terms ``term, hits, w0, w1 ...``, which are stored, and documents ``label_no, docs``."""
    known = staged(terms, "terms")
    sums = known.agg(
        F.struct(
            F.array(*[F.sum(f"w{i}") for i in range(len(labels))]).alias("weight"),
            F.count(F.lit(1)).alias("vocabulary"),
        )
    ).scalar()
    classes = docs.select("label_no", "docs", sums.alias("s")).select(
        "label_no", "docs", F.get("s.weight", F.col("label_no")).alias("weight"), "s.vocabulary"
    )
    return BayesModel(labels, known, classes)


def term_table(model: BayesModel) -> DataFrame:
    """Long form with smoothed log probabilities: ``term, label, weight, log_prob``."""
    rows = F.array(
        *[
            F.struct(F.lit(i).alias("label_no"), F.lit(name).alias("label"), F.col(f"w{i}").alias("weight"))
            for i, name in enumerate(model.labels)
        ]
    )
    long = model.terms.select("term", F.explode(rows).alias("r")).select("term", "r.*")
    spaces = model.classes.select(
        "label_no", (F.col("weight") + F.col("vocabulary")).alias("space")
    )
    return long.join(spaces, "label_no").select(
        "term", "label", "weight", F.ln((F.col("weight") + 1) / F.col("space")).alias("log_prob")
    )


def predict(model: BayesModel, docs: DataFrame, terms: DataFrame, key: str) -> DataFrame:
    """Best class per document and its score; unseen terms are ignored.

    Per class: ln(prior) + sum(x) ln(1 / (weight + vocabulary)) + sum(x ln(w + 1)) over the
    document's known terms. One join brings all class weights of a term, one aggregate
    sums them; terms that most documents hold are spread by document. Scores are compared
    after rounding to six places, equal ones go to the lowest class.
    """
    span = range(len(model.labels))
    logs = model.terms.select(
        "term", "hits", *[F.ln(F.col(f"w{i}") + 1).alias(f"l{i}") for i in span]
    )
    met = hot_join(terms.select(key, "term", "x"), logs, "term", "hits", key)
    summed = met.groupBy(key).agg(
        F.sum("x").alias("k"), *[F.sum(F.col("x") * F.col(f"l{i}")).alias(f"s{i}") for i in span]
    )
    all_docs = F.sum("docs")
    constants = model.classes.agg(
        F.struct(
            *[
                F.struct(
                    F.ln(F.sum(F.when(F.col("label_no") == i, F.col("docs"))) / all_docs).alias("prior"),
                    F.ln(1 / F.max(F.when(F.col("label_no") == i, F.col("weight") + F.col("vocabulary")))
                         ).alias("unseen"),
                ).alias(f"c{i}")
                for i in span
            ]
        )
    ).scalar()
    scored = docs.select(key).join(summed, key, "left").withColumn("m", constants)

    def or_zero(name: str):
        return F.coalesce(F.col(name), F.lit(0.0))

    scores = F.array(
        *[
            F.round(F.col(f"m.c{i}.prior") + or_zero("k") * F.col(f"m.c{i}.unseen") + or_zero(f"s{i}"), 6)
            for i in span
        ]
    )
    names = F.array(*[F.lit(n) for n in model.labels])
    return scored.withColumn("scores", scores).select(
        key,
        F.get(names, (F.array_position("scores", F.array_max("scores")) - 1).cast("int")).alias("predicted"),
        F.array_max("scores").alias("score"),
    )
