"""From raw documents to packed sequences: the stages of a training-data corpus."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from wordloom.llm.dartminhash import keep_one_each
from wordloom.llm.line_dedup import remove_similar_lines
from wordloom.llm.packing import pack_documents
from wordloom.llm.quality_rules import keep_good
from wordloom.llm.tables import read_table
from wordloom.llm.toxicity import keep_civil
from wordloom.session import staged


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return keep_good(docs)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go; the model learns from the documents that are left."""
    return keep_civil(docs, read_table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines with an earlier match go; a document stays, even if no line of it is left."""
    return remove_similar_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates stays."""
    return keep_one_each(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents, packed into sequences."""
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("toxicity", toxicity),
    ("line dedup", line_dedup),
    ("MinHash near-dedup", near_dedup),
    ("best-fit packing", packing),
]

#: The stages learn models, cut texts by similarity and pack them, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next."""
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), "stage")
    return docs
