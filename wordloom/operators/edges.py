"""Relation edges of the lexicon graph: ``rel, src_type, src, dst_type, dst``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.operators.skew import hot_join

WORD = "WORD"
PROVERB = "PERIBAHASA"
ARTICLE = "ARTICLE"


def _edges(pairs: DataFrame, rel: str, src: Column, dst: Column,
           src_type: str = WORD, dst_type: str = WORD) -> DataFrame:
    return pairs.select(
        F.lit(rel).alias("rel"), F.lit(src_type).alias("src_type"), src.alias("src"),
        F.lit(dst_type).alias("dst_type"), dst.alias("dst"),
    )


def lemma_edges(enriched: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Word to base form where the dictionary has it; a base word points to itself."""
    changed = enriched.where(F.col("base") != F.col("word")).select("word", "base")
    known = changed.join(dictionary.select(F.col("word").alias("base")), "base", "left_semi")
    itself = enriched.where(F.col("base") == F.col("word")).select("word", "base")
    pairs = known.select("word", "base").unionByName(itself)
    return _edges(pairs, "LEMMATIZED", F.col("word"), F.col("base"))


def list_edges(enriched: DataFrame, dictionary: DataFrame, column: str, rel: str) -> DataFrame:
    """Word to each distinct entry of an array column that the dictionary has."""
    pairs = enriched.select("word", F.explode(F.array_distinct(column)).alias("other"))
    known = pairs.join(dictionary.select(F.col("word").alias("other")), "other", "left_semi")
    return _edges(known, rel, F.col("word"), F.col("other"))


def proverb_edges(phrase_words: DataFrame, dictionary: DataFrame) -> DataFrame:
    known = phrase_words.join(dictionary.select("word"), "word", "left_semi")
    return _edges(known, "HAS_WORD", F.col("peribahasa"), F.col("word"), PROVERB, WORD)


def mention_edges(article_words: DataFrame, lexicon: DataFrame, key: str) -> DataFrame:
    """Lexicon word to each article that holds it.

    ``article_words`` has each word once per article. Common words meet most articles,
    so the join spreads them by article.
    """
    words = lexicon.where(F.col("word_count") > 0).select("word", "word_count")
    hits = hot_join(article_words, words, "word", "word_count", key)
    return _edges(hits, "MENTIONED_IN", F.col("word"), F.col(key), WORD, ARTICLE)


def valid_edges(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Each edge once, and only where both ends exist. ``nodes``: ``type, id``."""
    src = nodes.select(F.col("type").alias("src_type"), F.col("id").alias("src"))
    dst = nodes.select(F.col("type").alias("dst_type"), F.col("id").alias("dst"))
    return (
        edges.distinct()
        .join(src, ["src_type", "src"], "left_semi")
        .join(dst, ["dst_type", "dst"], "left_semi")
        .select("rel", "src_type", "src", "dst_type", "dst")
    )


def multiset_edges(requests: DataFrame, nodes: DataFrame) -> DataFrame:
    """Plain insert: one edge per request and per pair of matching nodes.

    ``copies`` holds how many equal edges there are; they are counted, not written out.
    """
    per_node = nodes.groupBy("type", "id").agg(F.count(F.lit(1)).alias("_n"))
    src = per_node.select(
        F.col("type").alias("src_type"), F.col("id").alias("src"), F.col("_n").alias("_src_n")
    )
    dst = per_node.select(
        F.col("type").alias("dst_type"), F.col("id").alias("dst"), F.col("_n").alias("_dst_n")
    )
    asked = requests.groupBy("rel", "src_type", "src", "dst_type", "dst").agg(
        F.count(F.lit(1)).alias("_asked")
    )
    return (
        asked.join(src, ["src_type", "src"]).join(dst, ["dst_type", "dst"])
        .select(
            "rel", "src_type", "src", "dst_type", "dst",
            (F.col("_asked") * F.col("_src_n") * F.col("_dst_n")).alias("copies"),
        )
    )
