"""Articles to sentences, tokens and word counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.functions import text as tx


def article_texts(articles: DataFrame, key: str = "url") -> DataFrame:
    """Title, brief without photo credit, and body: one row each."""
    parts = F.array(
        F.struct(F.lit("title").alias("part"), F.col("title").alias("text")),
        F.struct(F.lit("brief").alias("part"), tx.strip_caption(F.col("articleBrief")).alias("text")),
        F.struct(F.lit("body").alias("part"), tx.flatten(F.col("contents")).alias("text")),
    )
    return articles.select(key, F.explode(parts).alias("p")).select(key, "p.part", "p.text")


def sentence_rows(df: DataFrame, text: str, keys: Sequence[str], keep_unicode: bool = False) -> DataFrame:
    """Cleaned, non-empty sentences with their position in the text."""
    return (
        df.select(*keys, F.posexplode(tx.sentences(F.col(text))).alias("sent_pos", "raw"))
        .where(tx.has_letters(F.col("raw"), keep_unicode))
        .select(*keys, "sent_pos", tx.clean_sentence(F.col("raw"), keep_unicode).alias("sentence"))
    )


def sentence_tokens(sentences: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Words of cleaned sentences with their position in the sentence."""
    return (
        sentences.select(*keys, F.posexplode(F.split("sentence", " ")).alias("word_pos", "raw"))
        .where(tx.is_word(F.col("raw")))
        .select(*keys, "word_pos", tx.token(F.col("raw")).alias("word"))
    )


def text_tokens(df: DataFrame, text: str, keys: Sequence[str] = ()) -> DataFrame:
    """Words of whole texts without positions: one pass over each text.

    Tokens are filtered before they are rewritten, so no expression runs twice.
    """
    return (
        df.select(*keys, F.explode(tx.raw_tokens(F.col(text))).alias("raw"))
        .where(tx.is_word(F.col("raw")))
        .select(*keys, tx.token(F.col("raw")).alias("word"))
    )


def word_count(tokens: DataFrame) -> DataFrame:
    """Occurrences per word, combined map-side before the shuffle."""
    return tokens.groupBy("word").agg(F.count(F.lit(1)).alias("count"))


def distinct_words(df: DataFrame, text: str, key: str) -> DataFrame:
    """Each word once per text; duplicates fall out inside the row, without a shuffle."""
    return df.select(key, F.explode(F.array_distinct(tx.token_array(F.col(text)))).alias("word"))


def content_words(text: Column, stopwords: Sequence[str]) -> Column:
    """Noise dropped, lower case, white-space tokens without the stop words.

    Tokens are letters only, so a word held together by an apostrophe or hyphen is closed
    up. The stop list is a literal set: each token costs one hash lookup.
    """
    letters = F.lower(F.regexp_replace(text, r"(?:(?!\s)[^a-zA-Z])+", ""))
    return F.filter(F.split(letters, r"\s+"), lambda w: (w != "") & ~w.isin(list(stopwords)))
