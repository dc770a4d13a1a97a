"""Lexicon, proverb, article and author tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.operators.records import first_per_key


def upsert_counts(old: DataFrame, new: DataFrame) -> DataFrame:
    """Additive upsert: counts add up, attributes once set never change."""
    attributes = [c for c in old.columns if c not in ("word", "word_count")]
    joined = old.alias("o").join(new.alias("n"), "word", "full_outer")
    count = F.coalesce(F.col("o.word_count"), F.lit(0)) + F.coalesce(F.col("n.word_count"), F.lit(0))
    known = F.col("o.word_count").isNotNull()
    kept = [F.when(known, F.col(f"o.{c}")).otherwise(F.col(f"n.{c}")).alias(c) for c in attributes]
    return joined.select("word", count.alias("word_count"), *kept).select(*old.columns)


def insert_if_absent(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows of ``new`` (one per key) join only where the key is not there yet."""
    return old.unionByName(new.join(old.select(key), key, "left_anti").select(*old.columns))


def fold_ledger(ledger: DataFrame) -> DataFrame:
    """Word counts as the sum over the batches of a ledger.

    Counts are derived, never incremented in place: replacing a batch in the ledger and
    folding again gives the same totals however often it runs.
    """
    return ledger.groupBy("word").agg(F.sum("count").alias("count"))


def enrich(counts: DataFrame, dictionary: DataFrame, tags: DataFrame) -> DataFrame:
    """Counted words found in the dictionary, with base form, POS and sentiment label.

    Words the dictionary lacks are dropped. Tags are optional per word.
    """
    return (
        counts.join(dictionary, "word")
        .join(tags, "word", "left")
        .select(
            "word",
            F.col("meanings").alias("definitions"),
            F.col("count").alias("word_count"),
            F.coalesce("POS", F.lit("")).alias("POS"),
            F.coalesce("Label", F.lit("")).alias("Label"),
            F.coalesce("base", F.col("word")).alias("base"),
            "synonym",
            "antonym",
        )
    )


def dictionary_nodes(words: DataFrame, dictionary: DataFrame, tags: DataFrame) -> DataFrame:
    """Derived words (base forms, synonyms, antonyms, proverb words): nodes with count 0."""
    zero = words.select("word").distinct().withColumn("count", F.lit(0).cast("bigint"))
    return enrich(zero, dictionary, tags)


def as_nodes(enriched: DataFrame) -> DataFrame:
    return enriched.select("word", "definitions", "word_count", "POS", "Label")


def first_meanings(proverbs: DataFrame) -> DataFrame:
    """Proverbs with the meaning of their first listing."""
    return first_per_key(proverbs.select("peribahasa", "meaning", "ord"), "peribahasa", F.col("ord")).select(
        "peribahasa", "meaning"
    )


def articles_by_title(articles: DataFrame, order: Column) -> DataFrame:
    """One article per title, the author's name taken out of the nested details."""
    flat = articles.select(
        "title", F.coalesce("authorDetails.authName", F.lit("")).alias("author"),
        "articleBrief", "contents", "url", order.alias("_ord"),
    )
    return first_per_key(flat, "title", F.col("_ord")).drop("_ord")


def authors_by_name(articles: DataFrame, order: Column) -> DataFrame:
    """One author per name with the first link and address seen."""
    flat = articles.select(
        F.col("authorDetails.authName").alias("name"),
        F.coalesce("authorDetails.relLink", F.lit("")).alias("relLink"),
        F.coalesce("authorDetails.email", F.lit("")).alias("email"),
        order.alias("_ord"),
    ).where(F.col("name") != "")
    return first_per_key(flat, "name", F.col("_ord")).drop("_ord")


def update_where(df: DataFrame, key: str, value, updates: Mapping[str, object]) -> DataFrame:
    """Set the given columns on rows whose ``key`` equals ``value``; new columns are added."""
    hit = F.col(key) == F.lit(value)
    changed = {}
    for name, new in updates.items():
        new = new if isinstance(new, Column) else F.lit(new)
        old = F.col(name) if name in df.columns else F.lit(None)
        changed[name] = F.when(hit, new).otherwise(old)
    return df.withColumns(changed)


def append_nodes(old: DataFrame, new: DataFrame) -> DataFrame:
    """Plain insert: duplicates stay."""
    return old.unionByName(new, allowMissingColumns=True)


def plain_word_nodes(words: DataFrame) -> DataFrame:
    """Older node shape: the word's length as its count and an unknown POS."""
    return words.select(
        "word",
        F.col("meanings").alias("definitions"),
        F.length("word").cast("bigint").alias("word_count"),
        F.lit("Unknown").alias("POS"),
        F.lit("").alias("Label"),
    )


def emptied(df: DataFrame) -> DataFrame:
    """Same schema, no rows: what a cleared table is overwritten with."""
    return df.limit(0)


def majority_label(votes: DataFrame) -> DataFrame:
    """One label per word: unanimous, else more positive or negative votes, else by priority.

    On equal votes the last one present of positive, neutral, negative is taken.
    """
    def votes_for(name: str) -> Column:
        return F.count_if(F.col("label") == name)

    counts = votes.groupBy("word").agg(
        votes_for("positive").alias("p"), votes_for("neutral").alias("o"),
        votes_for("negative").alias("n"),
        F.min("label").alias("low"), F.max("label").alias("high"),
    )
    label = (
        F.when(F.col("low") == F.col("high"), F.col("low"))
        .when(F.col("p") > F.col("n"), "positive")
        .when(F.col("n") > F.col("p"), "negative")
        .when(F.col("n") > 0, "negative")
        .when(F.col("o") > 0, "neutral")
        .otherwise("positive")
    )
    return counts.select("word", label.alias("label"))


def phrase_words(proverbs: DataFrame) -> DataFrame:
    """Distinct white-space tokens of each proverb."""
    tokens = F.filter(F.array_distinct(F.split("peribahasa", r"\s+")), lambda w: w != "")
    return proverbs.select("peribahasa", F.explode(tokens).alias("word"))


def stem_by_suffix(words: DataFrame, dictionary: DataFrame, suffixes: tuple[str, ...]) -> DataFrame:
    """Rule stemmer: strip the longest suffix that leaves a dictionary word."""
    cuts = F.array(*[F.lit(s) for s in suffixes])
    cut = words.select("word", F.explode(cuts).alias("suffix")).where(
        F.endswith("word", F.col("suffix")) & (F.length("word") > F.length("suffix") + 1)
    ).select("word", F.expr("left(word, length(word) - length(suffix))").alias("stem"))
    found = cut.join(dictionary.select(F.col("word").alias("stem")), "stem", "left_semi")
    best = found.groupBy("word").agg(F.min_by("stem", F.length("stem")).alias("base"))
    return words.join(best, "word", "left").withColumn("base", F.coalesce("base", F.col("word")))


