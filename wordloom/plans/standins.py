"""The lexicon's inputs, derived by rule from the driver tables.

Documents and conversations are the articles, ``benchmark`` gives the dictionary, labelled
documents give word sentiment, first sentences give proverbs, ``pages`` the raw pages and
``events`` the message log.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.functions import text as tx
from wordloom.functions.phrases import normalize_phrase
from wordloom.operators import edges as eg
from wordloom.operators import lexicon as lx
from wordloom.operators import textprep as tp
from wordloom.operators.pages import ArticleLayout, extract_articles
from wordloom.operators.skew import hashed_if_many
from wordloom.operators.tagging import describe_tags
from wordloom.session import staged
from wordloom.sources.files import read_texts

SUFFIXES = ("ing", "ed", "ly", "tion", "er", "en", "s")
TAG_DESCRIPTIONS = (
    ("ADP", "Adposition, relation word"),
    ("VERB", "Verb, action word"),
    ("NOUN", "Noun, name of a thing"),
    ("PROPN", "Proper noun, name of one thing"),
)
TEXT_TABLES = ("documents", "conversations", "pages")
EMOTIONS = ("anger", "fear", "happy", "love", "sadness", "surprise")
PAGE_LAYOUT = ArticleLayout(
    title=("title", None), meta=("nav", None), brief=("h1", None),
    body=("article", None), ads=("div", "ad"),
)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    path = f"{sf}/{name}.parquet"
    return read_texts(spark, path) if name in TEXT_TABLES else spark.read.parquet(path)


def counts(spark: SparkSession, sf: str, source: str = "documents") -> DataFrame:
    return tp.word_count(tp.text_tokens(table(spark, sf, source), "text"))


def used_in_sentences(df: DataFrame, *order: str) -> DataFrame:
    """Words with the first and the last sentence that uses them.

    Only places go through the aggregate; the two sentences of a word are fetched after
    it, so no sentence is carried along with each of its words.
    """
    keys = [*order, "sent_pos"]
    at = F.struct(*keys)
    sentences = tp.sentence_rows(df, "text", order)
    ends = (
        tp.sentence_tokens(sentences, keys).groupBy("word")
        .agg(F.array_distinct(F.array(F.min(at), F.max(at))).alias("ends"))
        .select("word", F.inline("ends"))
    )
    return ends.join(sentences, keys).groupBy("word").agg(
        F.min_by("sentence", at).alias("first"), F.max_by("sentence", at).alias("last")
    )


def dictionary(spark: SparkSession, sf: str) -> DataFrame:
    """Stored, as a dictionary would be: joins then know its true size before they start."""
    used = used_in_sentences(table(spark, sf, "benchmark"), "item_id")
    entries = used.select(
        "word",
        F.array_distinct(F.array("first", "last")).alias("meanings"),
        F.array(*[F.concat("word", F.lit(s)) for s in SUFFIXES]).alias("synonym"),
        F.array(F.reverse("word")).alias("antonym"),
    )
    return staged(entries, "dictionary")


def external_definitions(spark: SparkSession, sf: str) -> DataFrame:
    used = used_in_sentences(table(spark, sf, "conversations"), "conv_id", "turn")
    return used.select("word", F.array("first").alias("definitions"))


def labelled_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Documents that have a label row, with their sentiment. Many labels are hashed, so that no text is sorted."""
    labels = table(spark, sf, "labels")
    sentiment = (
        F.when(F.col("toxic") == 1, "negative").when(F.col("quality") == 1, "positive")
        .otherwise("neutral")
    )
    return table(spark, sf, "documents").join(
        hashed_if_many(labels.select("doc_id", sentiment.alias("label"))), "doc_id"
    )


def votes(spark: SparkSession, sf: str) -> DataFrame:
    """One vote per word and labelled document that holds it."""
    held = F.array_distinct(tx.token_array(F.col("text")))
    return labelled_documents(spark, sf).select("label", F.explode(held).alias("word"))


def word_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Sentiment of a word: its share of positive less its share of negative documents."""
    balance = F.count_if(F.col("label") == "positive") - F.count_if(F.col("label") == "negative")
    sums = votes(spark, sf).groupBy("word").agg(F.count(F.lit(1)).alias("n"), balance.alias("s"))
    label = (
        F.when(F.col("s") * 10 >= F.col("n") * 7, "positive")
        .when(F.col("s") * 10 < F.col("n") * 6, "negative").otherwise("neutral")
    )
    return sums.select("word", label.alias("Label"))


def tag_codes(words: DataFrame) -> DataFrame:
    size = F.length("word")
    code = F.when(size <= 2, "ADP").when(size <= 4, "VERB").when(size <= 8, "NOUN").otherwise("PROPN")
    return words.select("word", code.alias("tag"))


def tag_descriptions(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(TAG_DESCRIPTIONS), "tag STRING, description STRING")


def tags(spark: SparkSession, sf: str, entries: DataFrame) -> DataFrame:
    """Base form, POS and sentiment of the dictionary's words."""
    words = entries.select("word")
    bases = lx.stem_by_suffix(words, words, SUFFIXES)
    pos = describe_tags(tag_codes(words), tag_descriptions(spark)).select("word", "POS")
    return bases.join(pos, "word").join(word_labels(spark, sf), "word", "left")


def enriched(spark: SparkSession, sf: str) -> DataFrame:
    entries = dictionary(spark, sf)
    return lx.enrich(counts(spark, sf), entries, tags(spark, sf, entries))


def lexicon(spark: SparkSession, sf: str) -> DataFrame:
    return lx.as_nodes(enriched(spark, sf))


def lemma_edges(spark: SparkSession, sf: str) -> DataFrame:
    return eg.lemma_edges(enriched(spark, sf), dictionary(spark, sf))


def proverb_rows(spark: SparkSession, sf: str) -> DataFrame:
    """First sentence of each document as a phrase, the second as its meaning."""
    row = F.struct(
        normalize_phrase(F.col("parts")[0]).alias("peribahasa"),
        F.coalesce(F.get("parts", F.lit(1)), F.lit("")).alias("meaning"),
    )
    return (
        table(spark, sf, "documents")
        .select(F.col("doc_id").alias("ord"), tx.sentences(F.col("text")).alias("parts"))
        .select("ord", F.inline(F.array(row)))
        .where(F.col("peribahasa") != "")
    )


def articles(spark: SparkSession, sf: str) -> DataFrame:
    return extract_articles(table(spark, sf, "pages"), PAGE_LAYOUT, "page_id")


def emotion_table(spark: SparkSession, sf: str) -> DataFrame:
    """Emotion of a dictionary word by its length."""
    names = F.array(*[F.lit(e) for e in EMOTIONS])
    return dictionary(spark, sf).select(
        "word", F.get(names, F.length("word") % len(EMOTIONS)).alias("label")
    )


def message_log(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_type").alias("topic"), F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"), F.col("ts").alias("timestamp"), F.col("props").alias("value"),
    )
