"""Registered queries: lexicon, proverbs, articles and relation edges."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.operators import edges as eg
from wordloom.operators import lexicon as lx
from wordloom.operators import textprep as tp
from wordloom.operators.lookup import run_query
from wordloom.operators.numbering import page_rows
from wordloom.operators.tagging import describe_tags, tag_words
from wordloom.plans import standins as si
from wordloom.plans.oracle import with_ctes
from wordloom.session import staged

REVIEWED = "the"
POS_SUMMARY = "SELECT POS, count(*) AS words, sum(word_count) AS uses FROM {lexicon} GROUP BY POS"


def _plain(lexicon: DataFrame) -> DataFrame:
    return lexicon.select(
        "word", "word_count", "POS", "Label", F.array_join("definitions", " | ").alias("definitions")
    )


def _new_words(spark: SparkSession, sf: str) -> DataFrame:
    """Words of the conversations as untagged nodes."""
    return si.counts(spark, sf, "conversations").select(
        "word", F.array().cast("array<string>").alias("definitions"),
        F.col("count").alias("word_count"), F.lit("Unknown").alias("POS"), F.lit("").alias("Label"),
    )


def lexicon_upsert(spark: SparkSession, sf: str) -> DataFrame:
    return _plain(lx.upsert_counts(si.lexicon(spark, sf), _new_words(spark, sf)))


def insert_if_absent(spark: SparkSession, sf: str) -> DataFrame:
    new = _new_words(spark, sf).withColumn("word_count", F.lit(0).cast("bigint"))
    return _plain(lx.insert_if_absent(si.lexicon(spark, sf), new, "word"))


def enriched_words(spark: SparkSession, sf: str) -> DataFrame:
    return si.enriched(spark, sf).select(
        "word", "word_count", "POS", "Label", "base",
        F.array_join("definitions", " | ").alias("definitions"),
    )


def _synonyms(spark: SparkSession, sf: str) -> DataFrame:
    return eg.list_edges(si.enriched(spark, sf), si.dictionary(spark, sf), "synonym", "SYNONYM_OF")


def _antonyms(spark: SparkSession, sf: str) -> DataFrame:
    return eg.list_edges(si.enriched(spark, sf), si.dictionary(spark, sf), "antonym", "ANTONYM_OF")


def all_nodes(spark: SparkSession, sf: str) -> DataFrame:
    """Article words, then their base forms, synonyms and antonyms where not there yet."""
    dictionary = si.dictionary(spark, sf)
    tags = staged(si.tags(spark, sf, dictionary), "tags")
    enriched = staged(lx.enrich(si.counts(spark, sf), dictionary, tags), "enriched")
    others = F.concat(F.array("base"), "synonym", "antonym")
    derived = enriched.select(F.explode(F.array_distinct(others)).alias("word"))
    nodes = lx.dictionary_nodes(derived, dictionary, tags)
    return lx.insert_if_absent(lx.as_nodes(enriched), lx.as_nodes(nodes), "word")


def lexicon_nodes(spark: SparkSession, sf: str) -> DataFrame:
    return _plain(all_nodes(spark, sf))


def _requests(enriched: DataFrame) -> DataFrame:
    """Synonym edges as asked for, ends unchecked."""
    return enriched.select(
        F.lit("SYNONYM_OF").alias("rel"), F.lit(eg.WORD).alias("src_type"), F.col("word").alias("src"),
        F.lit(eg.WORD).alias("dst_type"), F.explode("synonym").alias("dst"),
    )


def _node_keys(nodes: DataFrame) -> DataFrame:
    return nodes.select(F.lit(eg.WORD).alias("type"), F.col("word").alias("id"))


def edges_valid(spark: SparkSession, sf: str) -> DataFrame:
    enriched = staged(si.enriched(spark, sf), "enriched")
    asked = _requests(enriched)
    return eg.valid_edges(asked.unionByName(asked), _node_keys(enriched))


def edges_multiset(spark: SparkSession, sf: str) -> DataFrame:
    enriched = staged(si.enriched(spark, sf), "enriched")
    nodes = lx.append_nodes(lx.as_nodes(enriched), lx.plain_word_nodes(si.dictionary(spark, sf)))
    return eg.multiset_edges(_requests(enriched), _node_keys(nodes))


def proverbs(spark: SparkSession, sf: str) -> DataFrame:
    return lx.first_meanings(si.proverb_rows(spark, sf))


def offset_limit(spark: SparkSession, sf: str) -> DataFrame:
    return page_rows(si.proverb_rows(spark, sf), "ord", 60, 30)


def edges_has_word(spark: SparkSession, sf: str) -> DataFrame:
    return eg.proverb_edges(lx.phrase_words(proverbs(spark, sf)), si.dictionary(spark, sf))


def articles_dim(spark: SparkSession, sf: str) -> DataFrame:
    return lx.articles_by_title(si.articles(spark, sf), F.col("page_id")).select(
        "title", "author", "articleBrief", "url", F.size("contents").alias("paragraphs")
    )


def authors_dim(spark: SparkSession, sf: str) -> DataFrame:
    return lx.authors_by_name(si.articles(spark, sf), F.col("page_id"))


def edges_mentioned(spark: SparkSession, sf: str) -> DataFrame:
    docs = si.table(spark, sf, "documents").select(
        F.concat(F.lit("doc/"), F.col("doc_id")).alias("url"), "text"
    )
    lexicon = staged(si.lexicon(spark, sf).select("word", "word_count"), "lexicon")
    return eg.mention_edges(tp.distinct_words(docs, "text", "url"), lexicon, "url")


def update_where(spark: SparkSession, sf: str) -> DataFrame:
    changed = lx.update_where(
        si.lexicon(spark, sf), "word", REVIEWED, {"POS": "Reviewed", "Label": "neutral"}
    )
    return _plain(changed)


def append_nodes(spark: SparkSession, sf: str) -> DataFrame:
    return _plain(lx.append_nodes(si.lexicon(spark, sf), lx.plain_word_nodes(si.dictionary(spark, sf))))


def sql_passthrough(spark: SparkSession, sf: str) -> DataFrame:
    return run_query(spark, POS_SUMMARY, lexicon=si.lexicon(spark, sf))


def all_words(spark: SparkSession, sf: str) -> DataFrame:
    return si.lexicon(spark, sf).select("word")


def ending_tagger():
    """Stand-in for a model: tags by the ending of the word."""

    def tag(batch: pd.DataFrame) -> pd.DataFrame:
        word = batch["word"]
        pos = pd.Series("NOUN", index=word.index)
        pos[word.str.endswith("ing") | word.str.endswith("ed")] = "VERB"
        pos[word.str.endswith("ly")] = "ADV"
        return pd.DataFrame({"word": word, "tag": pos})

    return tag


def tagged_words(spark: SparkSession, sf: str) -> DataFrame:
    words = si.counts(spark, sf).select("word")
    return tag_words(words, ending_tagger, "word STRING, tag STRING")


def tag_description(spark: SparkSession, sf: str) -> DataFrame:
    return describe_tags(si.tag_codes(si.dictionary(spark, sf)), si.tag_descriptions(spark))


def majority_label(spark: SparkSession, sf: str) -> DataFrame:
    return lx.majority_label(si.votes(spark, sf))


QUERIES = {
    "q_lexicon_upsert": lexicon_upsert,
    "q_insert_if_absent": insert_if_absent,
    "q_enriched_words": enriched_words,
    "q_lexicon_nodes": lexicon_nodes,
    "q_edges_lemma": si.lemma_edges,
    "q_edges_synonym": _synonyms,
    "q_edges_antonym": _antonyms,
    "q_edges_valid": edges_valid,
    "q_edges_multiset": edges_multiset,
    "q_proverbs": proverbs,
    "q_offset_limit": offset_limit,
    "q_edges_has_word": edges_has_word,
    "q_articles_dim": articles_dim,
    "q_authors_dim": authors_dim,
    "q_edges_mentioned": edges_mentioned,
    "q_update_where": update_where,
    "q_append_nodes": append_nodes,
    "q_sql_passthrough": sql_passthrough,
    "q_all_words": all_words,
    "q_tag_words": tagged_words,
    "q_tag_description": tag_description,
    "q_majority_label": majority_label,
}

_JOINED = "array_to_string(definitions, ' | ') AS definitions"

ORACLES = {
    "q_lexicon_upsert": with_ctes("lex", "cwc") + f"""
        SELECT coalesce(l.word, c.word) AS word, coalesce(l.word_count, 0) + coalesce(c.n, 0) AS word_count,
               coalesce(l.POS, 'Unknown') AS POS, coalesce(l.Label, '') AS Label,
               coalesce(array_to_string(l.definitions, ' | '), '') AS definitions
        FROM lex l FULL OUTER JOIN cwc c ON l.word = c.word""",
    "q_insert_if_absent": with_ctes("lex", "cwc") + f"""
        SELECT word, word_count, POS, Label, {_JOINED} FROM lex
        UNION ALL SELECT word, 0, 'Unknown', '', '' FROM cwc WHERE word NOT IN (SELECT word FROM lex)""",
    "q_enriched_words": with_ctes("enriched") + f"""
        SELECT word, word_count, POS, Label, base, {_JOINED} FROM enriched""",
    "q_lexicon_nodes": with_ctes("nodes") + f"SELECT word, word_count, POS, Label, {_JOINED} FROM nodes",
    "q_edges_lemma": with_ctes("lemma") + "SELECT * FROM lemma",
    "q_edges_synonym": with_ctes("syn") + "SELECT * FROM syn",
    "q_edges_antonym": with_ctes("ant") + "SELECT * FROM ant",
    "q_edges_valid": with_ctes("lex", "enriched") + """
        SELECT DISTINCT 'SYNONYM_OF' AS rel, 'WORD' AS src_type, src, 'WORD' AS dst_type, dst
        FROM (SELECT word AS src, unnest(synonym) AS dst FROM enriched)
        WHERE src IN (SELECT word FROM lex) AND dst IN (SELECT word FROM lex)""",
    "q_edges_multiset": with_ctes("lex", "dict", "enriched") + """
        , n AS (SELECT word FROM lex UNION ALL SELECT word FROM dict)
        SELECT 'SYNONYM_OF' AS rel, 'WORD' AS src_type, src, 'WORD' AS dst_type, dst, count(*) AS copies
        FROM (SELECT word AS src, unnest(synonym) AS dst FROM enriched)
             JOIN n a ON a.word = src JOIN n b ON b.word = dst
        GROUP BY src, dst""",
    "q_proverbs": with_ctes("proverbs") + "SELECT peribahasa, meaning FROM proverbs",
    "q_offset_limit": with_ctes("peri") + """
        SELECT ord, peribahasa, meaning FROM peri ORDER BY ord LIMIT 30 OFFSET 60""",
    "q_edges_has_word": with_ctes("proverbs", "dict") + """
        SELECT DISTINCT 'HAS_WORD' AS rel, 'PERIBAHASA' AS src_type, src, 'WORD' AS dst_type, dst
        FROM (SELECT peribahasa AS src, unnest(string_split(peribahasa, ' ')) AS dst FROM proverbs)
        WHERE dst IN (SELECT word FROM dict)""",
    "q_articles_dim": with_ctes("art") + """
        SELECT title, arg_min(author, page_id) AS author, arg_min(brief, page_id) AS articleBrief,
               arg_min(url, page_id) AS url, arg_min(len(contents), page_id) AS paragraphs
        FROM art GROUP BY title""",
    "q_authors_dim": with_ctes("art") + """
        SELECT author AS name, arg_min(rel_link, page_id) AS relLink, arg_min(email, page_id) AS email
        FROM art WHERE author <> '' GROUP BY author""",
    "q_edges_mentioned": with_ctes("tok", "lex") + """
        SELECT DISTINCT 'MENTIONED_IN' AS rel, 'WORD' AS src_type, word AS src, 'ARTICLE' AS dst_type,
               'doc/' || doc_id AS dst
        FROM tok WHERE word IN (SELECT word FROM lex)""",
    "q_update_where": with_ctes("lex") + f"""
        SELECT word, word_count, CASE WHEN word = '{REVIEWED}' THEN 'Reviewed' ELSE POS END AS POS,
               CASE WHEN word = '{REVIEWED}' THEN 'neutral' ELSE Label END AS Label, {_JOINED}
        FROM lex""",
    "q_append_nodes": with_ctes("lex", "dict") + f"""
        SELECT word, word_count, POS, Label, {_JOINED} FROM lex
        UNION ALL SELECT word, length(word), 'Unknown', '', array_to_string(meanings, ' | ') FROM dict""",
    "q_sql_passthrough": with_ctes("lex") + """
        SELECT POS, count(*) AS words, sum(word_count) AS uses FROM lex GROUP BY POS""",
    "q_all_words": with_ctes("lex") + "SELECT word FROM lex",
    "q_tag_words": with_ctes("wc") + """
        SELECT word, CASE WHEN ends_with(word, 'ly') THEN 'ADV'
                          WHEN ends_with(word, 'ing') OR ends_with(word, 'ed') THEN 'VERB'
                          ELSE 'NOUN' END AS tag FROM wc""",
    "q_tag_description": with_ctes("tagged") + "SELECT word, tag, pos AS POS FROM tagged",
    "q_majority_label": with_ctes("vote") + """
        SELECT word, CASE WHEN lo = hi THEN lo WHEN p > n THEN 'positive' WHEN n > p THEN 'negative'
                          WHEN n > 0 THEN 'negative' WHEN o > 0 THEN 'neutral' ELSE 'positive' END AS label
        FROM (SELECT word, min(label) AS lo, max(label) AS hi, count(*) FILTER (label = 'positive') AS p,
                     count(*) FILTER (label = 'negative') AS n, count(*) FILTER (label = 'neutral') AS o
              FROM vote GROUP BY word)""",
}
