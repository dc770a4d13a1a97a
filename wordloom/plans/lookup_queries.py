"""Registered queries: look-ups and the query catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.functions.phrases import normalize_phrase
from wordloom.functions.text import sentences
from wordloom.operators import lexicon as lx
from wordloom.operators import lookup as lk
from wordloom.plans import standins as si
from wordloom.plans.oracle import NORMALIZED, with_ctes

NOW = "2024-03-01 12:00:00"
FIRST_TURN = 1_000_000_000
TURN_CHARS = 16
KEYWORDS = ("THE ", "DE ", "DER ")


def _proverbs(spark: SparkSession, sf: str) -> DataFrame:
    return lx.first_meanings(si.proverb_rows(spark, sf))


def search(spark: SparkSession, sf: str) -> DataFrame:
    """Every white-space token and every whole turn of the conversations, looked up."""
    talk = si.table(spark, sf, "conversations")
    words = talk.select(F.explode(F.split("text", r"\s+")).alias("term"))
    phrases = talk.select(F.concat(F.lit(" "), "text").alias("term"))
    peri = _proverbs(spark, sf)
    own = peri.select(F.upper("peribahasa").alias("term"))
    return lk.search(words.unionByName(phrases).unionByName(own), si.lexicon(spark, sf), peri).select(
        "term", "type", "word_count", "POS", "meaning"
    )


def proverb_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """First sentences of documents and of conversation turns, asked as proverbs."""
    own = si.proverb_rows(spark, sf).select("peribahasa")
    others = si.table(spark, sf, "conversations").select(
        normalize_phrase(sentences(F.col("text"))[0]).alias("peribahasa")
    )
    return lk.find_proverbs(own.unionByName(others).distinct(), _proverbs(spark, sf))


def query_catalog(spark: SparkSession, sf: str) -> DataFrame:
    """Stored: one entry per benchmark item. New: the last valid turn of each conversation,
    under the same kind of name, so some names are overwritten."""
    stored = si.table(spark, sf, "benchmark").select(
        F.concat(F.lit("query-"), F.col("item_id")).alias("name"), F.col("text").alias("query"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("created_at"),
        F.lit("2024-02-01 00:00:00").cast("timestamp").alias("last_used"),
    )
    typed = si.table(spark, sf, "conversations").select(
        F.concat(F.lit("query-"), F.col("conv_id")).alias("name"), F.col("text").alias("query"), "turn"
    )
    last = lk.valid_queries(typed, KEYWORDS).groupBy("name").agg(F.max_by("query", "turn").alias("query"))
    return lk.store_queries(stored, last, NOW)


def paginate(spark: SparkSession, sf: str) -> DataFrame:
    queries = si.table(spark, sf, "documents").select(
        "doc_id", F.concat(F.lit("query-"), F.col("doc_id")).alias("name"), F.col("text").alias("query")
    )
    return lk.list_pages(queries, "doc_id")


def recent_first(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as stored queries, their last order as the last use."""
    used = si.table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.max("o_orderdate").alias("last_used")
    )
    catalog = si.table(spark, sf, "customer").select("c_custkey", F.col("c_name").alias("name")).join(
        used, "c_custkey", "left"
    )
    return lk.recent_first(catalog.select("name", "last_used"))


def _entries(spark: SparkSession, sf: str) -> DataFrame:
    return si.table(spark, sf, "benchmark").select(F.col("item_id").alias("no"), F.col("text").alias("query"))


def append_numbered(spark: SparkSession, sf: str) -> DataFrame:
    new = si.table(spark, sf, "documents").select("doc_id", F.col("text").alias("query"))
    return lk.append_numbered(_entries(spark, sf), new, "doc_id")


def append_contained(spark: SparkSession, sf: str) -> DataFrame:
    """Benchmark passages and the first words of turns as new entries, whole documents as the list."""
    passages = si.table(spark, sf, "benchmark").select(F.col("item_id").cast("bigint").alias("ord"), F.col("text").alias("query"))
    starts = si.table(spark, sf, "conversations").select(
        (F.col("conv_id") * 1000 + F.col("turn") + FIRST_TURN).cast("bigint").alias("ord"), F.left("text", F.lit(TURN_CHARS)).alias("query"))
    listed = si.table(spark, sf, "documents").select(F.col("text").alias("query"))
    return lk.append_numbered(listed, passages.unionByName(starts), "ord", "contains")


def numbered_list(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as the list, one entry removed by its number."""
    entries = si.table(spark, sf, "documents").select(
        F.col("doc_id").alias("no"), F.col("source").alias("query")
    )
    return lk.numbered_list(lk.remove_number(entries, 7))


QUERIES = {
    "q_search": search,
    "q_proverb_lookup": proverb_lookup,
    "q_query_catalog": query_catalog,
    "q_paginate": paginate,
    "q_recent_first": recent_first,
    "q_append_numbered": append_numbered,
    "q_append_contained": append_contained,
    "q_numbered_list": numbered_list,
}

_FIRST = (
    "string_split(regexp_replace(text, '([.!?]) +', '\\1' || chr(1), 'g'), chr(1))[1]"
)

ORACLES = {
    "q_search": with_ctes("lex", "proverbs") + r"""
        , asked AS (SELECT DISTINCT trim(lower(term)) AS term FROM (
            SELECT unnest(string_split_regex(text, '\s+')) AS term FROM conversations
            UNION ALL SELECT ' ' || text FROM conversations
            UNION ALL SELECT upper(peribahasa) FROM proverbs))
        SELECT term, 'WORD' AS type, word_count, POS, NULL AS meaning FROM asked JOIN lex ON word = term
        UNION ALL
        SELECT term, 'PERIBAHASA', NULL, NULL, meaning FROM asked JOIN proverbs ON peribahasa = term""",
    "q_proverb_lookup": with_ctes("peri", "proverbs") + f"""
        , asked AS (SELECT peribahasa FROM peri
                    UNION SELECT {NORMALIZED.format(_FIRST)} FROM conversations)
        SELECT a.peribahasa,
               CASE WHEN NOT regexp_matches(a.peribahasa, '^[a-z]') THEN 'Invalid first letter of the proverb.'
                    ELSE coalesce(p.meaning, 'Proverb not found.') END AS answer
        FROM asked a LEFT JOIN proverbs p ON p.peribahasa = a.peribahasa""",
    "q_query_catalog": f"""
        WITH new AS (
          SELECT 'query-' || conv_id AS name, arg_max(text, turn) AS query FROM conversations
          WHERE {" OR ".join(f"contains(upper(text), '{k}')" for k in KEYWORDS)} GROUP BY conv_id)
        SELECT 'query-' || item_id AS name, text AS query, TIMESTAMP '2024-01-01 00:00:00' AS created_at,
               TIMESTAMP '2024-02-01 00:00:00' AS last_used
        FROM benchmark WHERE 'query-' || item_id NOT IN (SELECT name FROM new)
        UNION ALL SELECT name, query, TIMESTAMP '{NOW}', NULL FROM new""",
    "q_paginate": """
        SELECT CAST(ceil(no / 10) AS BIGINT) AS page, no, name, query FROM (
          SELECT row_number() OVER (ORDER BY doc_id) AS no, 'query-' || doc_id AS name,
                 CASE WHEN length(text) > 100 THEN left(text, 100) || '...' ELSE text END AS query
          FROM documents)""",
    "q_recent_first": """
        SELECT c_name AS name, max(o_orderdate) AS last_used
        FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey, c_name
        ORDER BY last_used DESC NULLS LAST, name DESC""",
    "q_append_numbered": """
        SELECT (SELECT count(*) FROM benchmark) + row_number() OVER (ORDER BY ord) - 1 AS no, query FROM (
          SELECT text AS query, min(doc_id) AS ord FROM documents
          WHERE text NOT IN (SELECT text FROM benchmark) GROUP BY text)""",
    "q_append_contained": f"""
        WITH new AS (
          SELECT query, min(ord) AS ord FROM (
            SELECT item_id AS ord, text AS query FROM benchmark
            UNION ALL SELECT conv_id * 1000 + turn + {FIRST_TURN}, left(text, {TURN_CHARS}) FROM conversations)
          GROUP BY query)
        SELECT (SELECT count(*) FROM documents) + row_number() OVER (ORDER BY ord) - 1 AS no, query FROM new n
        WHERE query <> '' AND NOT EXISTS (SELECT 1 FROM documents d WHERE contains(d.text, n.query))
          AND NOT EXISTS (SELECT 1 FROM new e WHERE e.ord < n.ord AND contains(e.query, n.query))""",
    "q_numbered_list": """
        SELECT row_number() OVER (ORDER BY doc_id) AS place, source AS query FROM documents WHERE doc_id <> 7""",
}
