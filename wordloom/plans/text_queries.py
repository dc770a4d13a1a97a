"""Registered queries: text preparation, deduplication and messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.functions import text as tx
from wordloom.functions.lists import small_list
from wordloom.operators import analytics as an
from wordloom.operators import records as rc
from wordloom.operators import textprep as tp
from wordloom.operators.pages import page_links
from wordloom.plans import standins as si
from wordloom.plans.oracle import with_ctes
from wordloom.sources import messages as ms
from wordloom.sources.state import newer_than

SINCE = "2024-01-15 00:00:00"
STOP_WORDS = 50
FIRST_N = 25


def word_count(spark: SparkSession, sf: str) -> DataFrame:
    return si.counts(spark, sf).orderBy("word")


def sentences(spark: SparkSession, sf: str) -> DataFrame:
    return tp.sentence_rows(si.table(spark, sf, "documents"), "text", ["doc_id"])


def tokens(spark: SparkSession, sf: str) -> DataFrame:
    return tp.sentence_tokens(sentences(spark, sf), ["doc_id", "sent_pos"])


def dedup_url(spark: SparkSession, sf: str) -> DataFrame:
    links = page_links(si.table(spark, sf, "pages"), "page_id")
    return rc.first_per_key(links, "url", F.struct("page_id", "pos"))


def new_articles(spark: SparkSession, sf: str) -> DataFrame:
    url = F.concat(F.lit("doc/"), F.col("doc_id"))
    articles = si.table(spark, sf, "documents").select(url.alias("url"), "lang", "source", "n_chars")
    history = si.table(spark, sf, "labels").select(url.alias("url"))
    return rc.not_yet_processed(articles, history, "url")


def caption_strip(spark: SparkSession, sf: str) -> DataFrame:
    return si.table(spark, sf, "documents").select(
        "doc_id", tx.strip_caption(F.col("text")).alias("brief")
    )


def flatten_turns(spark: SparkSession, sf: str) -> DataFrame:
    return si.table(spark, sf, "conversations").select(
        "conv_id", "turn", tx.flatten(F.split("text", "\n")).alias("flat")
    )


def unpivot_text(spark: SparkSession, sf: str) -> DataFrame:
    return tp.article_texts(si.articles(spark, sf), "page_id")


def doc_tokens_nostop(spark: SparkSession, sf: str) -> DataFrame:
    frequent = an.top_words(si.counts(spark, sf).withColumnRenamed("count", "word_count"), STOP_WORDS)
    stop = small_list(frequent, "word", STOP_WORDS)
    return si.table(spark, sf, "documents").select(
        "doc_id", F.array_join(tp.content_words(F.col("text"), stop), " ").alias("tokens")
    )


def limit_items(spark: SparkSession, sf: str) -> DataFrame:
    docs = si.table(spark, sf, "documents").select("doc_id", "source", "n_chars")
    return docs.orderBy("doc_id").limit(40)


def latest_per_topic(spark: SparkSession, sf: str) -> DataFrame:
    log = si.message_log(si.table(spark, sf, "events"))
    return ms.latest_per_topic(log).select("topic", "offset", "timestamp", "value")


def first_n_per_topic(spark: SparkSession, sf: str) -> DataFrame:
    log = si.message_log(si.table(spark, sf, "events"))
    return ms.first_n_per_topic(log, FIRST_N).select("topic", "rank", "offset", "value")


def result_messages(spark: SparkSession, sf: str) -> DataFrame:
    lexicon = si.lexicon(spark, sf)
    labels = an.value_counts(lexicon, "Label", "label")
    pos = an.value_counts(lexicon, "POS", "pos")
    return ms.as_messages(labels, "sentiment_dist_analysis").unionByName(
        ms.as_messages(pos, "POSDistribution")
    )


def incremental_window(spark: SparkSession, sf: str) -> DataFrame:
    events = si.table(spark, sf, "events").select("event_id", "event_type", "ts")
    return newer_than(events, "ts", F.lit(SINCE).cast("timestamp_ntz"))


QUERIES = {
    "q_word_count": word_count,
    "q_sentences": sentences,
    "q_tokens": tokens,
    "q_dedup_url": dedup_url,
    "q_new_articles": new_articles,
    "q_caption_strip": caption_strip,
    "q_flatten_turns": flatten_turns,
    "q_unpivot_text": unpivot_text,
    "q_doc_tokens_nostop": doc_tokens_nostop,
    "q_limit_items": limit_items,
    "q_latest_per_topic": latest_per_topic,
    "q_first_n_per_topic": first_n_per_topic,
    "q_result_messages": result_messages,
    "q_incremental_window": incremental_window,
}

ORACLES = {
    "q_word_count": with_ctes("wc") + "SELECT word, n AS count FROM wc",
    "q_sentences": with_ctes("sent") + "SELECT doc_id, sent_pos, sentence FROM sent",
    "q_tokens": with_ctes("tok") + "SELECT doc_id, sent_pos, word_pos, word FROM tok",
    "q_dedup_url": r"""
        SELECT page_id, pos, url FROM (
          SELECT page_id, pos, url, row_number() OVER (PARTITION BY url ORDER BY page_id, pos) AS rn
          FROM (SELECT page_id, generate_subscripts(l, 1) - 1 AS pos, unnest(l) AS url
                FROM (SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS l FROM pages)))
        WHERE rn = 1""",
    "q_new_articles": """
        SELECT 'doc/' || doc_id AS url, lang, source, n_chars FROM documents
        WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
    "q_caption_strip": r"""
        SELECT doc_id, regexp_replace(text, '\s?-[^\n]*', '', 'g') AS brief FROM documents""",
    "q_flatten_turns": "SELECT conv_id, turn, replace(text, chr(10), ' ') AS flat FROM conversations",
    "q_unpivot_text": with_ctes("art") + r"""
        SELECT page_id, 'title' AS part, title AS text FROM art
        UNION ALL SELECT page_id, 'brief', regexp_replace(brief, '\s?-[^\n]*', '', 'g') FROM art
        UNION ALL SELECT page_id, 'body', array_to_string(contents, ' ') FROM art""",
    "q_doc_tokens_nostop": with_ctes("wc") + rf"""
        , stop AS (SELECT list(word) AS ws FROM (SELECT word FROM wc ORDER BY n DESC, word LIMIT {STOP_WORDS}))
        SELECT doc_id, array_to_string(list_filter(
                 string_split_regex(lower(regexp_replace(text, '[^a-zA-Z\s]', '', 'g')), '\s+'),
                 lambda w: w <> '' AND NOT list_contains(ws, w)), ' ') AS tokens
        FROM documents, stop""",
    "q_limit_items": "SELECT doc_id, source, n_chars FROM documents ORDER BY doc_id LIMIT 40",
    "q_latest_per_topic": """
        SELECT event_type AS topic, max(event_id) AS "offset", arg_max(ts, event_id) AS "timestamp",
               arg_max(props, event_id) AS "value"
        FROM events GROUP BY event_type""",
    "q_first_n_per_topic": f"""
        SELECT topic, rank, "offset", "value" FROM (
          SELECT event_type AS topic, event_id AS "offset", props AS "value",
                 row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS rank FROM events)
        WHERE rank <= {FIRST_N}""",
    "q_result_messages": with_ctes("lex") + """
        SELECT 'sentiment_dist_analysis' AS topic, 0 AS "partition",
               '{"label":"' || Label || '","total_count":' || count(*) || '}' AS "value"
        FROM lex GROUP BY Label
        UNION ALL
        SELECT 'POSDistribution', 0, '{"pos":"' || POS || '","total_count":' || count(*) || '}'
        FROM lex GROUP BY POS""",
    "q_incremental_window": f"SELECT event_id, event_type, ts FROM events WHERE ts > TIMESTAMP '{SINCE}'",
}
