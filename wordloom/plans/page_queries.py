"""Registered queries: extraction from pages and phrases."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.functions import html as hx
from wordloom.functions import text as tx
from wordloom.functions.phrases import ABBREVIATIONS, expand_abbreviations, normalize_phrase
from wordloom.functions.senses import numbered_senses
from wordloom.functions.times import MONTHS, parse_publish_time
from wordloom.operators.pages import page_links
from wordloom.operators.records import newer_prefix
from wordloom.operators.spelling import correct_words
from wordloom.plans import standins as si
from wordloom.plans.oracle import NORMALIZED, with_ctes
from wordloom.session import staged

REFERENCE_TIME = "2024-02-01 00:00:00"
ORDERS_SINCE = "1995-06-01 00:00:00"
# Words of the documents written short, so that there is something to expand.
SHORTENED = {"the": "yg", "and": "dgn", "of": "drpd", "de": "dll", "la": "dlm", "in": "pd"}


def page_fields(spark: SparkSession, sf: str) -> DataFrame:
    return si.articles(spark, sf).select(
        "page_id", "url", "title", F.col("authorDetails.authName").alias("author"),
        F.col("authorDetails.relLink").alias("rel_link"), F.col("authorDetails.email").alias("email"),
        F.col("publishTime").alias("publish_text"), F.col("articleBrief").alias("brief"),
        F.size("contents").alias("paragraphs"),
    )


def page_paragraphs(spark: SparkSession, sf: str) -> DataFrame:
    return si.table(spark, sf, "pages").select(
        "page_id", F.posexplode(hx.paragraphs(F.col("html"))).alias("pos", "paragraph")
    )


def links(spark: SparkSession, sf: str) -> DataFrame:
    return page_links(si.table(spark, sf, "pages"), "page_id").select("page_id", "url").distinct()


def take_newer_prefix(spark: SparkSession, sf: str) -> DataFrame:
    orders = si.table(spark, sf, "orders").select(
        "o_custkey", "o_orderkey", (-F.col("o_orderkey")).alias("rank"), "o_orderdate"
    )
    since = F.lit(ORDERS_SINCE).cast("timestamp_ntz")
    return newer_prefix(orders, "o_custkey", "rank", "o_orderdate", since).drop("rank")


def publish_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Publish texts of every form, written from the event times."""
    names = F.array(*[F.lit(m) for m in MONTHS])
    kind = F.col("event_type")
    written = F.concat(
        F.get(names, F.month("ts") - 1), F.date_format("ts", " d, yyyy @ "),
        F.lower(F.date_format("ts", "h:mma")),
    )
    text = (
        F.when(kind == "click", written).when(kind == "view", "sejam lalu")
        .when(kind == "error", F.concat(F.col("user_id"), F.lit(" jam lalu")))
        .when(kind == "signup", "seminit lalu")
        .otherwise(F.concat(F.col("user_id"), F.lit(" minit lalu")))
    )
    return si.table(spark, sf, "events").select("event_id", text.alias("publish_text"))


def publish_time(spark: SparkSession, sf: str) -> DataFrame:
    reference = F.lit(REFERENCE_TIME).cast("timestamp")
    return publish_texts(spark, sf).withColumn(
        "published_at", parse_publish_time(F.col("publish_text"), reference).cast("timestamp_ntz")
    )


def senses(spark: SparkSession, sf: str) -> DataFrame:
    """Sentences of each benchmark item as senses; every third number is given twice."""
    numbered = F.transform(
        tx.sentences(F.col("text")),
        lambda s, i: F.concat((i + 1 - F.floor((i + 1) / 3)).cast("string"), F.lit(". "), s),
    )
    return si.table(spark, sf, "benchmark").select(
        "item_id",
        F.posexplode(numbered_senses(F.array_join(numbered, " "))).alias("pos", "sense"),
    )


def phrases(spark: SparkSession, sf: str) -> DataFrame:
    return si.table(spark, sf, "documents").select(
        "doc_id", normalize_phrase(F.col("text")).alias("phrase")
    )


def expanded(spark: SparkSession, sf: str) -> DataFrame:
    text = F.lower("text")
    for word, short in SHORTENED.items():
        text = F.replace(text, F.lit(f" {word} "), F.lit(f" {short} "))
    return si.table(spark, sf, "documents").select(
        "doc_id", expand_abbreviations(text).alias("expanded")
    )


def spell_correct(spark: SparkSession, sf: str) -> DataFrame:
    """Words seen less than five times, corrected by the others."""
    counts = staged(si.counts(spark, sf), "counts")
    return correct_words(counts.where(F.col("count") < 5), counts.where(F.col("count") >= 5))


QUERIES = {
    "q_page_fields": page_fields,
    "q_page_paragraphs": page_paragraphs,
    "q_page_links": links,
    "q_take_newer_prefix": take_newer_prefix,
    "q_parse_publish_time": publish_time,
    "q_numbered_senses": senses,
    "q_normalize_phrase": phrases,
    "q_expand_abbrev": expanded,
    "q_spell_correct": spell_correct,
}


def _expand_sql() -> str:
    text = "lower(text)"
    for word, short in SHORTENED.items():
        text = f"replace({text}, ' {word} ', ' {short} ')"
    text = f"' ' || trim(regexp_replace({text}, '\\s+', ' ', 'g')) || ' '"
    for short, full in ABBREVIATIONS.items():
        # twice, as one space may belong to two neighbouring matches
        for _ in range(2):
            text = (
                f"regexp_replace({text}, '([^\\p{{L}}\\p{{N}}_]){short}([^\\p{{L}}\\p{{N}}_])', "
                f"'\\1{full}\\2', 'g')"
            )
    return f"SELECT doc_id, substr(t, 2, length(t) - 2) AS expanded FROM (SELECT doc_id, {text} AS t FROM documents)"


def _deletes(table: str) -> str:
    """Each word with what is left of it after up to two letters go."""
    return f"""
      SELECT DISTINCT word, key FROM (
        SELECT word, word AS key FROM {table}
        UNION ALL SELECT word, left(word, i - 1) || substr(word, i + 1)
        FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM {table})
        UNION ALL SELECT word, left(word, i - 1) || substr(word, i + 1, j - i - 1) || substr(word, j + 1)
        FROM (SELECT word, i, unnest(range(i + 1, length(word) + 1)) AS j
              FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM {table})))"""


ORACLES = {
    "q_spell_correct": with_ctes("wc") + f""", asked AS (SELECT word FROM wc WHERE n < 5),
      known AS (SELECT word, n FROM wc WHERE n >= 5),
      a AS ({_deletes("asked")}), k AS ({_deletes("known")}),
      met AS (SELECT DISTINCT a.word, k.word AS term FROM a JOIN k USING (key)),
      best AS (SELECT m.word, min(row(levenshtein(m.word, term), -n, term)) AS b
               FROM met m JOIN known ON known.word = term WHERE levenshtein(m.word, term) <= 2 GROUP BY m.word)
      SELECT word, coalesce(b[3], word) AS corrected, b[1] AS distance FROM asked LEFT JOIN best USING (word)""",
    "q_page_fields": with_ctes("art") + """
        SELECT page_id, url, title, author, rel_link, email, publish_text, brief, len(contents) AS paragraphs
        FROM art""",
    "q_page_paragraphs": r"""
        SELECT page_id, generate_subscripts(ps, 1) - 1 AS pos, unnest(ps) AS paragraph FROM (
          SELECT page_id, list_filter(list_transform(
            string_split_regex(regexp_replace(html, '(?is)<(script|style)[^>]*>.*?</(script|style)>', '', 'g'),
                               '(?i)<p>')[2:],
            lambda p: trim(regexp_replace(replace(replace(replace(replace(regexp_replace(
                string_split_regex(p, '(?i)</p>|</article>|</div>')[1], '<[^>]+>', ' ', 'g'),
                '&quot;', '"'), '&copy;', '©'), '&middot;', '·'), '&amp;', '&'), '\s+', ' ', 'g'))),
            lambda t: t <> '') AS ps FROM pages)""",
    "q_page_links": """
        SELECT DISTINCT page_id, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS url FROM pages""",
    "q_take_newer_prefix": f"""
        SELECT o_custkey, o_orderkey, o_orderdate FROM (
          SELECT *, max(CASE WHEN o_orderdate <= TIMESTAMP '{ORDERS_SINCE}' THEN 1 ELSE 0 END)
                    OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC
                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS stopped
          FROM orders) WHERE stopped = 0""",
    "q_parse_publish_time": f"""
        SELECT event_id,
               CASE event_type
                 WHEN 'click' THEN (['Jan','Feb','Mac','Apr','Mei','Jun','Jul','Ogs','Sep','Okt','Nov','Dis'])[month(ts)]
                      || ' ' || day(ts) || ', ' || year(ts) || ' @ ' || lower(strftime(ts, '%-I:%M%p'))
                 WHEN 'view' THEN 'sejam lalu' WHEN 'error' THEN user_id || ' jam lalu'
                 WHEN 'signup' THEN 'seminit lalu' ELSE user_id || ' minit lalu' END AS publish_text,
               CASE event_type
                 WHEN 'click' THEN date_trunc('minute', ts)
                 WHEN 'view' THEN TIMESTAMP '{REFERENCE_TIME}' - INTERVAL 1 HOUR
                 WHEN 'error' THEN TIMESTAMP '{REFERENCE_TIME}' - to_hours(user_id)
                 WHEN 'signup' THEN TIMESTAMP '{REFERENCE_TIME}' - INTERVAL 1 MINUTE
                 ELSE TIMESTAMP '{REFERENCE_TIME}' - to_minutes(user_id) END AS published_at
        FROM events""",
    "q_numbered_senses": r"""
        WITH numbered AS (
          SELECT item_id, generate_subscripts(parts, 1) AS i, unnest(parts) AS s
          FROM (SELECT item_id, string_split(regexp_replace(text, '([.!?]) +', '\1' || chr(1), 'g'), chr(1)) AS parts
                FROM benchmark)),
        kept AS (
          SELECT item_id, i - (i // 3) AS n, arg_min(s, i) AS s FROM numbered GROUP BY ALL)
        SELECT item_id, n - 1 AS pos, trim(regexp_replace(regexp_extract(s, '^([^:;]*)', 1), '\s+$', '')) AS sense
        FROM kept""",
    "q_normalize_phrase": f"SELECT doc_id, {NORMALIZED.format('text')} AS phrase FROM documents",
    "q_expand_abbrev": _expand_sql(),
}
