"""Registered queries: lexicon analyses and intrinsic evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.operators import analytics as an
from wordloom.operators import lexicon as lx
from wordloom.operators.tagging import vote_in_texts
from wordloom.operators import stemming as st
from wordloom.plans import standins as si
from wordloom.plans.oracle import with_ctes

STOP_POOL = 100


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def word_length_stats(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(an.length_stats(si.counts(spark, sf)), "avg_word_length")


def lemma_length_stats(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(an.length_stats(an.lemma_words(si.lemma_edges(spark, sf))), "avg_word_length")


def lexicon_totals(spark: SparkSession, sf: str) -> DataFrame:
    return an.totals(si.lexicon(spark, sf), lx.first_meanings(si.proverb_rows(spark, sf)))


def label_dist(spark: SparkSession, sf: str) -> DataFrame:
    return an.value_counts(si.lexicon(spark, sf), "Label", "label")


def pos_dist(spark: SparkSession, sf: str) -> DataFrame:
    return an.value_counts(si.lexicon(spark, sf), "POS", "pos")


def top_words(spark: SparkSession, sf: str) -> DataFrame:
    return an.top_words(si.lexicon(spark, sf))


def top_words_nostop(spark: SparkSession, sf: str) -> DataFrame:
    """Stop words by rule: those among the most counted words of the conversations."""
    talk = si.counts(spark, sf, "conversations").withColumnRenamed("count", "word_count")
    return an.top_words_without(si.lexicon(spark, sf), an.top_words(talk, STOP_POOL))


def morphology(spark: SparkSession, sf: str) -> DataFrame:
    words = si.counts(spark, sf).select("word")
    stems = lx.stem_by_suffix(words, si.dictionary(spark, sf), si.SUFFIXES)
    return an.morphology(stems.select("word", F.col("base").alias("stem")))


def base_forms(spark: SparkSession, sf: str) -> DataFrame:
    """Base forms of the words of documents and turns; the words of documents are the dictionary."""
    known = si.counts(spark, sf).select("word")
    joined = si.table(spark, sf, "benchmark").select(F.explode(F.split(F.lower("text"), r"[^a-z]+")).alias("a"))
    made = known.select(F.concat(F.lit("me"), "word", F.lit("kan")).alias("word")).unionByName(
        si.counts(spark, sf, "conversations").select("word")).unionByName(
        joined.where("a != ''").select(F.concat("a", F.lit("-"), "a", F.lit("nya")).alias("word")))
    return st.base_forms(made, known)


def prefix_freq(spark: SparkSession, sf: str) -> DataFrame:
    """Prefixes of the words whose stem is the word without its first two letters."""
    words = si.counts(spark, sf).select("word").where(F.length("word") > 2)
    cut = words.select("word", F.substr("word", F.lit(3)).alias("stem"))
    known = cut.join(si.dictionary(spark, sf).select(F.col("word").alias("stem")), "stem", "left_semi")
    return an.prefix_counts(an.morphology(known.select("word", "stem")))


def suffix_freq(spark: SparkSession, sf: str) -> DataFrame:
    return an.suffix_counts(morphology(spark, sf))


def length_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return an.length_pairs(morphology(spark, sf))


def length_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return an.length_histogram(si.counts(spark, sf))


def length_density(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(an.length_density(si.counts(spark, sf)), "x", "density")


def label_share(spark: SparkSession, sf: str) -> DataFrame:
    return an.shares(si.lexicon(spark, sf), "Label")


def sentence_emotion(spark: SparkSession, sf: str) -> DataFrame:
    return vote_in_texts(si.table(spark, sf, "documents"), "text", "doc_id", si.emotion_table(spark, sf))


def emotion_dist(spark: SparkSession, sf: str) -> DataFrame:
    return an.value_counts(sentence_emotion(spark, sf), "label")


def cloud_weights(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(an.cloud_weights(sentence_emotion(spark, sf), "label"), "weight")


def definition_overlap(spark: SparkSession, sf: str) -> DataFrame:
    overlap = an.definition_overlap(si.lexicon(spark, sf), si.external_definitions(spark, sf))
    return _rounded(overlap, "overlap")


def _words_with_definitions(spark: SparkSession, sf: str) -> DataFrame:
    """All document words, most without a definition."""
    meanings = si.dictionary(spark, sf).select("word", F.col("meanings").alias("definitions"))
    return si.counts(spark, sf).withColumnRenamed("count", "word_count").join(meanings, "word", "left")


def coverage(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(an.coverage(_words_with_definitions(spark, sf)), "CoverPercentage")


def uncovered(spark: SparkSession, sf: str) -> DataFrame:
    return an.uncovered(_words_with_definitions(spark, sf))


def pos_lookup(spark: SparkSession, sf: str) -> DataFrame:
    asked = si.counts(spark, sf, "conversations").select("word")
    return an.pos_lookup(asked, si.lexicon(spark, sf))


QUERIES = {
    "q_word_length_stats": word_length_stats,
    "q_lemma_length_stats": lemma_length_stats,
    "q_lexicon_totals": lexicon_totals,
    "q_label_dist": label_dist,
    "q_pos_dist": pos_dist,
    "q_top_words": top_words,
    "q_top_words_nostop": top_words_nostop,
    "q_morphology": morphology,
    "q_base_forms": base_forms,
    "q_prefix_freq": prefix_freq,
    "q_suffix_freq": suffix_freq,
    "q_length_pairs": length_pairs,
    "q_length_histogram": length_histogram,
    "q_length_density": length_density,
    "q_label_share": label_share,
    "q_sentence_emotion": sentence_emotion,
    "q_emotion_dist": emotion_dist,
    "q_cloud_weights": cloud_weights,
    "q_definition_overlap": definition_overlap,
    "q_coverage": coverage,
    "q_uncovered": uncovered,
    "q_pos_lookup": pos_lookup,
}


def _stats_sql(words: str) -> str:
    return f"""
        SELECT count(*) AS words, round(avg(length(word)), 6) AS avg_word_length,
               (SELECT length(word) FROM {words} GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS most_freq_length
        FROM {words}"""


def _word_set(text: str) -> str:
    clean = f"regexp_replace({text}, '[^\\p{{L}}\\p{{N}}_\\s]', '', 'g')"
    return f"list_distinct(list_filter(string_split_regex(lower({clean}), '\\s+'), lambda t: t <> ''))"


ORACLES = {
    "q_word_length_stats": with_ctes("wc") + _stats_sql("wc"),
    "q_lemma_length_stats": with_ctes("lemma") + ", w AS (SELECT DISTINCT dst AS word FROM lemma)"
    + _stats_sql("w"),
    "q_lexicon_totals": with_ctes("lex", "proverbs") + """
        SELECT (SELECT count(*) FROM lex) AS totalWords, (SELECT count(*) FROM proverbs) AS totalPeri""",
    "q_label_dist": with_ctes("lex") + "SELECT Label AS label, count(*) AS total_count FROM lex GROUP BY 1",
    "q_pos_dist": with_ctes("lex") + "SELECT POS AS pos, count(*) AS total_count FROM lex GROUP BY 1",
    "q_top_words": with_ctes("lex") + """
        SELECT word, word_count AS count FROM lex ORDER BY word_count DESC, word LIMIT 15""",
    "q_top_words_nostop": with_ctes("lex", "cwc") + f"""
        , stop AS (SELECT word FROM cwc ORDER BY n DESC, word LIMIT {STOP_POOL}),
        pool AS (SELECT word, word_count FROM lex ORDER BY word_count DESC, word LIMIT 1500)
        SELECT word, word_count AS count FROM pool WHERE word NOT IN (SELECT word FROM stop)
        ORDER BY word_count DESC, word LIMIT 15""",
    "q_morphology": with_ctes("morph") + "SELECT word, stem, prefix, suffix, core_word FROM morph",
    "q_base_forms": with_ctes("wc", "cwc") + f"""
        , prefixes(prefix, "before", lost, kind, n) AS (VALUES {", ".join(map(str, st.prefix_rules()))})
        , suffixes(suffix, forms, m) AS (VALUES {", ".join(map(str, st.suffix_rules()))})
        , words AS (
          SELECT 'me' || word || 'kan' AS word FROM wc UNION SELECT word FROM cwc
          UNION SELECT a || '-' || a || 'nya'
          FROM (SELECT unnest(string_split_regex(lower(text), '[^a-z]+')) AS a FROM benchmark) WHERE a <> '')
        , parts AS (
          SELECT word, string_split(word, '-') AS h,
                 len(string_split(word, '-')) = 2 AND word NOT LIKE '-%' AND word NOT LIKE '%-' AS twice FROM words)
        , forms AS (
          SELECT word, 0 AS half, word AS form, 0 AS halves FROM parts
          UNION SELECT word, 1, h[1], CASE WHEN h[1] = h[2] THEN 1 ELSE 2 END FROM parts WHERE twice
          UNION SELECT word, 2, h[2], 2 FROM parts WHERE twice AND h[1] <> h[2])
        , cut AS (
          SELECT word, half, halves, lost, "before", n + m AS affixes,
                 substr(form, length(prefix) + 1, length(form) - length(prefix) - length(suffix)) AS bare
          FROM forms JOIN prefixes ON starts_with(form, prefix) JOIN suffixes ON ends_with(form, suffix)
          WHERE length(form) - length(prefix) - length(suffix) >= {st.SHORTEST}
            AND (kind, forms) NOT IN ({", ".join(map(str, st.NEVER))}))
        , stems AS (
          SELECT word, half, halves, lost || bare AS stem, min(affixes) AS affixes FROM cut
          WHERE "before" = '' OR contains("before", left(bare, 1)) GROUP BY ALL)
        , ways AS (
          SELECT word, stem, affixes FROM stems WHERE half = 0
          UNION ALL SELECT word, stem, sum(affixes) + 1 FROM stems WHERE half > 0
          GROUP BY word, stem, halves HAVING count(*) = halves)
        SELECT w.word, b.base FROM words w LEFT JOIN (
          SELECT word, arg_min(stem, (affixes, -length(stem), stem)) AS base FROM ways
          WHERE stem IN (SELECT word FROM wc) GROUP BY word) b ON b.word = w.word""",
    "q_prefix_freq": with_ctes("wc", "dict") + """
        SELECT prefix, count(*) AS total_count FROM (
          SELECT left(word, instr(word, stem) - 1) AS prefix
          FROM (SELECT word, substr(word, 3) AS stem FROM wc WHERE length(word) > 2)
          WHERE stem IN (SELECT word FROM dict) AND word <> stem)
        WHERE prefix <> '' GROUP BY prefix""",
    "q_suffix_freq": with_ctes("morph") + """
        SELECT trim(suffix) AS suffix, count(*) AS total_count FROM morph
        WHERE trim(suffix) <> '' AND NOT starts_with(trim(suffix), '-') GROUP BY 1""",
    "q_length_pairs": with_ctes("morph") + """
        SELECT length(word) AS word_length, length(stem) AS stem_length, count(*) AS count
        FROM morph GROUP BY 1, 2""",
    "q_length_histogram": with_ctes("wc") + """
        , b AS (SELECT min(length(word)) AS lo, max(length(word)) AS hi FROM wc)
        SELECT bin, CAST(lo + bin AS DOUBLE) AS bin_from, CAST(lo + bin + 1 AS DOUBLE) AS bin_to,
               count(*) AS total_count
        FROM (SELECT lo, least(length(word) - lo, greatest(hi - lo, 1) - 1) AS bin FROM wc, b)
        GROUP BY bin, lo""",
    "q_length_density": with_ctes("wc") + """
        , s AS (SELECT min(length(word)) AS lo, max(length(word)) AS hi, count(*) AS n,
                       stddev_samp(length(word)) * pow(count(*), -0.2) AS h FROM wc),
        c AS (SELECT length(word) AS len, count(*) AS k FROM wc GROUP BY 1),
        g AS (SELECT i AS point, lo + (hi - lo) * i / 199.0::DOUBLE AS x, n, h
              FROM s, (SELECT unnest(range(200)) AS i))
        SELECT point, round(x, 6) AS x,
               round(sum(k * exp(-pow((x - len) / h, 2) / 2) / (sqrt(2 * pi()) * h) / n), 6) AS density
        FROM g, c GROUP BY point, x""",
    "q_label_share": with_ctes("lex") + """
        SELECT Label, count(*) AS total_count, round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (), 1) AS percent
        FROM lex GROUP BY Label""",
    "q_sentence_emotion": with_ctes("sentemo") + "SELECT doc_id, sent_pos, label FROM sentemo",
    "q_emotion_dist": with_ctes("sentemo") + "SELECT label, count(*) AS total_count FROM sentemo GROUP BY 1",
    "q_cloud_weights": with_ctes("sentemo") + """
        SELECT label, count(*) AS total_count, round(count(*) / max(count(*)) OVER (), 6) AS weight
        FROM sentemo GROUP BY 1""",
    "q_definition_overlap": with_ctes("lex", "extdef") + f"""
        SELECT word, round(len(list_intersect(a, b)) / len(a), 6) AS overlap FROM (
          SELECT l.word, {_word_set("e.definition")} AS a,
                 {_word_set("array_to_string(l.definitions, ' ')")} AS b
          FROM lex l JOIN extdef e ON l.word = e.word)""",
    "q_coverage": with_ctes("wc", "dict") + """
        SELECT count(*) AS TotalWords, count(d.word) AS CoveredWords,
               round(count(d.word) * 100.0 / count(*), 6) AS CoverPercentage
        FROM wc LEFT JOIN dict d ON d.word = wc.word""",
    "q_uncovered": with_ctes("wc", "dict") + """
        SELECT word, n AS word_count FROM wc WHERE word NOT IN (SELECT word FROM dict)""",
    "q_pos_lookup": with_ctes("cwc", "lex") + """
        SELECT c.word, l.POS AS pos FROM cwc c LEFT JOIN lex l ON l.word = c.word""",
}
