"""The analyses of a finished lexicon as result messages, one topic each."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.operators import analytics as an
from wordloom.plans.cycle import Lexicon
from wordloom.sources.messages import as_messages


def analysis_tables(lexicon: Lexicon, stems: DataFrame, stopwords: DataFrame) -> dict[str, DataFrame]:
    """Result table per topic. ``stems``: ``word, stem`` of every word.

    Lengths come as counts per length instead of one list of all words' lengths.
    """
    words = lexicon.words
    lemmas = an.lemma_words(lexicon.edges)
    return {
        "lemma_length_analysis": _lengths(lemmas),
        "word_length_analysis": _lengths(words),
        "lexicon_analysis": an.totals(words, lexicon.proverbs),
        "sentiment_dist_analysis": an.value_counts(words, "Label", "label"),
        "word_freq_with_stopwords": an.top_words(words),
        "word_freq_without_stopwords": an.top_words_without(words, stopwords),
        "POSDistribution": an.value_counts(words, "POS", "pos"),
        "morphological_analysis": an.morphology(stems),
        "intrinsic_coverage": an.coverage(words),
        "intrinsic_uncovered": an.uncovered(words),
    }


def _lengths(words: DataFrame) -> DataFrame:
    """Length statistics with the counts per length, a list as short as the longest word."""
    stats = an.length_stats(words)
    per_length = an.length_counts(words).agg(
        F.sort_array(F.collect_list(F.struct("length", "n"))).alias("word_lengths")
    )
    return stats.withColumn("word_lengths", per_length.scalar())


def analysis_messages(tables: dict[str, DataFrame]) -> DataFrame:
    """One message per result row, ready for ``write_log``."""
    return reduce(DataFrame.unionByName, [as_messages(df, topic) for topic, df in tables.items()])
