"""Counts, shares, lengths, morphology, coverage and overlap."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.functions.phrases import normalize_phrase, trim_all

DENSITY_POINTS = 200


def length_counts(words: DataFrame, column: str = "word") -> DataFrame:
    """Words per length; everything about lengths derives from this small table."""
    return words.groupBy(F.length(column).alias("length")).agg(F.count(F.lit(1)).alias("n"))


def length_stats(words: DataFrame, column: str = "word") -> DataFrame:
    """Number, mean and most frequent length; of equally frequent ones the smallest."""
    return length_counts(words, column).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("words"),
        F.try_divide(F.sum(F.col("length") * F.col("n")).cast("double"), F.sum("n")).alias(
            "avg_word_length"
        ),
        F.min_by("length", F.struct(-F.col("n"), F.col("length"))).alias("most_freq_length"),
    )


def length_histogram(words: DataFrame, column: str = "word") -> DataFrame:
    """Equal-width bins, as many as max - min, the last one closed; one bin if all are equal."""
    counts = length_counts(words, column)
    low = counts.agg(F.min("length")).scalar()
    high = counts.agg(F.max("length")).scalar()
    bins = F.greatest(high - low, F.lit(1))
    width = F.greatest(high - low, F.lit(1)) / bins
    bin_no = F.least(F.floor((F.col("length") - low) / width), bins - 1).cast("int")
    return (
        counts.withColumn("bin", bin_no)
        .groupBy("bin").agg(F.sum("n").alias("total_count"))
        .select(
            "bin",
            (low + F.col("bin") * width).cast("double").alias("bin_from"),
            (low + (F.col("bin") + 1) * width).cast("double").alias("bin_to"),
            "total_count",
        )
    )


def length_density(words: DataFrame, column: str = "word", points: int = DENSITY_POINTS) -> DataFrame:
    """Gaussian density over an even grid from min to max, bandwidth by Scott's rule.

    One word, or words of one length, have no bandwidth and give no curve.

    The lengths are few and weighted by their counts; each is spread over the fixed grid
    and the grid points are summed up.
    """
    counts = length_counts(words, column)
    total = F.sum("n")
    mean = F.sum(F.col("length") * F.col("n")) / total
    squares = F.sum(F.col("length") * F.col("length") * F.col("n"))
    deviation = F.sqrt(F.greatest(F.try_divide(squares - total * mean * mean, total - 1), F.lit(0.0)))
    shape = counts.agg(
        F.struct(
            F.min("length").alias("low"), F.max("length").alias("high"), total.alias("n"),
            (deviation * F.pow(total.cast("double"), F.lit(-0.2))).alias("h"),
        )
    ).scalar()
    spread = counts.where(shape["h"] > 0).select(
        "length", "n", shape.alias("s"), F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point")
    )
    x = F.col("s.low") + (F.col("s.high") - F.col("s.low")) * F.col("point") / F.lit(points - 1)
    z = (x - F.col("length")) / F.col("s.h")
    kernel = F.exp(-z * z / 2) / (F.sqrt(F.lit(2.0) * F.pi()) * F.col("s.h"))
    return spread.groupBy("point", x.alias("x")).agg(
        F.sum(F.col("n") * kernel / F.col("s.n")).alias("density")
    )


def lemma_words(edges: DataFrame) -> DataFrame:
    """Distinct base forms that lemma edges point to."""
    return edges.where(F.col("rel") == "LEMMATIZED").select(F.col("dst").alias("word")).distinct()


def totals(lexicon: DataFrame, proverbs: DataFrame) -> DataFrame:
    """Words and proverbs in one row; an empty table counts 0."""
    tagged = lexicon.select(F.lit(True).alias("is_word")).unionAll(
        proverbs.select(F.lit(False).alias("is_word"))
    )
    return tagged.agg(
        F.count_if("is_word").alias("totalWords"), F.count_if(~F.col("is_word")).alias("totalPeri")
    )


def value_counts(df: DataFrame, column: str, name: str | None = None) -> DataFrame:
    """Rows per value, most frequent first, null kept as a value."""
    name = name or column
    return (
        df.groupBy(F.col(column).alias(name)).agg(F.count(F.lit(1)).alias("total_count"))
        .orderBy(F.desc("total_count"), F.asc(name))
    )


def shares(df: DataFrame, column: str) -> DataFrame:
    """Percentage per value with one decimal."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("total_count"))
    total = counts.agg(F.sum("total_count")).scalar()
    return counts.withColumn("percent", F.round(F.col("total_count") * 100.0 / total, 1))


def cloud_weights(df: DataFrame, column: str) -> DataFrame:
    """Frequency relative to the most frequent value."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("total_count"))
    top = counts.agg(F.max("total_count")).scalar()
    return counts.withColumn("weight", F.col("total_count") / top)


def top_words(lexicon: DataFrame, n: int = 15) -> DataFrame:
    """Most counted words; equal counts in alphabetical order."""
    return (
        lexicon.select("word", F.col("word_count").alias("count"))
        .orderBy(F.desc("count"), "word").limit(n)
    )


def top_words_without(lexicon: DataFrame, stopwords: DataFrame, pool: int = 1500, n: int = 15) -> DataFrame:
    """Stop words are taken out of the first ``pool`` words, not out of the whole lexicon."""
    kept = top_words(lexicon, pool).join(stopwords.select("word").distinct(), "word", "left_anti")
    return kept.orderBy(F.desc("count"), "word").limit(n)


def morphology(stemmed: DataFrame) -> DataFrame:
    """Prefix and suffix around the first place of the stem in the word.

    ``stemmed``: ``word, stem``. A word equal to its stem, or one that does not hold its
    stem, has neither.
    """
    at = F.instr(F.col("word"), F.col("stem"))
    split = (F.col("word") != F.col("stem")) & (at > 0)
    return stemmed.select(
        "word",
        "stem",
        F.when(split, F.left("word", at - 1)).alias("prefix"),
        F.when(split, F.substr("word", at + F.length("stem"))).alias("suffix"),
        F.trim("stem").alias("core_word"),
    )


def prefix_counts(morphology: DataFrame) -> DataFrame:
    prefixes = morphology.select(F.trim("prefix").alias("prefix")).where(F.col("prefix") != "")
    return value_counts(prefixes, "prefix")


def suffix_counts(morphology: DataFrame) -> DataFrame:
    """Suffixes that start with a hyphen (reduplication) are left out."""
    suffixes = morphology.select(F.trim("suffix").alias("suffix")).where(
        (F.col("suffix") != "") & ~F.startswith("suffix", F.lit("-"))
    )
    return value_counts(suffixes, "suffix")


def length_pairs(morphology: DataFrame) -> DataFrame:
    return morphology.groupBy(
        F.length("word").alias("word_length"), F.length("stem").alias("stem_length")
    ).agg(F.count(F.lit(1)).alias("count"))


def _token_set(text: Column) -> Column:
    return F.filter(F.array_distinct(F.split(normalize_phrase(text), " ")), lambda t: t != "")


def definition_overlap(own: DataFrame, external: DataFrame) -> DataFrame:
    """Share of the first external definition's words that the own definitions have.

    Both tables: ``word, definitions``. An empty external definition gives null.
    """
    theirs = _token_set(F.get("e.definitions", F.lit(0)))
    ours = _token_set(F.array_join("o.definitions", " "))
    joined = own.alias("o").join(external.alias("e"), "word")
    shared = F.size(F.array_intersect(theirs, ours))
    return joined.select("word", F.try_divide(shared, F.size(theirs)).alias("overlap"))


def is_covered(definitions: Column) -> Column:
    return F.coalesce(F.exists(definitions, lambda d: trim_all(d) != ""), F.lit(False))


def coverage(lexicon: DataFrame) -> DataFrame:
    """Words, words with a definition that is not blank, and their percentage."""
    total = F.count(F.lit(1))
    covered = F.count_if(is_covered(F.col("definitions")))
    return lexicon.agg(
        total.alias("TotalWords"),
        covered.alias("CoveredWords"),
        F.coalesce(F.try_divide(covered * 100.0, total), F.lit(0.0)).alias("CoverPercentage"),
    )


def uncovered(lexicon: DataFrame) -> DataFrame:
    return (
        lexicon.where(~is_covered(F.col("definitions"))).select("word", "word_count")
        .orderBy(F.desc("word_count"), "word")
    )


def pos_lookup(words: DataFrame, lexicon: DataFrame) -> DataFrame:
    """POS of each asked word; unknown words come back empty."""
    return words.join(lexicon.select("word", F.col("POS").alias("pos")), "word", "left")
