"""Spelling correction against a frequency dictionary, within two edits.

Two words are within distance d when both turn into the same skeleton by deleting
letters and by replacing letters at the same place with a blank, with d such steps in
all (a shared blank is one step). So each word lists its skeletons and their cost, the
dictionary keeps its best word per skeleton and cost *before* the join, and the join
meets at most one row per skeleton and cost. Nothing compares words pair by pair, however
many words share a skeleton, and nothing is cut off.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.operators.skew import hot_join
from wordloom.session import staged

BLANK = "\u0001"
MAX_EDITS = 2
#: Letters of the longest dictionary word that is found by its skeletons.
LONG = 24
#: A match is one number: its distance times this, and the dictionary word's place by frequency.
STEP = 1 << 60


def _skeleton(dels: int, blanks: int, *parts: Column) -> Column:
    return F.struct(
        F.concat(*parts).alias("skeleton"), F.lit(dels).alias("dels"), F.lit(blanks).alias("blanks")
    )


def skeletons(words: DataFrame, edits: int, *keep: str) -> DataFrame:
    """``word, skeleton, dels, blanks`` for all ways to take up to ``edits`` steps.

    One row per choice of places, and per choice of deleting or blanking each of them.
    """
    word, i, j = F.col("word"), F.col("i"), F.col("j")
    mark = F.lit(BLANK)
    size = F.length(word)
    placed = words.select("word", *keep, F.explode(F.sequence(F.lit(0), size)).alias("i"))
    second = F.array(F.lit(0))
    if edits == 2:
        later = F.when((i > 0) & (i < size), F.sequence(i + 1, size)).otherwise(
            F.array().cast("array<int>")
        )
        second = F.concat(second, later)
    placed = placed.withColumn("j", F.explode(second))
    head = F.left(word, i - 1)
    tail = F.substr(word, i + 1)
    middle = F.substr(word, i + 1, j - i - 1)
    end = F.substr(word, j + 1)
    shapes = (
        F.when(i == 0, F.array(_skeleton(0, 0, word)))
        .when(j == 0, F.array(_skeleton(1, 0, head, tail), _skeleton(0, 1, head, mark, tail)))
        .otherwise(
            F.array(
                _skeleton(2, 0, head, middle, end),
                _skeleton(1, 1, head, mark, middle, end),
                _skeleton(1, 1, head, middle, mark, end),
                _skeleton(0, 2, head, mark, middle, mark, end),
            )
        )
    )
    return placed.select("word", *keep, F.explode(shapes).alias("s")).select("word", *keep, "s.*")


def _ranked(dictionary: DataFrame) -> DataFrame:
    """``rank, word``: numbers that grow from the most frequent word on, equal ones in alphabetical order."""
    ordered = dictionary.orderBy(F.desc_nulls_first("count"), "word")
    return staged(ordered.select(F.monotonically_increasing_id().alias("rank"), "word"), "ranked")


def _spread(words: DataFrame) -> DataFrame:
    """The words dealt to all tasks: stored words are few bytes, so few files, and many times as many skeletons."""
    return words.repartition(int(words.sparkSession.conf.get("spark.sql.shuffle.partitions")), "word")


def _nearest(asked: DataFrame, dictionary: DataFrame, edits: int) -> DataFrame:
    """``word, m``: the least match per asked word that has one within ``edits``.

    Skeletons outgrow their words many times over, so the join is never a broadcast, whatever the size
    estimates made from the words. The dictionary has one row per skeleton, so its share of a task holds
    no heavy key and is hashed; the many asked skeletons need no sorting then.
    """
    dels = range(edits + 1)
    best = skeletons(_spread(dictionary), edits, "rank").groupBy("skeleton", "blanks").agg(
        *[F.min(F.when(F.col("dels") == n, F.col("rank"))).alias(f"best{n}") for n in dels]
    )

    def reached(n: int) -> Column:
        distance = (F.col("dels") + F.col("blanks") + n).cast("bigint")
        return F.when(distance <= edits, distance * STEP + F.col(f"best{n}"))

    return (
        skeletons(_spread(asked), edits).join(best.hint("shuffle_hash"), ["skeleton", "blanks"])
        .select("word", F.least(*[reached(n) for n in dels]).alias("m"))
        .where(F.col("m").isNotNull())
        .groupBy("word").agg(F.min("m").alias("m"))
    )


def _start(size: Column, part: Column) -> Column:
    """Where one of three even parts of a word of that size begins, from 0."""
    return F.floor(size * part / 3).cast("int")


def _nearest_long(asked: DataFrame, dictionary: DataFrame) -> DataFrame:
    """As ``_nearest`` for dictionary words whose skeletons would be too many.

    Two edits leave at least one of three parts of a dictionary word whole, at most two
    places off. So a part is looked up at all those places, for all lengths that two edits
    allow, and the words that meet are measured.
    """
    upto = lambda low, high: F.explode(F.sequence(F.lit(low), F.lit(high)))
    start = _start(F.col("size"), F.col("part"))
    length = _start(F.col("size"), F.col("part") + 1) - start
    listed = dictionary.select(F.col("word").alias("term"), "rank", F.length("word").alias("size"), upto(0, 2).alias("part"))
    listed = listed.select("term", "rank", "size", "part", F.substr("term", start + 1, length).alias("text"))
    sized = asked.select("word", upto(-MAX_EDITS, MAX_EDITS).alias("longer"))
    sized = sized.select("word", (F.length("word") + F.col("longer")).alias("size"), upto(0, 2).alias("part"))
    places = sized.select("*", upto(-MAX_EDITS, MAX_EDITS).alias("moved")).where(start + F.col("moved") >= 0)
    places = places.select("word", "size", "part", F.substr("word", start + F.col("moved") + 1, length).alias("text"))
    met = places.join(listed, ["size", "part", "text"]).select("word", "term", "rank").distinct()
    distance = F.levenshtein("word", "term", MAX_EDITS).cast("bigint")
    return met.select("word", F.when(distance >= 0, distance * STEP + F.col("rank")).alias("m")).where(
        F.col("m").isNotNull()).groupBy("word").agg(F.min("m").alias("m"))


def correct_words(words: DataFrame, dictionary: DataFrame, long: int = LONG) -> DataFrame:
    """``word, corrected, distance`` for every distinct word.

    ``dictionary``: ``word, count``. The nearest dictionary word wins, then the more
    frequent, then the alphabetically first; a word with none within two edits stays as
    it is with a null distance. Both tables should be stored, as they are read several times.

    Dictionary words of more than ``long`` letters are found by their parts, the others by
    skeletons, with the same results. Words with a short neighbour one edit away list only the
    few skeletons of one edit.
    """
    asked = staged(words.select("word").distinct(), "asked")
    ranked = _ranked(dictionary)
    brief = ranked.where(F.length("word") <= long)
    short = asked.where(F.length("word") <= long + MAX_EDITS)
    near = staged(_nearest(short, brief, 1), "near")
    rest = short.join(near.select("word"), "word", "left_anti")
    far = asked.where(F.length("word") > long - MAX_EDITS)
    found = near.unionByName(_nearest(rest, brief, MAX_EDITS)).unionByName(
        _nearest_long(far, ranked.where(F.length("word") > long)))
    best = found.groupBy("word").agg(F.min("m").alias("m"))
    met = best.select("word", F.expr(f"m div {STEP}").cast("int").alias("distance"), F.pmod("m", F.lit(STEP)).alias("rank")).join(
        ranked.select("rank", F.col("word").alias("term")), "rank")
    return asked.join(met, "word", "left").select("word", F.coalesce("term", "word").alias("corrected"), "distance")


def correct_texts(df: DataFrame, key: str, text: str, dictionary: DataFrame) -> DataFrame:
    """``key`` and the text with each word that the dictionary lacks corrected.

    Words are runs of non-blank characters, corrected once each in their lower case; words
    within the dictionary and those without a neighbour stay as they are. White space becomes
    one blank. Rows with a null text keep it.
    """
    parts = F.filter(F.split(F.col(text), r"\s+"), lambda w: w != "")
    placed = staged(df.select(key, F.posexplode(parts).alias("at", "said")).withColumn("word", F.lower("said")), "placed")
    counted = placed.groupBy("word").agg(F.count(F.lit(1)).alias("hits"))
    unknown = staged(counted.join(dictionary.select("word"), "word", "left_anti"), "unknown")
    found = correct_words(unknown, dictionary).where("distance IS NOT NULL")
    fixes = staged(unknown.join(found, "word").select("word", "hits", "corrected"), "fixes")
    fixed = hot_join(placed, fixes, "word", "hits", key).select(key, "at", "corrected")
    words = placed.join(fixed, [key, "at"], "left").select(
        key, F.struct("at", F.coalesce("corrected", "said").alias("word")).alias("w"))
    joined = words.groupBy(key).agg(F.sort_array(F.collect_list("w")).alias("ws"))
    joined = joined.select(key, F.array_join(F.col("ws.word"), " ").alias("_fixed"))
    return df.select(key, text).join(joined, key, "left").select(
        key, F.when(F.col(text).isNull(), F.col(text)).otherwise(F.coalesce("_fixed", F.lit(""))).alias(text))
