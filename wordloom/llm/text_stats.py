"""Counts of a text's words, lines and characters, as column expressions of one row.

Words are maximal runs of anything but ASCII white space (``[^\\x20\\x09-\\x0D]+``). All
expressions stay inside the row, so no word crosses a shuffle however long a text is.
Repeated windows are found by 64-bit hashes of their words within one text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.llm.tables import narrow

WINDOW = 5
SPACE = "[ \\x09-\\x0D]"
SYMBOL = "[#*$%&|<>]"
_INNER = ("n_chars", "parts", "words", "lines", "hashes", "shingles", "ordered", "starts")


def split_words(text: Column) -> Column:
    """The words of a text; none for an empty one."""
    return F.array_remove(F.split(text, SPACE), "")


def _shingles(hashes: Column) -> Column:
    """A hash of each window of words, from the hashes of the words; none if there are fewer words."""
    windows = F.transform(
        hashes, lambda h, i: F.xxhash64(h, *[F.get(hashes, i + k) for k in range(1, WINDOW)])
    )
    return F.slice(windows, F.lit(1), F.greatest(F.size(hashes) - (WINDOW - 1), F.lit(0)))


def _repeated_starts(ordered: Column) -> Column:
    """Starts of the windows whose hash is also a neighbour's in (hash, start) order."""
    same = lambda x, j: F.coalesce(F.get(ordered, j)["h"] == x["h"], F.lit(False))
    marked = F.transform(ordered, lambda x, j: F.when(same(x, j - 1) | same(x, j + 1), x["i"]))
    return F.sort_array(F.filter(marked, lambda i: i.isNotNull()))


def _covered(starts: Column) -> Column:
    """Words that lie in at least one of the windows, from the sorted starts."""
    steps = F.transform(
        starts,
        lambda i, k: F.least(F.lit(WINDOW), F.coalesce(i - F.get(starts, k - 1), F.lit(WINDOW))),
    )
    return F.aggregate(steps, F.lit(0), lambda total, step: total + step)


def with_text_stats(docs: DataFrame, key: str = "doc_id", text: str = "text",
                    carry: bool = False) -> DataFrame:
    """``doc_id`` (and ``row``) and the counts of each text; a null text has none of anything.

    n_words, word_chars (code points in words), n_symbols, n_dup_lines (lines with a word
    that equal an earlier line), n_repeat_words (words in five-word windows found twice or
    more), and n_distinct, n_upper, n_marks, n_lines (lines with a word).
    """
    df = narrow(docs, key, text, carry)
    t = F.col("text")
    count = lambda pattern: F.regexp_count(t, F.lit(pattern)).cast("bigint")
    df = df.select(
        *[c for c in df.columns if c != "text"],
        F.length(t).alias("n_chars"),
        count(SYMBOL).alias("n_symbols"),
        count("[!?]").alias("n_marks"),
        count("\\p{Lu}").alias("n_upper"),
        F.split(t, SPACE).alias("parts"),
        F.filter(F.split(t, "\n"), lambda line: line.rlike("[^ \\x09-\\x0D]")).alias("lines"),
    )
    parts = F.col("parts")
    df = df.select(
        "*",
        (F.col("n_chars") - (F.size(parts) - 1)).cast("bigint").alias("word_chars"),
        F.array_remove(parts, "").alias("words"),
    )
    words, lines, hashes, shingles = (F.col(c) for c in ("words", "lines", "hashes", "shingles"))
    df = df.select("*", F.transform(words, lambda w: F.xxhash64(w)).alias("hashes"))
    df = df.select(
        "*",
        F.size(words).cast("bigint").alias("n_words"),
        F.size(F.array_distinct(hashes)).cast("bigint").alias("n_distinct"),
        F.size(lines).cast("bigint").alias("n_lines"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint").alias("n_dup_lines"),
        _shingles(hashes).alias("shingles"),
    )
    # Sorting is for the texts that repeat a window only.
    pairs = F.transform(shingles, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    repeats = F.size(F.array_distinct(shingles)) < F.size(shingles)
    df = df.select("*", F.when(repeats, F.sort_array(pairs)).alias("ordered"))
    df = df.select("*", _repeated_starts(F.col("ordered")).alias("starts"))
    covered = F.coalesce(_covered(F.col("starts")), F.lit(0)).cast("bigint")
    return df.select("*", covered.alias("n_repeat_words")).drop(*_INNER)
