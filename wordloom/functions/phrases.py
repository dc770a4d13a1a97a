"""Phrase normalising, abbreviation expansion and label mapping."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space beyond ASCII that Unicode-aware matching treats as space.
WIDE_SPACE = r"\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

# Dictionary short forms, in the order in which they are expanded.
ABBREVIATIONS = {
    "bh": "bahan",
    "bkn": "bukan",
    "dgn": "dengan",
    "dll": "dan lain-lain",
    "dlm": "dalam",
    "dr": "dari",
    "drpd": "daripada",
    "dsb": "dan sebagainya",
    "kpd": "kepada",
    "lwn": "lawan",
    "pd": "pada",
    "prb": "peribahasa",
    "sbg": "sebagai",
    "spt": "seperti",
    "utk": "untuk",
    "yg": "yang",
}

# Emotion names and the spellings that stand for them.
EMOTION_SYNONYMS = {"sad": "sadness", "angry": "anger"}
TRAIN_EMOTIONS = ("sadness", "anger", "happy", "fear", "love", "surprise")
TEST_EMOTIONS = TRAIN_EMOTIONS + ("neutral", "jealous")

# Sentiment names and their numbers.
SENTIMENT_CODES = {"positive": 1, "neutral": 0, "negative": -1}


def trim_all(text: Column) -> Column:
    """Trim every kind of white space, not just blanks."""
    return F.regexp_replace(text, rf"^[{WIDE_SPACE}]+|[{WIDE_SPACE}]+$", "")


def collapse_spaces(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, rf"[{WIDE_SPACE}]+", " "))


def normalize_phrase(text: Column) -> Column:
    """Drop punctuation, collapse white space, trim, lower. Letters of any script stay."""
    words_only = F.regexp_replace(text, rf"[^\p{{L}}\p{{N}}_{WIDE_SPACE}]", "")
    return F.lower(collapse_spaces(words_only))


def _closed(table: Mapping[str, str]) -> dict[str, str]:
    """What each short form becomes when the later rules have read what it was replaced with."""
    rules = [(re.compile(rf"(?<!\w){short}(?!\w)"), full) for short, full in table.items()]
    closed = {}
    for i, short in enumerate(table):
        out = table[short]
        for pattern, full in rules[i + 1:]:
            out = pattern.sub(lambda _, full=full: full, out)
        closed[short] = out
    return closed


def expand_abbreviations(text: Column, table: Mapping[str, str] = ABBREVIATIONS) -> Column:
    """Lower, collapse, then expand whole words in table order.

    A later rule sees what an earlier one wrote. Word edges are Unicode-aware. Short forms are
    words (letters, digits, low lines; anything else is an error), so replacing one moves no edge
    of another: the rules are closed beforehand, the text is cut before each short form in one
    pass, and each piece is looked up by its head.
    """
    for short in table:
        if not re.fullmatch(r"\w+", short):
            raise ValueError(f"not a word: {short!r}")
    out = collapse_spaces(F.lower(text))
    if not table:
        return out
    any_short = "|".join(sorted(table, key=lambda short: (-len(short), short)))
    whole = rf"(?:{any_short})(?![\p{{L}}\p{{N}}_])"
    initials = "".join(sorted({short[0] for short in table}))
    pieces = F.split(out, rf"(?=[{initials}])(?<![\p{{L}}\p{{N}}_])(?={whole})")
    full = F.create_map(*[F.lit(x) for pair in _closed(table).items() for x in pair])

    def expanded(piece: Column) -> Column:
        head = F.regexp_extract(piece, rf"^{whole}", 0)
        longer = F.concat(F.try_element_at(full, head), F.substr(piece, F.length(head) + 1))
        return F.coalesce(longer, piece)

    return F.array_join(F.transform(pieces, expanded), "")


def short_description(description: Column) -> Column:
    """Tag description up to its first comma."""
    return F.trim(F.split(description, ",")[0])


def normalize_emotion(label: Column) -> Column:
    out = label
    for old, new in EMOTION_SYNONYMS.items():
        out = F.when(label == old, new).otherwise(out)
    return out


def sentiment_code(label: Column) -> Column:
    """Sentiment name to its number; anything else gives null."""
    out = F.lit(None).cast("int")
    for name, number in SENTIMENT_CODES.items():
        out = F.when(label == name, number).otherwise(out)
    return out
