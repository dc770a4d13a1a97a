"""Sentence, cleaning and token expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SENTENCE_BREAK = r"(?<=[.!?]) +"
WORD = "[a-zA-Z-]+"
WORD_UNICODE = r"[\p{L}-]+"
# A negated class of several ranges makes the JVM's regex threads wait for each other;
# a look-ahead for the hyphen in front of a plain negated class does not.
NOT_WORD = "(?:(?!-)[^a-zA-Z])+"
NOT_WORD_UNICODE = r"(?:(?!-)\P{L})+"


def strip_caption(text: Column, strict: bool = False) -> Column:
    """Cut a photo credit: everything from the first hyphen to the end of its line.

    The default also cuts inside hyphenated words, as the source data was built that
    way; ``strict`` asks for a free-standing hyphen and runs to the end of the text.
    """
    return F.regexp_replace(text, r"(?s)\s-\s.*$" if strict else r"\s?-.*", "")


def flatten(parts: Column) -> Column:
    """Array of paragraphs to one string; null parts are skipped, a null array gives ''."""
    return F.concat_ws(" ", parts)


def sentences(text: Column) -> Column:
    """Split after ``. ! ?`` where spaces follow."""
    return F.split(text, SENTENCE_BREAK)


def clean_sentence(text: Column, keep_unicode: bool = False) -> Column:
    """Letters and hyphens only, single spaces, trimmed."""
    pattern = NOT_WORD_UNICODE if keep_unicode else NOT_WORD
    return F.trim(F.regexp_replace(text, pattern, " "))


def raw_tokens(text: Column, keep_unicode: bool = False) -> Column:
    """All letter-and-hyphen runs of a whole text, before ``token``.

    Sentence breaks fall on spaces, which split tokens anyway, so the multiset of
    tokens is the same as that of the cleaned sentences.
    """
    pattern = WORD_UNICODE if keep_unicode else WORD
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def token(raw: Column) -> Column:
    """One leading and one trailing hyphen off, lower case.

    The regex runs only on the rare tokens that hold a hyphen at all.
    """
    bare = F.when(F.contains(raw, F.lit("-")), F.regexp_replace(raw, "^-|-$", "")).otherwise(raw)
    return F.lower(bare)


def has_letters(raw: Column, keep_unicode: bool = False) -> Column:
    """Whether cleaning leaves anything; found at the first letter or hyphen."""
    return F.rlike(raw, F.lit(r"[\p{L}-]" if keep_unicode else "[a-zA-Z-]"))


def is_word(raw: Column) -> Column:
    """Whether ``token`` will be longer than one letter, told from the raw token's ends."""
    edges = F.startswith(raw, F.lit("-")).cast("int") + F.endswith(raw, F.lit("-")).cast("int")
    return F.length(raw) - edges > 1


def token_array(text: Column, keep_unicode: bool = False) -> Column:
    """Tokens of a text as an array, in order."""
    return F.transform(F.filter(raw_tokens(text, keep_unicode), is_word), token)
