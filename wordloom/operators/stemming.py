"""Base forms of Malay words by confix stripping with nasal recoding.

A word is taken apart into a prefix, a stem and suffixes in every way the rules allow; where the
nasal of ``me-`` or ``pe-`` has swallowed the stem's first letter, that letter is restored (``menulis``:
``tulis``). Both halves of a reduplicated word must have the stem in common (``berlari-lari``: ``lari``).
All ways of all words are candidate rows; one join with the dictionary leaves those that are words, and the
best has the fewest affixes, then the longest stem, then comes first in the alphabet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The rules of Malay word formation. A nasal prefix: its form, the letters it stands
# before, and the letter it has swallowed before a vowel.
VOWELS = "aeiou"
NASALS = (
    ("", "lmnrwy", ""), ("m", "bfpv", ""), ("m", VOWELS, "p"), ("n", "cdjsztn", ""), ("n", VOWELS, "t"),
    ("ng", "ghkqlr" + VOWELS, ""), ("ng", VOWELS, "k"), ("nge", "", ""), ("ny", VOWELS, "s"),
)
PLAIN = ("di", "ke", "se", "ter", "te", "ber", "be", "bel", "per", "pel", "pe")
INNER = ("per", "pel", "ber", "ter", "ke", "se")
SUFFIXES, OWNERS, PARTICLES = ("kan", "an", "i"), ("nya", "ku", "mu"), ("lah", "kah", "tah", "pun")
#: Prefixes (by their first letters) and suffixes that never go together.
NEVER = (("be", "i"), ("di", "an"), ("ke", "i"), ("ke", "kan"), ("me", "an"), ("se", "i"), ("se", "kan"), ("te", "an"))
#: Letters of a stem at least.
SHORTEST = 2


def prefix_rules() -> list[tuple[str, str, str, str, int]]:
    """(prefix, letters it stands before or '', restored letter, kind, affixes)."""
    single = [(p, "", "", p[:2], 1) for p in PLAIN]
    single += [(kind + nasal, before, lost, kind, 1) for kind in ("me", "pe") for nasal, before, lost in NASALS]
    double = [(outer + inner, "", "", outer[:2], 2) for outer in ("mem", "di", "ke", "se", "ber", "ter") for inner in INNER
              if not inner.startswith(outer)]
    return [("", "", "", "", 0), *single, *double]


def suffix_rules() -> list[tuple[str, str, int]]:
    """(suffixes, the first of them if it forms words, affixes)."""
    return [(a + b + c, a, bool(a) + bool(b) + bool(c))
            for a in ("", *SUFFIXES) for b in ("", *OWNERS) for c in ("", *PARTICLES)]


def _literal(rows: list[tuple], names: tuple[str, ...]) -> Column:
    return F.array(*[F.struct(*[F.lit(v).alias(n) for v, n in zip(row, names)]) for row in rows])


def stem_candidates(words: DataFrame) -> DataFrame:
    """``word, stem, affixes``: every way to take a word apart, the word itself included."""
    halves = F.split("word", "-")
    twice = (F.size(halves) == 2) & (F.get(halves, F.lit(0)) != "") & (F.get(halves, F.lit(1)) != "")
    forms = words.select("word").distinct().select(
        "word", F.posexplode(F.when(twice, F.array_distinct(F.concat(F.array("word"), halves))).otherwise(F.array("word"))).alias("half", "form"),
        F.when(twice, F.size(F.array_distinct(halves))).otherwise(0).alias("halves"))
    prefixes = _literal(prefix_rules(), ("prefix", "before", "lost", "kind", "n"))
    suffixes = _literal(suffix_rules(), ("suffix", "forms", "m"))
    cut = forms.select(
        "word", "half", "form", "halves", F.inline(F.filter(prefixes, lambda p: F.startswith("form", p["prefix"])))
    ).select("*", F.inline(F.filter(suffixes, lambda s: F.endswith("form", s["suffix"]))))
    never = F.lit(False)
    for kind, suffix in NEVER:
        never = never | ((F.col("kind") == kind) & (F.col("forms") == suffix))
    bare = F.expr("substring(form, length(prefix) + 1, length(form) - length(prefix) - length(suffix))")
    fit = cut.where(F.expr("length(form) - length(prefix) - length(suffix)") >= SHORTEST).where(~never).select(
        "word", "half", "halves", "lost", "before", bare.alias("bare"), (F.col("n") + F.col("m")).alias("affixes"))
    stems = fit.where((F.col("before") == "") | F.contains("before", F.left("bare", F.lit(1)))).select(
        "word", "half", "halves", F.concat("lost", "bare").alias("stem"), "affixes")
    alone = stems.where(F.col("half") == 0).select("word", "stem", "affixes")
    # A stem of a reduplicated word is one of all its different halves.
    best = stems.where(F.col("half") > 0).groupBy("word", "halves", "stem", "half").agg(F.min("affixes").alias("affixes"))
    both = best.groupBy("word", "halves", "stem").agg(F.count(F.lit(1)).alias("n"), F.sum("affixes").alias("affixes"))
    return alone.unionByName(both.where(F.col("n") == F.col("halves")).select("word", "stem", (F.col("affixes") + 1).alias("affixes")))


def base_forms(words: DataFrame, dictionary: DataFrame) -> DataFrame:
    """``word, base``: each word of the dictionary it derives from, or null if the dictionary has none.

    Null words are dropped; words are taken as they are, in lower case by custom.
    """
    known = dictionary.select(F.col("word").alias("stem")).distinct()
    found = stem_candidates(words.where(F.col("word").isNotNull())).join(known, "stem", "left_semi")
    order = F.struct("affixes", -F.char_length("stem"), "stem")
    best = found.groupBy("word").agg(F.min_by("stem", order).alias("base"))
    return words.where(F.col("word").isNotNull()).select("word").distinct().join(best, "word", "left")
