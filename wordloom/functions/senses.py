"""Numbered dictionary senses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wordloom.functions.phrases import trim_all

SENSE_NUMBER = r"\b(\d+)\b\.\s*"
UNNUMBERED_HEADING = "Definisi :"


def _head(text: Column) -> Column:
    """Text up to the first colon or semicolon."""
    return trim_all(F.split(text, "[:;]")[0])


def numbered_senses(text: Column) -> Column:
    """Senses of one dictionary tab.

    Without a free-standing 1, the text after the heading is the only sense. Otherwise
    the segments whose numbers run 1, 2, 3 ... are kept and those out of turn skipped;
    a tab that does not open with 1 yields nothing.
    """
    numbers = F.transform(
        F.regexp_extract_all(text, F.lit(SENSE_NUMBER), F.lit(1)), lambda n: n.try_cast("bigint")
    )
    bodies = F.slice(
        F.split(text, SENSE_NUMBER), 2, F.greatest(F.size(numbers), F.lit(0))
    )
    pairs = F.zip_with(numbers, bodies, lambda n, body: F.struct(n.alias("n"), body.alias("body")))
    start = F.struct(
        F.lit(1).cast("bigint").alias("due"), F.array().cast("array<string>").alias("kept")
    )

    def take(state: Column, pair: Column) -> Column:
        return F.when(
            pair["n"] == state["due"],
            F.struct(
                (state["due"] + 1).alias("due"),
                F.concat(state["kept"], F.array(_head(pair["body"]))).alias("kept"),
            ),
        ).otherwise(state)

    in_turn = F.aggregate(pairs, start, take, lambda state: state["kept"])
    none = F.array().cast("array<string>")
    at = F.instr(text, UNNUMBERED_HEADING)
    plain = F.when(
        at > 0, F.array(_head(F.substr(text, at + F.lit(len(UNNUMBERED_HEADING)))))
    ).otherwise(none)
    return (
        F.when(~F.rlike(text, F.lit(r"\b1\b")), plain)
        .when(F.get(numbers, F.lit(0)) == 1, in_turn)
        .otherwise(none)
    )
