"""Documents with nulls, empty and very long texts, copies, and columns with clashing names."""

from __future__ import annotations

SCHEMA = "doc_id bigint, text string, words array<string>, row string, kept boolean, line string, score double"


def documents(spark, texts, first=0):
    rows = [(first + i, t, ["x"], "r", False, "l", 0.5) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def prose(seed: int, n: int) -> str:
    """Different words in order, the same for a seed."""
    return " ".join(f"w{(seed * 7919 + i * 104729) % 999983}" for i in range(n))


def edges(spark):
    long = prose(3, 30_000)
    rows = [
        (1, None), (2, ""), (3, " \t\n "), (4, long), (5, long), (6, prose(1, 40)), (6, prose(1, 40)), (None, prose(2, 40)),
        (7, "a"), (8, "é ß 漢字 😀 " * 3), (9, "x" * 20_000), (10, "\n".join([prose(9, 12)] * 3)),
    ]
    return spark.createDataFrame([(a, b, ["x"], "r", False, "l", 0.5) for a, b in rows], SCHEMA)
