"""Small lists brought to the driver, with their size checked."""

from __future__ import annotations

from pyspark.sql import DataFrame


def small_list(df: DataFrame, column: str, most: int) -> list:
    """Values of a column that must not have more than ``most`` rows."""
    rows = df.select(column).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"{column}: more than {most} values")
    return [r[0] for r in rows]
