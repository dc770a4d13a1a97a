"""Array expressions that compute their input once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def after(array: Column, n: int | Column) -> Column:
    """All elements of an array but the first ``n``."""
    start = F.lit(n + 1) if isinstance(n, int) else n + 1
    return F.slice(array, start, F.lit(1 << 30))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` applied to a value that is computed once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))
