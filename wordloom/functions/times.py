"""Publish-time text to timestamp."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Malay month names, short form as in listings, long form as in articles.
MONTHS = {
    "Jan": 1, "Feb": 2, "Mac": 3, "Apr": 4, "Mei": 5, "Jun": 6,
    "Jul": 7, "Ogs": 8, "Sep": 9, "Okt": 10, "Nov": 11, "Dis": 12,
}
LONG_MONTHS = {
    "Januari": 1, "Februari": 2, "April": 4, "Julai": 7, "Ogos": 8,
    "September": 9, "Oktober": 10, "November": 11, "Disember": 12,
}


def parse_publish_time(text: Column, reference: Column) -> Column:
    """``Dis 21, 2024 @ 7:24pm`` or a relative text such as ``3 jam lalu``.

    Relative texts count back from ``reference``. Unreadable text gives null.
    """
    months = F.create_map(*[F.lit(x) for x in chain.from_iterable({**MONTHS, **LONG_MONTHS}.items())])
    parts = F.split(F.trim(text), r"\s+")
    month = F.try_element_at(months, F.get(parts, F.lit(0)))
    absolute = F.try_to_timestamp(
        F.concat_ws(
            " ",
            F.concat_ws(
                "-", F.get(parts, F.lit(2)), month.cast("string"),
                F.regexp_replace(F.get(parts, F.lit(1)), ",", ""),
            ),
            F.upper(F.get(parts, F.lit(4))),
        ),
        F.lit("y-M-d h:mma"),
    )
    amount = F.get(parts, F.lit(0)).try_cast("int")
    return (
        F.when(F.contains(text, F.lit("@")), F.when(month.isNotNull(), absolute))
        .when(F.contains(text, F.lit("sejam")), reference - F.make_dt_interval(hours=F.lit(1)))
        .when(F.contains(text, F.lit("jam")), reference - F.make_dt_interval(hours=amount))
        .when(F.contains(text, F.lit("seminit")), reference - F.make_dt_interval(mins=F.lit(1)))
        .otherwise(reference - F.make_dt_interval(mins=amount))
    )
