"""Timestamp parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluice.functions.text import strip


def parse_start_date(c: Column | str) -> Column:
    """P3: 'yyyy-MM-dd HH:mm:ss', else 'yyyy-MM-dd' at midnight, else NULL."""
    text = strip(c)
    day_and_time = F.when(
        F.rlike(text, F.lit(r"^\d{4}-\d{1,2}-\d{1,2}\s+\d{1,2}:\d{1,2}:\d{1,2}$")),
        F.try_to_timestamp(F.regexp_replace(text, r"\s+", " "), F.lit("yyyy-M-d H:m:s")),
    )
    day = F.when(
        F.rlike(text, F.lit(r"^\d{4}-\d{1,2}-\d{1,2}$")), F.try_to_timestamp(text, F.lit("yyyy-M-d"))
    )
    return F.coalesce(day_and_time, day)
