"""Schedule rows and the next due time."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice import schemas as S
from sluice.functions.text import is_blank, strip


def _tokens(c: str) -> Column:
    return F.filter(F.transform(F.split(c, ","), strip), lambda t: t != "")


def _days() -> Column:
    return F.transform(_tokens("week_days"), F.initcap)


def schedule_days(config: DataFrame) -> DataFrame:
    """(dataset_id, schedule, slot): one row per day of the schedule.

    The slot is empty for DAILY, a week day for WEEKLY, a date for MONTHLY.
    """
    slots = (
        F.when(F.col("schedule") == "DAILY", F.array(F.lit("")))
        .when(F.col("schedule") == "WEEKLY", _days())
        .when(F.col("schedule") == "MONTHLY", _tokens("dates_of_month"))
    )
    keys = [c for c in S.SCOPE if c in config.columns]
    return config.select(*keys, "schedule", F.explode(F.array_distinct(slots)).alias("slot"))


def _next_week_day(today: Column, day: Column) -> Column:
    known = [d.upper() for d in S.WEEK_DAYS] + [d[:3].upper() for d in S.WEEK_DAYS]
    return F.when(F.upper(day).isin(*known), F.call_function("next_day", today, day))


def _next_date(today: Column, date: Column) -> Column:
    """Next day with that number; no two months in a row lack it, so three months are enough."""
    number = F.when(F.rlike(date, F.lit("^[0-9]{1,2}$")), date.try_cast("int"))

    def in_month(offset: int) -> Column:
        first = F.add_months(F.trunc(today, "month"), offset)
        day = F.date_add(first, number - 1)
        return F.when(number.between(1, F.day(F.last_day(first))) & (day > today), day)

    return F.coalesce(in_month(0), in_month(1), in_month(2))


def next_due(config: DataFrame, as_of: datetime | Column, *more: str) -> DataFrame:
    """For each enabled dataset whether it is due, and when it is due after this run.

    Due: never run, or next_run_due_time is not later than ``as_of``. The next time keeps the time
    of day of ``as_of``, one moment or one for each row; a date the month lacks is skipped. All of it is row-wise,
    so nothing is shuffled. ``more`` names columns to carry.
    """
    now = F.lit(as_of).cast("timestamp")
    today = F.to_date(now)
    days = F.transform(_days(), lambda d: _next_week_day(today, d))
    dates = F.transform(_tokens("dates_of_month"), lambda d: _next_date(today, d))
    target = (
        F.when(F.col("schedule") == "DAILY", F.date_add(today, 1))
        .when((F.col("schedule") == "WEEKLY") & ~is_blank("week_days"), F.array_min(days))
        .when((F.col("schedule") == "MONTHLY") & ~is_blank("dates_of_month"), F.array_min(dates))
    )
    due = F.col("last_run_time").isNull() | F.coalesce(
        F.col("next_run_due_time").cast("timestamp") <= now, F.lit(False)
    )
    keys = [c for c in S.SCOPE if c in config.columns]
    return config.filter("is_enabled").select(
        *keys,
        "schedule",
        due.alias("is_due"),
        F.timestamp_add("DAY", F.date_diff(target, today), now).alias("next_run_due_time"),
        *more,
    )
