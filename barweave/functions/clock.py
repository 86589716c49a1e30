"""Exchange dates and times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from barweave.schemas import DAY_FORMAT, EXCHANGE_OFFSET, MONTH_DAY_PATTERN, ROC_YEAR_OFFSET


def exchange_time_to_utc(
    date: Column, time: Column, pattern: str, offset: str = EXCHANGE_OFFSET
) -> Column:
    """UTC instant of a local date and time given as text; null when unreadable."""
    local = F.try_to_timestamp(F.concat_ws(" ", date, time), F.lit(pattern))
    return F.to_utc_timestamp(local, offset)


def roc_year(day: Column) -> Column:
    return F.year(day) - ROC_YEAR_OFFSET


def day_label(day: Column) -> Column:
    """``yyyy_MM_dd``, as archives and daily outputs are named."""
    return F.date_format(day, DAY_FORMAT)


def day_of_label(label: Column) -> Column:
    return F.try_to_timestamp(label, F.lit(DAY_FORMAT)).cast("date")


def month_day_label(day: Column) -> Column:
    return F.concat(F.month(day), F.lit("月"), F.day(day), F.lit("日"))


def day_of_month_day(text: Column, year: Column) -> Column:
    """Date from ``M月D日`` in a given year; null when there is no such day."""
    month = F.regexp_extract(text, MONTH_DAY_PATTERN, 1)
    day = F.regexp_extract(text, MONTH_DAY_PATTERN, 2)
    return F.try_to_timestamp(F.concat_ws("-", year, month, day), F.lit("y-M-d")).cast("date")
