"""Trading calendar: weekday rule, listed holidays and make-up days."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barweave.functions.clock import day_of_month_day
from barweave.schemas import MAKE_UP_MEMO

SATURDAY = 5  # weekday(), Monday is 0


def days_between(spark: SparkSession, first: str, last: str) -> DataFrame:
    """Every day of a closed range, as ``ds``."""
    bounds = (F.lit(day).cast("date") for day in (first, last))
    return spark.range(1).select(F.explode(F.sequence(*bounds)).alias("ds"))


def holiday_list(schedule: DataFrame) -> DataFrame:
    """``(ds, is_make_up)`` per listed day; a day listed twice is open if either row says so."""
    return (
        schedule.select(
            day_of_month_day(F.col("date"), F.col("year")).alias("ds"),
            (F.trim("memo") == MAKE_UP_MEMO).alias("is_make_up"),
        )
        .where(F.col("ds").isNotNull())
        .groupBy("ds")
        .agg(F.coalesce(F.bool_or("is_make_up"), F.lit(False)).alias("is_make_up"))
    )


def mark_trading_days(days: DataFrame, holidays: DataFrame, day: str = "ds") -> DataFrame:
    """Adds ``is_trading``: listed days follow the list, all others the weekday."""
    listed = holidays.select(F.col("ds").alias(day), "is_make_up")
    return days.join(listed, day, "left").select(
        *days.columns,
        F.coalesce("is_make_up", F.weekday(day) < SATURDAY).alias("is_trading"),
    )


def trading_days(days: DataFrame, holidays: DataFrame, day: str = "ds") -> DataFrame:
    return mark_trading_days(days, holidays, day).where("is_trading").drop("is_trading")
