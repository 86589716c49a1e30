"""Expiry calendar and the labelling of rows with expiry codes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barweave.functions.expiry import codes_of_expire, expiry_entries, front_month


def expiry_calendar(days: DataFrame, day: str = "ds") -> DataFrame:
    """``(ds, code_no, expire_code, expire)`` for each given day."""
    return days.select(
        F.col(day).alias("ds"), F.posexplode(expiry_entries(F.col(day))).alias("code_no", "entry")
    ).select("ds", "code_no", "entry.expire_code", "entry.expire")


def codes_by_expire(calendar: DataFrame) -> DataFrame:
    """Inverted calendar: each day's expiries with the ordered list of their codes."""
    ordered = F.array_sort(F.collect_list(F.struct("code_no", "expire_code")))
    return calendar.groupBy("ds", "expire").agg(
        F.transform(ordered, lambda entry: entry["expire_code"]).alias("expire_codes")
    )


def label_expiry(df: DataFrame, day: str = "ds", expire: str = "expire") -> DataFrame:
    """One row per code of the row's expiry; rows whose expiry has no code are dropped.

    The codes are computed in place, so this is a narrow step: no lookup table is
    built, broadcast or joined.
    """
    coded = df.withColumn("_front", front_month(F.col(day))).withColumn(
        "_codes", codes_of_expire(F.col(day), F.col(expire), F.col("_front"))
    )
    return coded.select(
        *df.columns, F.explode(F.split("_codes", ",")).alias("expire_code")
    ).where(F.col("expire_code") != "")
