"""Contract expiries and their relative codes, as expressions of the trading day.

Contracts settle on Wednesdays: weekly ones each week, monthly ones on the third of the
month. Holidays do not move a settlement.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from barweave.schemas import EXPIRE_CODES

WEDNESDAY = 2  # weekday(), Monday is 0


def monthly_settlement(day: Column) -> Column:
    """Third Wednesday of the month of ``day``."""
    return F.next_day(F.date_add(F.trunc(day, "MM"), 13), "WED")


def next_weekly_settlement(day: Column) -> Column:
    """First Wednesday after ``day``."""
    return F.next_day(day, "WED")


def month_name(day: Column) -> Column:
    return F.date_format(day, "yyyyMM")


def weekly_name(settlement: Column) -> Column:
    """Contract settling on this day: ``yyyyMMWk``, or the monthly ``yyyyMM`` in week 3."""
    week = ((F.day(settlement) + 6) / 7).cast("int")
    return F.concat(
        month_name(settlement),
        F.when(week == 3, F.lit("")).otherwise(F.concat(F.lit("W"), week)),
    )


def front_month(day: Column) -> Column:
    """First of the month whose contract is the nearest; rolls after the settlement."""
    return F.add_months(F.trunc(day, "MM"), (day > monthly_settlement(day)).cast("int"))


def _month_names(front: Column) -> list[Column]:
    """Three consecutive months, then the next three quarter ends after them."""
    quarter_end = F.add_months(F.trunc(front, "quarter"), 2)
    months = [F.add_months(front, i) for i in range(3)]
    quarters = [F.add_months(quarter_end, 3 * i) for i in (1, 2, 3)]
    return [month_name(month) for month in months + quarters]


def expiry_entries(day: Column) -> Column:
    """Array of ``(expire_code, expire)`` valid on ``day``, nearest first.

    A Wednesday has two weekly entries: the contract that settles and the next one.
    """

    def entry(code: str, expire: Column) -> Column:
        return F.struct(F.lit(code).alias("expire_code"), expire.alias("expire"))

    weekly, *others = EXPIRE_CODES
    regular = [entry(weekly, weekly_name(next_weekly_settlement(day)))]
    regular += [entry(c, name) for c, name in zip(others, _month_names(front_month(day)))]
    settling = F.array(entry(weekly, weekly_name(day)), *regular)
    return F.when(F.weekday(day) == WEDNESDAY, settling).otherwise(F.array(*regular))


def codes_of_expire(day: Column, expire: Column, front: Column | None = None) -> Column:
    """Comma-joined codes of one expiry on ``day``; empty when it has none.

    Text rather than an array filter keeps the expression inside generated code.
    ``front`` may pass a column that already holds ``front_month(day)``.
    """
    weekly, *others = EXPIRE_CODES
    settles_today = (F.weekday(day) == WEDNESDAY) & (expire == weekly_name(day))
    is_weekly = settles_today | (expire == weekly_name(next_weekly_settlement(day)))
    names = _month_names(front_month(day) if front is None else front)
    return F.concat_ws(
        ",",
        F.when(is_weekly, weekly),
        *(F.when(expire == name, code) for code, name in zip(others, names)),
    )
