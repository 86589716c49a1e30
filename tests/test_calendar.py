from __future__ import annotations

import datetime as dt

import pytest
from landing import land_holidays
from pyspark.sql import functions as F

from barweave.functions.clock import (
    day_label,
    day_of_label,
    day_of_month_day,
    month_day_label,
    roc_year,
)
from barweave.functions.expiry import monthly_settlement
from barweave.operators.calendar import days_between, holiday_list, mark_trading_days, trading_days
from barweave.operators.labels import codes_by_expire, expiry_calendar, label_expiry
from barweave.sources.landed import read_holidays

ONE_DAY = dt.timedelta(days=1)


def wednesdays(year: int, month: int) -> list[dt.date]:
    day, found = dt.date(year, month, 1), []
    while day.month == month:
        if day.isoweekday() == 3:
            found.append(day)
        day += ONE_DAY
    return found


def months_from(year: int, month: int):
    while True:
        yield year, month
        year, month = (year + 1, 1) if month == 12 else (year, month + 1)


def expected_codes(day: dt.date) -> list[tuple[str, str]]:
    """By walking the calendar day by day and month by month."""

    def weekly(settlement: dt.date) -> str:
        place = wednesdays(settlement.year, settlement.month).index(settlement) + 1
        return f"{settlement:%Y%m}" + ("" if place == 3 else f"W{place}")

    codes = [("W", weekly(day))] if day.isoweekday() == 3 else []
    coming = day + ONE_DAY
    while coming.isoweekday() != 3:
        coming += ONE_DAY
    codes.append(("W", weekly(coming)))
    months = months_from(day.year, day.month)
    if day > wednesdays(day.year, day.month)[2]:
        next(months)
    listed = []
    for name in ("M", "M+1", "M+2"):
        listed.append(next(months))
        codes.append((name, "%04d%02d" % listed[-1]))
    # Quarter ends strictly after the quarter of the nearest month.
    year, month = listed[0]
    quarter = (month - 1) // 3
    later = (m for m in months_from(year, month) if (m[0] - year) * 4 + (m[1] - 1) // 3 > quarter)
    ends = (m for m in later if m[1] % 3 == 0)
    codes += [(name, "%04d%02d" % next(ends)) for name in ("Q+1", "Q+2", "Q+3")]
    return codes


def test_every_day_of_three_years(spark):
    days = days_between(spark, "2021-01-01", "2023-12-31")
    found = {}
    for r in expiry_calendar(days).orderBy("ds", "code_no").collect():
        found.setdefault(r.ds, []).append((r.expire_code, r.expire))
    assert len(found) == 1095
    for day, codes in found.items():
        assert codes == expected_codes(day), day


def test_labels_agree_with_the_calendar(spark):
    """Every expiry of every day gets its codes, and nothing else does."""
    days = days_between(spark, "2021-01-01", "2023-12-31")
    calendar = expiry_calendar(days)
    expires = calendar.select("expire").distinct()
    pairs = days.join(expires)
    labelled = label_expiry(pairs).select("ds", "expire", "expire_code")
    both = calendar.select("ds", "expire", "expire_code")
    assert labelled.exceptAll(both).count() == 0 and both.exceptAll(labelled).count() == 0


@pytest.mark.parametrize(
    "day, code, expires",
    [
        ("2022-02-16", "W", ["202202", "202202W4"]),
        ("2022-02-16", "M", ["202202"]),
        ("2022-01-20", "M", ["202202"]),
        ("2021-12-15", "M+1", ["202201"]),
        ("2021-12-15", "Q+1", ["202203"]),
        ("2021-12-16", "M", ["202201"]),
        ("2022-03-30", "W", ["202203W5", "202204W1"]),
    ],
)
def test_known_days(spark, day, code, expires):
    calendar = expiry_calendar(days_between(spark, day, day))
    rows = calendar.where(F.col("expire_code") == code).orderBy("code_no").collect()
    assert [r.expire for r in rows] == expires


def test_inverted_calendar(spark):
    inverted = codes_by_expire(expiry_calendar(days_between(spark, "2022-02-16", "2022-02-16")))
    found = {r.expire: r.expire_codes for r in inverted.collect()}
    assert found["202202"] == ["W", "M"] and found["202202W4"] == ["W"] and len(found) == 7


def test_third_wednesday(spark):
    days = days_between(spark, "2021-01-01", "2023-12-31")
    for r in days.select("ds", monthly_settlement(F.col("ds")).alias("s")).collect():
        assert r.s == wednesdays(r.ds.year, r.ds.month)[2]


def test_unlabelled_rows_vanish(spark):
    df = spark.sql("select date'2022-01-20' as ds, x as expire from values ('209912'), (null), ('') t(x)")
    assert label_expiry(df).count() == 0


def test_trading_days(spark, tmp_path):
    land_holidays(str(tmp_path))
    holidays = holiday_list(read_holidays(spark, f"{tmp_path}/raw/holidays"))
    days = days_between(spark, "2022-01-01", "2022-12-31")
    flags = {r.ds: r.is_trading for r in mark_trading_days(days, holidays).collect()}
    assert len(flags) == 365
    special = {dt.date(2022, 2, 1): False, dt.date(2022, 1, 22): True, dt.date(2022, 1, 1): False}
    for day, is_open in flags.items():
        assert is_open == special.get(day, day.isoweekday() <= 5), day
    assert trading_days(days, holidays).count() == sum(flags.values())


def test_day_listed_twice_is_open_if_made_up(spark):
    schedule = spark.createDataFrame(
        [("1月22日", 2022, None), ("1月22日", 2022, "o"), ("garbage", 2022, "o"), ("2月30日", 2022, "")],
        "date string, year int, memo string",
    )
    rows = holiday_list(schedule).collect()
    assert [(r.ds, r.is_make_up) for r in rows] == [(dt.date(2022, 1, 22), True)]


def test_date_texts(spark):
    df = spark.sql("select date'2022-02-01' as d")
    row = df.select(
        roc_year(F.col("d")).alias("roc"),
        day_label(F.col("d")).alias("label"),
        day_of_label(day_label(F.col("d"))).alias("back"),
        month_day_label(F.col("d")).alias("text"),
        day_of_month_day(F.lit("\"2月1日\""), F.lit(2022)).alias("parsed"),
        day_of_label(F.lit("2022-02-01")).alias("bad"),
    ).first()
    assert tuple(row) == (111, "2022_02_01", dt.date(2022, 2, 1), "2月1日", dt.date(2022, 2, 1), None)
