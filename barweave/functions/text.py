"""Cleaning of raw text fields; a field that cannot be read becomes null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from barweave.schemas import CLOCK_PATTERN, PRICE, SPREAD_PATTERN


def without_spaces(text: Column) -> Column:
    return F.replace(text, F.lit(" "), F.lit(""))


def clock_time(text: Column) -> Column:
    """``HH:mm:ss`` out of a wrapped cell, empty when there is none."""
    return F.regexp_extract(text, CLOCK_PATTERN, 1)


def to_price(text: Column) -> Column:
    """Decimal price from text that may be padded, comma-grouped or a dash.

    The dash stands in most fields of spread columns and is sorted out before the cast,
    where each failure would cost an exception.
    """
    digits = F.replace(F.trim(text), F.lit(","), F.lit(""))
    return F.nullif(digits, F.lit("-")).try_cast(PRICE)


def to_count(text: Column) -> Column:
    return F.trim(text).try_cast("int")


def near_leg(expire: Column) -> Column:
    """First expiry of ``near/far``, empty for an outright expiry."""
    return F.regexp_extract(expire, SPREAD_PATTERN, 1)


def far_leg(expire: Column) -> Column:
    return F.regexp_extract(expire, SPREAD_PATTERN, 2)
