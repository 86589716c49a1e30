"""Candle frames: the query side of the warehouse."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barweave.operators.zones import in_zones


def _candle_columns() -> list[Column]:
    prices = ("open", "high", "low", "close")
    return [
        F.col("datetime"),
        *(F.col(f"price_{name}").cast("double").alias(name) for name in prices),
    ]


def in_range(
    history: DataFrame, scale: int, start: str, end: str, zones: DataFrame | None = None
) -> DataFrame:
    """Rows of one scale with ``start <= datetime <= end``.

    With a zone map only days whose times meet the range are read. Rows are sorted by scale
    and time inside their files, so row groups prune both.
    """
    first, last = _instant(start), _instant(end)
    rows = history.where((F.col("scale") == scale) & F.col("datetime").between(first, last))
    return rows if zones is None else in_zones(rows, zones, first, last)


def _instant(text: str) -> Column:
    return F.lit(text).cast("timestamp")


def index_candles(
    index: DataFrame,
    history: DataFrame,
    name: str,
    scale: int,
    start: str,
    end: str,
    zones: DataFrame | None = None,
) -> DataFrame:
    """Open, high, low and close of an index in time order."""
    wanted = index.where(F.col("name") == name).select(F.col("id").alias("index_id"))
    return in_range(history, scale, start, end, zones).join(wanted, "index_id").select(
        *_candle_columns()
    ).orderBy("datetime")


def contract_candles(
    derivative: DataFrame,
    detail: DataFrame,
    history: DataFrame,
    name: str,
    expire_code: str,
    scale: int,
    start: str,
    end: str,
    zones: DataFrame | None = None,
) -> DataFrame:
    """Candles with volume of a derivative's contract with the given expiry code."""
    named = derivative.where(F.col("name") == name).select(F.col("id").alias("derivative_id"))
    wanted = (
        detail.where(F.col("expire_code") == expire_code)
        .join(named, "derivative_id")
        .select(F.col("id").alias("derivative_detail_id"))
    )
    return in_range(history, scale, start, end, zones).join(wanted, "derivative_detail_id").select(
        *_candle_columns(), "volume"
    ).orderBy("datetime")
