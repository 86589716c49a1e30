"""Bars of one scale over a tick stream, emitted once the watermark has passed them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barweave.schemas import PRICE


def live_bars(
    ticks: DataFrame,
    keys: Sequence[str],
    scale: int,
    lateness: str,
    volume: bool = True,
) -> DataFrame:
    """Append-mode bars of a streaming tick table (``ts``, ``seq``, ``price``, ``volume``).

    Windows are left-closed, bars right-closed: shifting the time by a microsecond makes
    one the other. State is one row per open bar.
    """
    order = F.struct("ts", "seq")
    price = F.col("price").cast(PRICE)
    shifted = F.col("ts") - F.expr("interval 1 microsecond")
    bar = F.window("_shifted", f"{scale} minutes")
    grouped = (
        ticks.withColumn("_shifted", shifted)
        .withWatermark("_shifted", lateness)
        .groupBy(*keys, bar.alias("_bar"))
        .agg(
            F.min_by(price, order).alias("price_open"),
            F.max(price).alias("price_high"),
            F.min(price).alias("price_low"),
            F.max_by(price, order).alias("price_close"),
            F.avg(price).alias("price_mean"),
            F.stddev_samp(price).alias("price_std"),
            *([F.sum("volume").alias("volume")] if volume else []),
        )
    )
    return grouped.select(
        *keys,
        F.lit(scale).alias("scale"),
        F.col("_bar.end").alias("datetime"),
        *(c for c in grouped.columns if c not in (*keys, "_bar")),
    )
