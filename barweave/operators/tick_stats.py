"""Ticks together with the statistics of the bars they fall in."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barweave.functions.buckets import bar_end_micros, instant_micros
from barweave.operators.bars import bars, bars_with_minutes
from barweave.operators.keys import null_safe_match
from barweave.schemas import SCALES

STATS = (
    "price_open",
    "price_high",
    "price_low",
    "price_close",
    "price_mean",
    "price_std",
)


def first_ticks(
    ticks: DataFrame, keys: Sequence[str], columns: Sequence[str], scales: Sequence[int] = SCALES
) -> DataFrame:
    """Chosen columns of the first tick of each bar: the row a rank of 1 would keep.

    Found by aggregation, so no bar's ticks are ever gathered and sorted.
    """
    kept = bars(ticks, keys, scales, volume=None, first_tick=columns)
    return kept.select(*keys, "scale", "datetime", *columns)


def tick_bar_stats(
    ticks: DataFrame, keys: Sequence[str], scales: Sequence[int] = SCALES
) -> DataFrame:
    """Each tick once per scale, with its bar's statistics.

    Bars carry a bitmap of their minutes that have ticks through the roll-up; exploded, it brings
    the statistics to one row per (keys, minute) holding all scales, and the ticks meet them
    there. The ticks are read once for the bars and once to meet them, cross the network once,
    not once per scale, and a hot minute is a skewed join partition that adaptive
    execution can split.
    """
    values = (*STATS, "volume")
    minute_keys = (*keys, "_minute")
    bar_struct = F.struct("scale", "datetime", *(F.col(c).alias(f"bar_{c}") for c in values))
    by_minute = (
        bars_with_minutes(ticks, keys, scales)
        .select(*keys, F.explode("minutes").alias("_minute"), bar_struct.alias("_bar"))
        .groupBy(*minute_keys)
        .agg(F.collect_list("_bar").alias("_bars"))
    )
    minute = bar_end_micros(instant_micros(F.col("ts")), 1)
    timed = ticks.where(F.col("ts").isNotNull()).withColumn("_minute", minute)
    joined = timed.alias("l").join(by_minute.alias("r"), null_safe_match(minute_keys))
    return joined.select(*(F.col(f"l.{c}") for c in ticks.columns), F.inline("r._bars"))
