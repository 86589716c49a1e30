"""Zone maps: which times the days of a history hold.

Facts lie by the day of the archive they came from, and no rule ties a bar's time to that day. A
zone map has one row per subject and day with the least and the greatest time in it. Joined
with the facts on their partition columns it lets Spark prune days while the query runs, so a query
for one day does not open the files of all others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DAY = ("subject", "ds")
ZONE_PARTITIONS = ("subject", "year")


def zones_of(rows: DataFrame, time: str = "datetime") -> DataFrame:
    """``subject``, ``ds``, ``first`` and ``last`` of each day; one without times has nulls."""
    return rows.groupBy(*DAY).agg(F.min(time).alias("first"), F.max(time).alias("last"))


def merged_zones(known: DataFrame, fresh: DataFrame, widen: bool) -> DataFrame:
    """All zones of the subjects and years that ``fresh`` is about, with their ``year``.

    ``widen`` keeps what is known of a day inside its zone; else the fresh one takes its place.
    """
    year = F.year("ds").alias("year")
    touched = fresh.select("subject", year).distinct()
    same_years = known.withColumn("year", F.year("ds")).join(touched, ["subject", "year"], "left_semi")
    kept = same_years if widen else same_years.join(fresh, [*DAY], "left_anti")
    columns = (*DAY, "first", "last")
    both = kept.select(*columns).unionByName(fresh.select(*columns))
    return both.groupBy(*DAY).agg(F.min("first").alias("first"), F.max("last").alias("last")).withColumn(
        "year", F.year("ds")
    )


def in_zones(history: DataFrame, zones: DataFrame, start: Column, end: Column) -> DataFrame:
    """Rows of the days whose zone meets the closed range: a semi join on the partition columns.

    The zone map has a row per day, which Spark broadcasts by its size, and reuses to prune.
    """
    met = zones.where((F.col("first") <= end) & (F.col("last") >= start)).select(*DAY)
    return history.join(met, [*DAY], "left_semi").select(*history.columns)
