"""A range of trading days from landed files to the warehouse.

One day and years of them are the same three jobs per subject: ``ds`` is a column and a
partition, not a loop. Each job replaces the partitions it covers, so running a day
again gives the same tables.
"""

from __future__ import annotations

import datetime
from collections.abc import Sequence
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barweave.functions.clock import day_label
from barweave.operators.bars import bars
from barweave.operators.calendar import days_between, holiday_list, trading_days
from barweave.operators.labels import label_expiry
from barweave.operators.normalize import NORMALIZERS, dropped_counts
from barweave.operators.quality import Counts, DataQualityError, null_counts, tick_counts
from barweave.plans.layout import Layout
from barweave.plans.warehouse import load_subject
from barweave.schemas import BARS, SCALES, SUBJECTS, TICKS, Subject
from barweave.sources.landed import RAW_READERS, read_holidays
from barweave.sources.tables import conform, drop_days, read_days, write_partitions

DAY_PARTITIONS = ("subject", "ds")


def open_days(spark: SparkSession, layout: Layout, first: str, last: str) -> list[str]:
    """Trading days of a closed range (``yyyy-MM-dd``), as ``yyyy_MM_dd``.

    At most one row per calendar day comes to the driver, to name the files to read.
    """
    holidays = holiday_list(read_holidays(spark, layout.holidays))
    found = trading_days(days_between(spark, first, last), holidays)
    labels = found.select(day_label(F.col("ds")).alias("day")).sort("day")
    return [row.day for row in labels.collect()]


def ingest(
    spark: SparkSession, layout: Layout, subject: str, days: Sequence[str], charset: str = "utf-8"
) -> dict[str, int]:
    """Landed files to the tick table.

    Returns what the write counted on its way: records read, left out by cause, ticks written and
    those with an unreadable time, price or volume.
    """
    reader = RAW_READERS[subject]
    if subject != "etf":
        reader = partial(reader, charset=charset)
    counts = Counts()
    raw = counts.on(
        reader(spark, layout.raw(subject), days), read=F.count(F.lit(1)), **dropped_counts(subject)
    )
    ticks = counts.on(conform(NORMALIZERS[subject](raw), TICKS), **tick_counts())
    with counts.kept(spark):
        write_partitions(ticks, layout.ticks, DAY_PARTITIONS, ("contract", "ts", "seq"))
    return counts.values()


def staged_bars(ticks: DataFrame, subject: Subject, scales: Sequence[int] = SCALES) -> DataFrame:
    """Bars of whole days in the layout of the bar table, labelled where expiries are."""
    volume = "volume" if subject.has_volume else None
    made = bars(ticks, ["ds", *subject.bar_keys], scales, volume=volume)
    if subject.label_expiry:
        made = label_expiry(made)
    made = made.withColumn("subject", F.lit(subject.name))

    def column(field: T.StructField) -> Column:
        found = F.col(field.name) if field.name in made.columns else F.lit(None)
        return found.cast(field.dataType).alias(field.name)

    return made.select(*map(column, BARS))


def aggregate(spark: SparkSession, layout: Layout, subject: str, first: str, last: str) -> None:
    """Tick table to bar table."""
    ticks = read_days(spark, layout.ticks, TICKS, subject, first, last)
    made = staged_bars(ticks, SUBJECTS[subject])
    write_partitions(made, layout.bars, DAY_PARTITIONS, ("scale", "contract", "datetime"))


def load(spark: SparkSession, layout: Layout, subject: str, days: Sequence[str]) -> list[str]:
    """Bar table to warehouse, days with nulls or without bars left out and returned."""
    kind = SUBJECTS[subject]
    first, last = (days[i].replace("_", "-") for i in (0, -1))
    staged = read_days(spark, layout.bars, BARS, subject, first, last)
    counts = null_counts(staged, kind.required, by=("ds",))
    nulls = sum(F.col(f"null_{c}") for c in kind.required)
    passed = counts.where(nulls == 0).select(day_label(F.col("ds")).alias("day"))
    good = {row.day for row in passed.collect()} & set(days)
    if good:
        keep = staged.where(F.col("ds").isin([_date(day) for day in sorted(good)]))
        columns = T.StructType([*kind.staging.fields, *BARS.fields[-2:]])
        load_subject(spark, layout, subject, conform(keep, columns, kind.required))
    return [day for day in days if day not in good]


def _date(day: str) -> datetime.date:
    return datetime.datetime.strptime(day, "%Y_%m_%d").date()


def clear(spark: SparkSession, layout: Layout, subject: str, days: Sequence[str]) -> None:
    """Remove ticks, bars and facts of the days a run is about to make anew."""
    history = "index_history" if subject == "index" else "derivative_detail_history"
    for path in (layout.ticks, layout.bars, layout.warehouse(history)):
        drop_days(spark, path, subject, days)


class Days(list):
    """Days that have run, as a list, with ``counts`` of :func:`ingest` by subject."""

    def __init__(self, days: Sequence[str] = (), counts: dict[str, dict[str, int]] | None = None):
        super().__init__(days)
        self.counts = counts or {}


def run_days(
    spark: SparkSession,
    layout: Layout,
    first: str,
    last: str,
    subjects: Sequence[str] = tuple(SUBJECTS),
    charset: str = "utf-8",
    only: Sequence[str] | None = None,
) -> Days:
    """Run all trading days of a range, or those of ``only``; returns them with their counts.

    Subjects do not hold each other up: what can be read and passes the gate is loaded,
    then everything else is raised as one error that names subjects, days, causes and counts. Rows
    of earlier runs do not stay for a day that failed.
    """
    days = open_days(spark, layout, first, last)
    if only is not None:
        days = [day for day in days if day in set(only)]
    if not days:
        return Days()
    counts: dict[str, dict[str, int]] = {}
    failed: dict[str, object] = {}
    cause = None
    for subject in subjects:
        try:
            clear(spark, layout, subject, days)
            counts[subject] = ingest(spark, layout, subject, days, charset)
            aggregate(spark, layout, subject, *(days[i].replace("_", "-") for i in (0, -1)))
            left_out = load(spark, layout, subject, days)
            if left_out:
                failed[subject] = left_out
        except Exception as error:  # any cause: the other subjects still run
            cause = cause or error
            failed[subject] = str(error).split("\n")[0]
    if failed:
        raise DataQualityError(f"not loaded: {failed}; counts: {counts}") from cause
    return Days(days, counts)


def run_day(spark: SparkSession, layout: Layout, ds: str, **options) -> Days:
    return run_days(spark, layout, ds, ds, **options)
