"""Run every trading day whose files have landed since the last time."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from barweave.plans.daily import run_days
from barweave.plans.layout import Layout
from barweave.schemas import ARCHIVE_DAY_PATTERN, SUBJECTS
from barweave.sources.landed import file_name

FILES = "path string, modificationTime timestamp, length bigint, content binary"


def landed_days(spark: SparkSession, layout: Layout, subjects: Sequence[str]) -> DataFrame:
    """Stream of the days named by newly landed files; no content is carried on."""
    streams = [
        spark.readStream.format("binaryFile").schema(FILES).load(layout.raw(subject)).select("path")
        for subject in subjects
    ]
    paths = streams[0]
    for other in streams[1:]:
        paths = paths.unionByName(other)
    day = F.regexp_extract(file_name(F.col("path")), ARCHIVE_DAY_PATTERN, 1)
    return paths.select(day.alias("day")).where(F.col("day") != "")


def catch_up(
    spark: SparkSession,
    layout: Layout,
    checkpoint: str,
    subjects: Sequence[str] = tuple(SUBJECTS),
    run: Callable[[SparkSession, Layout, list[str]], object] | None = None,
) -> StreamingQuery:
    """Process all new days as one range, then stop.

    The checkpoint remembers files, not results: a day is always run as a whole, so a file
    that lands late makes its day run again and replace itself.
    """
    def run_landed(session: SparkSession, where: Layout, days: list[str]) -> object:
        first, last = (days[i].replace("_", "-") for i in (0, -1))
        return run_days(session, where, first, last, subjects=subjects, only=days)

    run = run or run_landed

    def process(batch: DataFrame, _: int) -> None:
        # One row per day: a file name is all that was read of each file.
        days = [row.day for row in batch.distinct().orderBy("day").collect()]
        if days:
            run(batch.sparkSession, layout, days)

    return (
        landed_days(spark, layout, subjects)
        .writeStream.foreachBatch(process)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
