"""Which landed files have changed since they were last run: a manifest table.

A file is known by path, length, time and checksum. Listing reads no content; checksums are read only
for the days of files whose length or time differs from the manifest's, and only a file whose
checksum differs makes its day run again. So an archive that is replaced under its name is seen, and one
that is merely copied anew is not run.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barweave.functions.clock import day_label, day_of_label
from barweave.plans.daily import run_days
from barweave.plans.layout import Layout
from barweave.schemas import ARCHIVE_DAY_PATTERN, LANDED_FILES, SUBJECTS
from barweave.session import materialize
from barweave.sources.landed import file_name
from barweave.sources.tables import read_table, write_partitions

MANIFEST_PARTITIONS = ("subject", "year")
STATE = ("path", "length", "modified")


def _listed(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    return spark.read.format("binaryFile").load(folder).select(
        "path", "length", F.col("modificationTime").alias("modified"), *columns
    )


def landed_files(spark: SparkSession, layout: Layout, subjects: Sequence[str]) -> DataFrame:
    """Files whose names hold a day: ``subject``, ``path``, ``length``, ``modified``, ``ds``.

    The folder of a subject that nothing has landed for may be absent.
    """
    day = day_of_label(F.regexp_extract(file_name(F.col("path")), ARCHIVE_DAY_PATTERN, 1))
    found = []
    for subject in subjects:
        try:
            files = _listed(spark, layout.raw(subject))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        found.append(files.select(F.lit(subject).alias("subject"), "*", day.alias("ds")))
    if not found:
        empty = "subject string, path string, length bigint, modified timestamp, ds date"
        return spark.createDataFrame([], empty)
    return reduce(DataFrame.unionByName, found).where(F.col("ds").isNotNull())


def manifest(spark: SparkSession, layout: Layout) -> DataFrame:
    return read_table(spark, layout.manifest, LANDED_FILES)


def touched_files(spark: SparkSession, layout: Layout, subjects: Sequence[str]) -> DataFrame:
    """Files that are new or whose length or time has changed, as a manifest has them.

    ``changed`` says whether their content has: the checksum is not the manifest's. Files that have
    gone are not touched, so clearing the landing folder leaves the tables alone.
    """
    known = manifest(spark, layout)
    seen = known.select(*STATE)
    candidates = materialize(landed_files(spark, layout, subjects).join(seen, [*STATE], "left_anti"))
    if candidates.isEmpty():
        columns = candidates.select("*", F.lit("").alias("checksum"), F.year("ds").alias("year"))
        return columns.withColumn("changed", F.lit(False))
    # Content is read of the candidates' days only: the file source prunes by name, not by join. At
    # most one row per calendar day comes to the driver for that.
    days = [row.day for row in candidates.select(day_label(F.col("ds")).alias("day")).distinct().collect()]
    glob = "*{" + ",".join(sorted(days)) + "}*"
    held = [row.subject for row in candidates.select("subject").distinct().collect()]
    read = [
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .load(layout.raw(subject))
        .select("path", F.sha2("content", 256).alias("checksum"))
        for subject in held
    ]
    sums = reduce(DataFrame.unionByName, read)
    before = known.select("path", F.col("checksum").alias("_before"))
    return (
        candidates.join(sums, "path")
        .join(before, "path", "left")
        .withColumn("changed", ~F.col("checksum").eqNullSafe(F.col("_before")))
        .withColumn("year", F.year("ds"))
        .drop("_before")
    )


def record_files(spark: SparkSession, layout: Layout, files: DataFrame) -> None:
    """Put files into the manifest, in place of what it says of their paths.

    A subject's year is one small file.
    """
    names = LANDED_FILES.names
    years = files.select(*MANIFEST_PARTITIONS).distinct()
    stays = (
        manifest(spark, layout)
        .join(years, [*MANIFEST_PARTITIONS], "left_semi")
        .join(files.select("path"), "path", "left_anti")
    )
    merged = materialize(stays.select(*names).unionByName(files.select(*names)))
    write_partitions(merged, layout.manifest, MANIFEST_PARTITIONS, ("ds", "path"))


def run_changed(
    spark: SparkSession,
    layout: Layout,
    subjects: Sequence[str] = tuple(SUBJECTS),
    charset: str = "utf-8",
    run: Callable[[SparkSession, Layout, list[str]], object] | None = None,
) -> list[str]:
    """Run the days that have a new or changed file, as one range; returns them.

    What the run goes by is listed before it and recorded after it has succeeded: a file that changes
    meanwhile, or a run that fails, makes the day run again the next time.
    """
    touched = materialize(touched_files(spark, layout, subjects))
    # At most one row per calendar day.
    changed = touched.where("changed").select(day_label(F.col("ds")).alias("day")).distinct()
    days = sorted(row.day for row in changed.collect())
    if days:
        if run is not None:
            run(spark, layout, days)
        else:
            first, last = (days[i].replace("_", "-") for i in (0, -1))
            run_days(spark, layout, first, last, subjects, charset, only=days)
    if not touched.isEmpty():
        record_files(spark, layout, touched)
    return days
