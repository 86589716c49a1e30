"""Landed raw files to raw records.

Zip members are not readable by a built-in format, nor is Big5 text, so lines come from a data
source of its own (:mod:`barweave.sources.archives`), a task per member; parsing is left to
``from_csv``. In stores that only Hadoop's classes reach, one small ``mapInArrow`` step turns whole
files into lines, a task per archive.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barweave.functions.clock import day_of_label
from barweave.schemas import (
    ARCHIVE_DAY_PATTERN,
    ETF_RAW,
    FUTURES_RAW,
    HOLIDAY_RAW,
    INDEX_RAW,
    OPTIONS_RAW,
    ROC_YEAR_OFFSET,
    SPREAD_ARCHIVE_PATTERN,
)
from barweave.sources.archives import has_members, member_lines, qualified

LINES = "source_file string, member string, row_no bigint, line_no bigint, line string"
BATCH_LINES = 20_000
ROW_BITS = 34


def day_glob(days: Sequence[str] | None) -> str:
    """File-name pattern for archives of the given ``yyyy_MM_dd`` days, or of all."""
    if not days:
        return "*"
    return "*" + (days[0] if len(days) == 1 else "{" + ",".join(days) + "}") + "*"


def read_lines(
    spark: SparkSession,
    path: str,
    glob: str = "*",
    charset: str = "utf-8",
    line_end: str | None = "\r\n",
    zipped: bool = False,
) -> DataFrame:
    """Lines of text files or, if ``zipped``, of every member of zip archives.

    An archive that can't be read is an error, as is one that was cut short.

    ``line_no`` counts in a member, ``row_no`` in a whole file, both from 0. Members are
    decoded as streams, so memory is bounded by the compressed file and one batch.
    """
    batch_lines = BATCH_LINES

    def decode(batches):
        import io
        import zipfile

        import pyarrow as pa

        names = ["source_file", "member", "row_no", "line_no", "line"]

        def members(path, content):
            if not zipped:
                yield path, io.BytesIO(content)
                return
            with zipfile.ZipFile(io.BytesIO(content)) as archive:
                for info in archive.infolist():
                    if not info.is_dir():
                        with archive.open(info) as stream:
                            yield info.filename, stream

        def pack(path, member, row_no, line_no, lines):
            count = len(lines)
            columns = [
                pa.array([path] * count, pa.string()),
                pa.array([member] * count, pa.string()),
                pa.array(range(row_no, row_no + count), pa.int64()),
                pa.array(range(line_no, line_no + count), pa.int64()),
                pa.array(lines, pa.string()),
            ]
            return pa.RecordBatch.from_arrays(columns, names)

        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content")):
                path, row_no = path.as_py(), 0
                for member, stream in members(path, content.as_py()):
                    text = io.TextIOWrapper(stream, charset, "replace", newline=line_end)
                    lines, line_no = [], 0
                    for line in text:
                        lines.append(line.rstrip("\r\n"))
                        if len(lines) == batch_lines:
                            yield pack(path, member, row_no, line_no, lines)
                            row_no, line_no = row_no + len(lines), line_no + len(lines)
                            lines = []
                    if lines:
                        yield pack(path, member, row_no, line_no, lines)
                        row_no += len(lines)

    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    return files.select("path", "content").mapInArrow(decode, LINES)


def skip_lines(lines: DataFrame, head: int, stop: int | None = None) -> DataFrame:
    """Drop header lines of each member, and all from line ``stop`` on; blank lines too."""
    kept = (F.col("line_no") >= head) & (F.trim("line") != "")
    return lines.where(kept if stop is None else kept & (F.col("line_no") < stop))


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def tick_order(file_no: Column, row_no: Column) -> Column:
    """``seq`` of a record: the number of its file among the day's, then its row."""
    fits = row_no < (1 << ROW_BITS)
    error = F.raise_error(F.lit(f"a file has 2**{ROW_BITS} rows or more"))
    return F.shiftleft(file_no, ROW_BITS).bitwiseOR(F.when(fits, row_no).otherwise(error))


def with_file_numbers(records: DataFrame, files: DataFrame) -> DataFrame:
    """Records with ``ds`` and ``file_no``, their file's place among those of its day.

    Outright archives come before spread ones, then by name. ``files`` has a row per file
    (``source_file``); the numbering meets a day's names only.
    """
    name = file_name(F.col("source_file"))
    order = Window.partitionBy("ds").orderBy(
        name.rlike(SPREAD_ARCHIVE_PATTERN), name, F.col("source_file")
    )
    day = day_of_label(F.regexp_extract(name, ARCHIVE_DAY_PATTERN, 1))
    numbered = (
        files.select("source_file")
        .distinct()
        .withColumn("ds", day)
        .withColumn("file_no", F.row_number().over(order).cast("bigint"))
    )
    return records.join(numbered, "source_file")


def parse_csv(lines: DataFrame, schema: T.StructType, *extra: Column) -> DataFrame:
    """CSV fields of each line as text; fields beyond the schema are ignored."""
    options = {"quote": '"', "escape": '"', "mode": "PERMISSIVE"}
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    record = F.from_csv("line", ddl, options)
    return lines.withColumn("_record", record).select(
        *(F.col("_record").getField(name).alias(name) for name in schema.names), *extra
    )


def origin_columns() -> list[Column]:
    """Columns every raw record carries besides its fields."""
    return [
        F.col("ds"),
        tick_order(F.col("file_no"), F.col("row_no")).alias("seq"),
        F.col("source_file"),
        F.col("line_no"),
    ]


def _read_csv_lines(
    spark: SparkSession,
    path: str,
    days: Sequence[str] | None,
    charset: str,
    schema: T.StructType,
    head: int,
    stop: int | None = None,
    zipped: bool = False,
) -> DataFrame:
    if has_members(qualified(spark, path)):
        lines = member_lines(spark, path, list(days or ()), charset, zipped)
        numbered = skip_lines(lines, head, stop).withColumn("row_no", F.col("line_no"))
    else:
        glob = day_glob(days)
        lines = skip_lines(read_lines(spark, path, glob, charset, zipped=zipped), head, stop)
        files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
        numbered = with_file_numbers(lines, files.select(F.col("path").alias("source_file")))
    return parse_csv(numbered, schema, *origin_columns())


def read_futures(
    spark: SparkSession, path: str, days: Sequence[str] | None = None, charset: str = "utf-8"
) -> DataFrame:
    """Outright and spread archives alike: both names contain the day."""
    return _read_csv_lines(spark, path, days, charset, FUTURES_RAW, 1, zipped=True)


def read_options(
    spark: SparkSession, path: str, days: Sequence[str] | None = None, charset: str = "utf-8"
) -> DataFrame:
    return _read_csv_lines(spark, path, days, charset, OPTIONS_RAW, 2, zipped=True)


def read_index(
    spark: SparkSession,
    path: str,
    days: Sequence[str] | None = None,
    charset: str = "utf-8",
    stop: int | None = None,
) -> DataFrame:
    """Index values, of which the first two fields matter."""
    return _read_csv_lines(spark, path, days, charset, INDEX_RAW, 2, stop)


def read_etf(spark: SparkSession, path: str, days: Sequence[str] | None = None) -> DataFrame:
    """One JSON document per day with the ticks nested in ``data``."""
    name = F.col("_metadata.file_path").alias("source_file")
    files = spark.read.option("pathGlobFilter", day_glob(days))
    documents = files.schema(ETF_RAW).option("multiLine", True).json(path).select("data", name)
    # Names only: no content is read for them.
    listed = spark.read.format("binaryFile").option("pathGlobFilter", day_glob(days)).load(path)
    ticks = documents.select("source_file", F.posexplode("data").alias("row_no", "tick"))
    ticks = ticks.withColumn("row_no", F.col("row_no").cast("bigint"))
    ticks = with_file_numbers(ticks, listed.select(name)).withColumn("line_no", F.col("row_no"))
    return ticks.select("tick.*", *origin_columns())


def read_holidays(spark: SparkSession, path: str, charset: str = "big5") -> DataFrame:
    """Holiday schedules, one file per year of the local calendar named in the file."""
    lines = skip_lines(read_lines(spark, path, "*", charset, line_end=None), 2)
    roc = F.regexp_extract(file_name(F.col("source_file")), r"_(\d+)\.csv$", 1).try_cast("int")
    return parse_csv(lines, HOLIDAY_RAW, (roc + ROC_YEAR_OFFSET).alias("year"))


RAW_READERS = {
    "index": read_index,
    "etf": read_etf,
    "futures": read_futures,
    "options": read_options,
}
