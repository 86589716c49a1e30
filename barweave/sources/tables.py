"""Partitioned parquet tables: reading with a declared schema, idempotent writing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table by its schema; one that was never written is empty."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_days(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    subject: str,
    first: str | None = None,
    last: str | None = None,
) -> DataFrame:
    """Rows of one subject and a closed range of days, by partition pruning."""
    rows = read_table(spark, path, schema).where(F.col("subject") == subject)
    if first is not None:
        rows = rows.where(F.col("ds") >= F.lit(first).cast("date"))
    if last is not None:
        rows = rows.where(F.col("ds") <= F.lit(last).cast("date"))
    return rows


def write_partitions(
    df: DataFrame, path: str, partitions: Sequence[str], sort: Sequence[str] = ()
) -> None:
    """Replace the partitions that occur in ``df``; all others stay.

    Rebalancing gathers each partition's rows into few files, yet splits a partition that
    is far larger than the rest, so a hot day does not end in one task.
    """
    rows = df.hint("rebalance", *partitions)
    if sort:
        rows = rows.sortWithinPartitions(*partitions, *sort)
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .parquet(path)
    )


def drop_days(spark: SparkSession, path: str, subject: str, days: Sequence[str]) -> None:
    """Remove the partitions of a subject's days (``yyyy_MM_dd``), whether there or not.

    Writing replaces the partitions that occur in the new rows; a day that has none any
    more is removed here, so that no rows of an earlier run stay.
    """
    jvm = spark._jvm
    files = jvm.org.apache.hadoop.fs.Path(path).getFileSystem(
        spark.sparkContext._jsc.hadoopConfiguration()
    )
    for day in days:
        partition = f"{path}/subject={subject}/ds={day.replace('_', '-')}"
        files.delete(jvm.org.apache.hadoop.fs.Path(partition), True)


def conform(df: DataFrame, schema: T.StructType, required: Sequence[str] = ()) -> DataFrame:
    """Columns of ``schema`` by name, in its order, or an error.

    A missing column is refused, whether nullable or not, and so is a type that would
    need a lossy cast. A null in a non-nullable column fails the job that meets it, since
    columns read from files are nullable whatever was written. Whether ``required``
    columns hold nulls is the quality gate's task; they only have to be there.
    """
    missing = [name for name in (*schema.names, *required) if name not in df.columns]
    if missing:
        raise ValueError(f"columns missing for the table: {missing}")

    def guarded(field: T.StructField) -> Column:
        if field.nullable:
            return F.col(field.name)
        value = F.col(field.name)
        error = F.raise_error(F.lit(f"null in column {field.name}"))
        return F.when(value.isNull(), error).otherwise(value).alias(field.name)

    shape = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])
    return df.select(*(guarded(field) for field in schema)).to(shape)
