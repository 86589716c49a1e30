"""Queries over the given tables, each with the SQL it must agree with.

Results are plain: decimals as doubles, dates as text, instants without zone.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barweave.session import pin_runtime

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def checked(sql: str) -> Callable[[Query], Query]:
    """Register a query under its function name together with its SQL."""

    def register(query: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(query(pin_runtime(spark), sf_dir))

        run.__name__, run.__doc__ = query.__name__, query.__doc__
        QUERIES[query.__name__] = run
        ORACLES[query.__name__] = sql
        return query

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def plain(df: DataFrame) -> DataFrame:
    def convert(field: T.StructField):
        if isinstance(field.dataType, T.DecimalType):
            return F.col(field.name).cast("double").alias(field.name)
        if isinstance(field.dataType, T.TimestampType):
            return F.col(field.name).cast("timestamp_ntz").alias(field.name)
        if isinstance(field.dataType, T.DateType):
            return F.col(field.name).cast("string").alias(field.name)
        if field.name == "price_std":
            return F.round("price_std", 6).alias("price_std")
        return F.col(field.name)

    return df.select(*(convert(field) for field in df.schema.fields))
