"""Joins of facts to dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def only_value(dimension: DataFrame, column: str, /, **equals: str) -> Column:
    """The one value of ``column`` where all ``equals`` hold, as a scalar subquery.

    Runs once before the main query, so attaching it to facts needs no join.
    """
    for name, value in equals.items():
        dimension = dimension.where(F.col(name) == value)
    return dimension.select(column).scalar()


def with_single_id(
    rows: DataFrame, dimension: DataFrame, id_column: str, /, **equals: str
) -> DataFrame:
    """Every row with the id of one dimension row; no rows when that is absent."""
    found = rows.select(only_value(dimension, "id", **equals).alias(id_column), *rows.columns)
    return found.where(F.col(id_column).isNotNull())


def contract_ids(
    derivative: DataFrame, detail: DataFrame, derivative_type: str, keys: Sequence[str]
) -> DataFrame:
    """``derivative_detail_id`` per contract key of one derivative type."""
    typed = derivative.where(F.col("derivative_type") == derivative_type).select(
        F.col("id").alias("derivative_id"), F.col("name").alias("contract")
    )
    return detail.join(typed, "derivative_id").select(
        F.col("id").alias("derivative_detail_id"), *keys
    )


def detail_facts(bars: DataFrame, contracts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Bars with their contract's id in place of the contract key."""
    rest = [c for c in bars.columns if c not in keys]
    return bars.join(contracts, list(keys)).select("derivative_detail_id", *rest)
