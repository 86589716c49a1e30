"""Surrogate keys and dimension rows that are inserted once."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barweave.session import materialize

POSITION_BITS = 33  # layout of monotonically_increasing_id: partition, then position


def null_safe_match(keys: Sequence[str], left: str = "l", right: str = "r") -> Column:
    """Equality of all keys of two aliased sides, where null matches null."""
    return reduce(
        Column.__and__, (F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys)
    )


def absent_rows(existing: DataFrame, candidates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct candidate keys that ``existing`` does not hold."""
    fresh = candidates.select(*keys).distinct().alias("l")
    return fresh.join(existing.alias("r"), null_safe_match(keys), "left_anti")


def number_rows(rows: DataFrame, keys: Sequence[str], start: Column, name: str = "id") -> DataFrame:
    """Consecutive ids in key order, without gathering the rows in one task.

    The range-sorted rows are written to the checkpoint folder with their place, because
    partition and position must not change between counting and numbering, not even
    when an executor is lost. Only one count per partition meets in a single task.
    """
    placed = materialize(
        rows.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_place", F.monotonically_increasing_id())
    )
    part = F.shiftright("_place", POSITION_BITS)
    position = F.col("_place").bitwiseAND((1 << POSITION_BITS) - 1)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(part.alias("_part"))
        .agg(F.count("*").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    )
    # One row per shuffle partition: the broadcast is bounded by the partition count.
    numbered = placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    return numbered.select(
        (start + F.col("_before") + position).cast("int").alias(name), *rows.columns
    )


def next_id(dimension: DataFrame) -> Column:
    """First free id of a dimension, 0 for an empty one."""
    return dimension.agg(F.coalesce(F.max("id") + 1, F.lit(0)).cast("bigint")).scalar()


def new_dimension_rows(
    existing: DataFrame, candidates: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """Rows to append to a dimension so that it holds every candidate key once."""
    return number_rows(absent_rows(existing, candidates, keys), keys, next_id(existing))
