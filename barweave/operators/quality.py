"""Checks before a load: nulls, duplicate keys, orphans, unreadable records."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


class DataQualityError(Exception):
    """The data must not be loaded."""


def null_counts(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Row count and nulls per column in one pass, in all or per group."""
    return df.groupBy(*by).agg(
        F.count("*").alias("n_rows"),
        *(F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns),
    )


def null_flags(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``ok_<column>``: true without nulls, null (not true) when there are no rows."""
    counts = null_counts(df, columns, by)
    return counts.select(
        *by,
        *(
            F.when(F.col("n_rows") > 0, F.col(f"null_{c}") == 0).alias(f"ok_{c}")
            for c in columns
        ),
    )


def require_complete(df: DataFrame, columns: Sequence[str], name: str) -> None:
    """Raise unless ``df`` has rows and no null in ``columns``."""
    counts = null_counts(df, columns).first().asDict()
    if counts["n_rows"] == 0:
        raise DataQualityError(f"{name}: no rows")
    bad = {c: counts[f"null_{c}"] for c in columns if counts[f"null_{c}"]}
    if bad:
        raise DataQualityError(f"{name}: nulls in {bad}")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).where(F.col("n_rows") > 1)


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Non-null child keys without a parent and the rows they have.

    Counting first leaves one row per key, so a key that many rows share is not a hot
    spot of the join, and the join reuses the partitioning of the count.
    """
    counted = (
        child.where(F.col(child_key).isNotNull())
        .groupBy(child_key)
        .agg(F.count("*").alias("n_rows"))
    )
    known = parent.select(F.col(parent_key).alias("_parent"))
    return counted.join(known, counted[child_key] == known["_parent"], "left_anti")


def rejected_ticks(ticks: DataFrame) -> DataFrame:
    """Per subject and day: ticks whose time, price or volume could not be read."""
    return null_counts(ticks, ("ts", "price", "volume"), by=("subject", "ds"))


class Counts:
    """Named counts that a write makes as it goes, by observed metrics: no pass of their own.

    ``on`` marks a place in a plan; ``values`` are there once an action on it has succeeded. The
    action runs inside ``kept``: where no row is left, adaptive execution would otherwise cut the
    marked places from the plan, and their counts with them.
    """

    RULES = "spark.sql.adaptive.optimizer.excludedRules"
    EMPTY = "org.apache.spark.sql.execution.adaptive.AQEPropagateEmptyRelation"

    def __init__(self) -> None:
        self._seen: list[tuple[Observation, list[str]]] = []

    def on(self, df: DataFrame, **counts: Column) -> DataFrame:
        seen = Observation()
        self._seen.append((seen, list(counts)))
        return df.observe(seen, *(column.cast("bigint").alias(n) for n, column in counts.items()))

    @contextmanager
    def kept(self, spark: SparkSession) -> Iterator[None]:
        before = spark.conf.get(self.RULES, None)
        spark.conf.set(self.RULES, f"{before},{self.EMPTY}" if before else self.EMPTY)
        try:
            yield
        finally:
            if before is None:
                spark.conf.unset(self.RULES)
            else:
                spark.conf.set(self.RULES, before)

    def values(self) -> dict[str, int]:
        """Counts of nothing are 0."""
        return {n: seen.get.get(n) or 0 for seen, names in self._seen for n in names}


def tick_counts() -> dict[str, Column]:
    """Ticks written, and those of them with an unreadable field."""
    unreadable = {f"no_{c}": F.count_if(F.col(c).isNull()) for c in ("ts", "price", "volume")}
    return {"written": F.count(F.lit(1)), **unreadable}
