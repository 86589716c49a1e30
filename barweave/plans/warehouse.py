"""Loading staged bars into the warehouse, and its tables as views.

Dimensions are written before facts and only ever appended to; facts replace their
partitions. A load that broke off is repaired by running it again. Loads of one
warehouse run one after the other, since ids continue from the highest one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barweave.operators.candles import contract_candles, index_candles
from barweave.operators.keys import new_dimension_rows
from barweave.operators.lookups import (
    contract_ids,
    detail_facts,
    with_single_id,
)
from barweave.operators.zones import ZONE_PARTITIONS, merged_zones, zones_of
from barweave.plans.layout import Layout
from barweave.schemas import (
    DERIVATIVE_DIM,
    DETAIL_DIM,
    DETAIL_HISTORY,
    DETAIL_KEYS,
    INDEX_DIM,
    INDEX_HISTORY,
    INDEX_MARKET,
    INDEX_NAME,
    SUBJECTS,
    ZONES,
    Subject,
)
from barweave.session import materialize
from barweave.sources.tables import conform, read_table, write_partitions

TABLES = {
    "index": INDEX_DIM,
    "index_history": INDEX_HISTORY,
    "derivative": DERIVATIVE_DIM,
    "derivative_detail": DETAIL_DIM,
    "derivative_detail_history": DETAIL_HISTORY,
}
HISTORIES = ("index_history", "derivative_detail_history")
FACT_PARTITIONS = ("subject", "ds")


def warehouse_table(spark: SparkSession, layout: Layout, name: str) -> DataFrame:
    return read_table(spark, layout.warehouse(name), TABLES[name])


def zone_map(spark: SparkSession, layout: Layout, history: str) -> DataFrame | None:
    """The zone map of a history; None where none was ever written, so that nothing is pruned."""
    zones = read_table(spark, layout.zones(history), ZONES)
    return zones if zones.inputFiles() else None


def record_zones(
    spark: SparkSession, layout: Layout, history: str, rows: DataFrame, widen: bool = False
) -> None:
    """Put the zones of the days in ``rows`` into a history's zone map.

    A load widens the zones before it writes facts and sets them when these are there, so a load
    that broke off leaves zones that are too wide at most. A subject's year is one small file.
    """
    known = read_table(spark, layout.zones(history), ZONES)
    merged = materialize(merged_zones(known, zones_of(rows), widen))
    write_partitions(merged, layout.zones(history), ZONE_PARTITIONS, ("ds",))


def rebuild_zones(spark: SparkSession, layout: Layout, history: str) -> None:
    """The zone map of a whole history anew, also for one that has been loaded without."""
    record_zones(spark, layout, history, warehouse_table(spark, layout, history))


def register_views(spark: SparkSession, layout: Layout) -> None:
    """The tables as temporary views, and table functions that prune days, for SQL text.

    ``index_history_between(scale, start, end)`` and ``derivative_detail_history_between`` give
    a history's rows of one scale and a closed range of times, by the zone map where there is one.
    """
    for name in TABLES:
        warehouse_table(spark, layout, name).createOrReplaceTempView(name)
    for name in HISTORIES:
        zones = zone_map(spark, layout, name)
        met = ""
        if zones is not None:
            zones.createOrReplaceTempView(f"{name}_zones")
            met = f"""left semi join (select subject, ds from {name}_zones
                where first <= end_time and last >= start_time) z
              on h.subject = z.subject and h.ds = z.ds"""
        fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in TABLES[name])
        spark.sql(
            f"""create or replace temporary function {name}_between(
                  of_scale int, start_time timestamp, end_time timestamp)
                returns table({fields})
                return select {", ".join(TABLES[name].names)} from (select * from {name}
                  where scale = of_scale and datetime between start_time and end_time) h {met}"""
        )


def add_dimension_rows(
    spark: SparkSession, layout: Layout, name: str, candidates: DataFrame, keys: Sequence[str]
) -> None:
    """Append what is not there yet; most days bring nothing new and write nothing."""
    existing = warehouse_table(spark, layout, name)
    fresh = new_dimension_rows(existing, candidates, keys)
    if not fresh.isEmpty():
        fresh.write.mode("append").parquet(layout.warehouse(name))


def load_index(spark: SparkSession, layout: Layout, staged: DataFrame) -> None:
    _ensure_index(spark, layout)
    index = warehouse_table(spark, layout, "index")
    facts = with_single_id(staged, index, "index_id", name=INDEX_NAME, market=INDEX_MARKET)
    _write_facts(spark, facts, staged, layout, "index_history", INDEX_HISTORY, "index_id")


def load_derivatives(
    spark: SparkSession, layout: Layout, subject: Subject, staged: DataFrame
) -> None:
    """Derivatives, contract details and history of one derivative subject."""
    _ensure_index(spark, layout)
    index = warehouse_table(spark, layout, "index")
    named = staged.select(
        F.col("contract").alias("name"), F.lit(subject.derivative_type).alias("derivative_type")
    ).distinct()
    candidates = with_single_id(named, index, "index_id", name=INDEX_NAME, market=INDEX_MARKET)
    add_dimension_rows(
        spark, layout, "derivative", candidates, ("index_id", "name", "derivative_type")
    )

    derivative = warehouse_table(spark, layout, "derivative")
    typed = derivative.where(F.col("derivative_type") == subject.derivative_type).select(
        F.col("id").alias("derivative_id"), F.col("name").alias("contract")
    )
    traded = staged.select(*subject.staging_keys).distinct().join(typed, "contract")
    details = traded.select(
        *(
            F.col(key) if key in traded.columns else F.lit(None).cast(T.StringType()).alias(key)
            for key in DETAIL_KEYS
        )
    )
    add_dimension_rows(spark, layout, "derivative_detail", details, DETAIL_KEYS)

    keys = subject.staging_keys
    detail = warehouse_table(spark, layout, "derivative_detail")
    contracts = contract_ids(derivative, detail, subject.derivative_type, keys)
    facts = detail_facts(staged, contracts, keys)
    _write_facts(
        spark,
        facts,
        staged,
        layout,
        "derivative_detail_history",
        DETAIL_HISTORY,
        "derivative_detail_id",
    )


def load_subject(
    spark: SparkSession, layout: Layout, subject: str, staged: DataFrame
) -> None:
    """Load conforming bars of whole days; they carry ``subject`` and ``ds``."""
    if subject == "index":
        load_index(spark, layout, staged)
    else:
        load_derivatives(spark, layout, SUBJECTS[subject], staged)


def _ensure_index(spark: SparkSession, layout: Layout) -> None:
    seed = spark.createDataFrame([(INDEX_NAME, INDEX_MARKET)], "name string, market string")
    add_dimension_rows(spark, layout, "index", seed, ("name", "market"))


def _write_facts(
    spark: SparkSession,
    facts: DataFrame,
    staged: DataFrame,
    layout: Layout,
    name: str,
    schema: T.StructType,
    key: str,
) -> None:
    """Facts and their zone map; ``staged`` has the same days and times."""
    record_zones(spark, layout, name, staged, widen=True)
    rows = conform(facts, schema)
    write_partitions(rows, layout.warehouse(name), FACT_PARTITIONS, ("scale", "datetime", key))
    record_zones(spark, layout, name, staged)


def candles_of_index(
    spark: SparkSession, layout: Layout, name: str, scale: int, start: str, end: str
) -> DataFrame:
    return index_candles(
        warehouse_table(spark, layout, "index"),
        warehouse_table(spark, layout, "index_history"),
        name,
        scale,
        start,
        end,
        zone_map(spark, layout, "index_history"),
    )


def candles_of_contract(
    spark: SparkSession,
    layout: Layout,
    name: str,
    expire_code: str,
    scale: int,
    start: str,
    end: str,
) -> DataFrame:
    return contract_candles(
        warehouse_table(spark, layout, "derivative"),
        warehouse_table(spark, layout, "derivative_detail"),
        warehouse_table(spark, layout, "derivative_detail_history"),
        name,
        expire_code,
        scale,
        start,
        end,
        zone_map(spark, layout, "derivative_detail_history"),
    )
