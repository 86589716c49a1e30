"""Zone maps: days that a candle query reads, and rows that lie days away from their archive."""

from __future__ import annotations

import datetime as dt

import pytest
from landing import DAY, FUTURES_HEADER, crlf, land_day, land_holidays, put, zipped
from pyspark.sql import functions as F

from barweave.operators.candles import in_range
from barweave.operators.quality import DataQualityError
from barweave.operators.zones import merged_zones
from barweave.plans.daily import run_day, run_days
from barweave.plans.layout import Layout
from barweave.plans.warehouse import (
    candles_of_contract,
    candles_of_index,
    rebuild_zones,
    register_views,
    warehouse_table,
    zone_map,
)
from barweave.schemas import ZONES

DAYS = ["2022_01_18", "2022_01_19", "2022_01_20", "2022_01_21", "2022_01_22", "2022_01_24", "2022_01_25"]
HISTORY = "derivative_detail_history"


def files_read(df) -> int:
    """Files that the scan of the facts opened; ``df`` must not have run before."""
    df.collect()
    plans = [df._jdf.queryExecution().executedPlan()]
    while plans:
        plan = plans.pop()
        name = plan.nodeName()
        if name == "AdaptiveSparkPlan":
            plans.append(plan.finalPhysicalPlan())
        elif "QueryStage" in name:
            plans.append(plan.plan())
        elif name.startswith("Scan parquet") and "price_open" in plan.toString():
            return plan.metrics().apply("numFiles").value()
        else:
            plans += [plan.children().apply(i) for i in range(plan.children().size())]
    raise AssertionError("no scan of facts")


@pytest.fixture(scope="module")
def layout(spark, tmp_path_factory):
    where = Layout(str(tmp_path_factory.mktemp("zones")))
    land_holidays(where.root)
    for day in DAYS:
        land_day(where.root, day)
    # The archive of the 25th also holds a trade of the 18th.
    late = crlf(FUTURES_HEADER, "20220118,TX     ,202202     ,100000,18300,7,-,-,*")
    put(f"{where.root}/raw/futures/Late_Daily_2022_01_25.zip", zipped(trades=late))
    assert run_days(spark, where, "2022-01-18", "2022-01-25", subjects=["futures", "index"]) == DAYS
    return where


def test_only_days_with_such_times_are_read(spark, layout):
    history, zones = warehouse_table(spark, layout, HISTORY), zone_map(spark, layout, HISTORY)
    asked = (15, "2022-01-20", "2022-01-21")
    plain, pruned = in_range(history, *asked), in_range(history, *asked, zones)
    assert sorted(map(str, plain.collect())) == sorted(map(str, pruned.collect()))
    assert "dynamicpruning" in pruned._jdf.queryExecution().executedPlan().toString()
    all_files = files_read(in_range(history, *asked))
    assert 0 < files_read(in_range(history, *asked, zones)) * 2 < all_files >= len(DAYS)
    assert {str(r.ds) for r in pruned.select("ds").collect()} == {"2022-01-20"}


def test_a_row_days_away_from_its_archive_is_found(spark, layout):
    found = candles_of_contract(spark, layout, "TX", "M", 15, "2022-01-18", "2022-01-19").collect()
    assert {r.volume for r in found if r.datetime == dt.datetime(2022, 1, 18, 2, 0)} == {7}
    zones = {str(r.ds): r for r in zone_map(spark, layout, HISTORY).collect()}
    assert zones["2022-01-25"]["first"] == dt.datetime(2022, 1, 18, 2, 0)


def test_sql_text_is_pruned_too(spark, layout):
    register_views(spark, layout)
    text = f"select * from {HISTORY}_between(15, timestamp '2022-01-20', timestamp '2022-01-21')"
    rows = spark.sql(text)
    expected = in_range(warehouse_table(spark, layout, HISTORY), 15, "2022-01-20", "2022-01-21")
    assert sorted(map(str, rows.collect())) == sorted(map(str, expected.select(*rows.columns).collect()))
    assert "dynamicpruning" in rows._jdf.queryExecution().executedPlan().toString()
    all_files = files_read(in_range(warehouse_table(spark, layout, HISTORY), 15, "2022-01-20", "2022-01-21"))
    assert 0 < files_read(spark.sql(text)) * 2 < all_files
    index = spark.sql(
        "select price_close from index_history_between(5, timestamp '2022-01-20', timestamp '2022-01-21')"
    )
    assert index.count() == candles_of_index(spark, layout, "TAIEX", 5, "2022-01-20", "2022-01-21").count()


def test_without_a_zone_map_nothing_is_lost(spark, tmp_path):
    where = Layout(str(tmp_path))
    land_holidays(where.root)
    land_day(where.root)
    run_day(spark, where, DAY.replace("_", "-"), subjects=["index"])
    wanted = ("TAIEX", 5, "2022-01-20", "2022-01-21")
    with_map = candles_of_index(spark, where, *wanted).collect()
    bare = Layout(f"{where.root}/copy")
    for name in ("index", "index_history"):
        table = warehouse_table(spark, where, name)
        keys = ["subject", "ds"] if "ds" in table.columns else []
        table.write.partitionBy(*keys).parquet(bare.warehouse(name))
    assert zone_map(spark, bare, "index_history") is None
    assert candles_of_index(spark, bare, *wanted).collect() == with_map and with_map
    rebuild_zones(spark, bare, "index_history")
    assert zone_map(spark, bare, "index_history").count() == 1
    assert candles_of_index(spark, bare, *wanted).collect() == with_map


def test_zones_widen_and_are_replaced(spark):
    def zone(day, first, last):
        hours = (dt.datetime(2022, 1, day, h) if h is not None else None for h in (first, last))
        return ("futures", 2022, dt.date(2022, 1, day), *hours)

    known = spark.createDataFrame([zone(3, 1, 9), zone(4, 1, 9)], ZONES)
    fresh = spark.createDataFrame([zone(4, 5, 12), zone(5, None, None)], ZONES).drop("year")

    def spans(widen):
        rows = merged_zones(known, fresh, widen).collect()
        return {r.ds.day: tuple(t and t.hour for t in (r["first"], r["last"])) for r in rows}

    assert spans(True) == {3: (1, 9), 4: (1, 12), 5: (None, None)}
    assert spans(False) == {3: (1, 9), 4: (5, 12), 5: (None, None)}
    assert merged_zones(known, fresh.limit(0), False).count() == 0


def test_counts_of_a_run(spark, tmp_path):
    """Read, left out by cause and written, in what the run returns and in what it raises."""
    where = Layout(str(tmp_path))
    land_holidays(where.root)
    land_day(where.root)
    counts = run_day(spark, where, DAY.replace("_", "-")).counts
    assert counts["futures"] == {
        **dict(read=10, other_contract=1, legs_without_price=2),
        **dict(written=10, no_ts=0, no_price=0, no_volume=0),
    }
    assert counts["options"] == {
        **dict(read=5, other_contract=1, written=4),
        **dict(no_ts=0, no_price=0, no_volume=0),
    }
    assert counts["index"]["read"] == 4 and counts["index"]["no_clock_time"] == 1
    assert counts["index"]["written"] == 3 and counts["index"]["no_volume"] == 3
    assert counts["etf"]["read"] == counts["etf"]["written"] == 3
    bad = crlf(FUTURES_HEADER, "20220121,TX     ,202202     ,084500,18210,x,-,-,*")
    put(f"{where.root}/raw/futures/Daily_2022_01_21.zip", zipped(trades=bad))
    with pytest.raises(DataQualityError, match="'no_volume': 1"):
        run_days(spark, where, "2022-01-21", "2022-01-21", subjects=["futures"])
    # Where no tick is left, the counts are still there.
    other = crlf(FUTURES_HEADER, "20220124,ZZZ    ,202202     ,084500,18210,1,-,-,*")
    put(f"{where.root}/raw/futures/Daily_2022_01_24.zip", zipped(trades=other))
    with pytest.raises(DataQualityError, match="'read': 1, 'other_contract': 1"):
        run_days(spark, where, "2022-01-24", "2022-01-24", subjects=["futures"])


def test_counting_adds_no_pass(spark, tmp_path):
    where = Layout(str(tmp_path))
    land_holidays(where.root)
    land_day(where.root)
    from barweave.operators.quality import Counts

    counts = Counts()
    rows = counts.on(spark.range(10), read=F.count(F.lit(1)), even=F.count_if(F.col("id") % 2 == 0))
    rows.where("id < 3").write.parquet(f"{tmp_path}/out")
    assert counts.values() == {"read": 10, "even": 5}
