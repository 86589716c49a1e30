from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from landing import DAY, FUTURES_HEADER, crlf, land_day, land_futures, land_holidays, put, zipped
from pyspark.sql import functions as F

from barweave.operators.quality import DataQualityError, duplicate_keys, orphans, rejected_ticks
from barweave.plans.daily import open_days, run_day, run_days
from barweave.plans.layout import Layout
from barweave.plans.warehouse import (
    TABLES,
    candles_of_contract,
    candles_of_index,
    register_views,
    warehouse_table,
)
from barweave.schemas import BARS, TICKS
from barweave.sources.tables import read_table

ISO = DAY.replace("_", "-")


def snapshot(spark, layout):
    return {
        name: sorted(map(repr, warehouse_table(spark, layout, name).collect())) for name in TABLES
    }


@pytest.fixture(scope="module")
def layout(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("day"))
    land_day(root)
    land_holidays(root)
    where = Layout(root)
    assert run_day(spark, where, ISO) == [DAY]
    return where


def test_dimensions(spark, layout):
    def rows(name, *columns):
        return sorted(map(tuple, warehouse_table(spark, layout, name).select(*columns).collect()))

    assert rows("index", "id", "name", "market") == [(0, "TAIEX", "TW")]
    assert rows("derivative", "id", "index_id", "name", "derivative_type") == [
        (0, 0, "006204", "ETF"),
        (1, 0, "MTX", "Futures"),
        (2, 0, "TX", "Futures"),
        (3, 0, "TXO", "Options"),
    ]
    details = warehouse_table(spark, layout, "derivative_detail").orderBy("id").collect()
    assert [r.id for r in details] == list(range(len(details)))
    assert tuple(details[0])[1:] == (0, None, None, None, None)
    assert {tuple(r)[1:4] for r in details if r.derivative_id == 1} == {
        (1, "202201W4", "W"),
        (1, "202202", "M"),
    }
    assert {tuple(r)[1:] for r in details if r.derivative_id == 3} == {
        (3, "202202", "M", "17800", "C"),
        (3, "202202", "M", "17800", "P"),
        (3, "202201W4", "W", "17900", "C"),
    }


def test_keys_hold(spark, layout):
    history = warehouse_table(spark, layout, "derivative_detail_history")
    assert duplicate_keys(history, ["derivative_detail_id", "scale", "datetime"]).count() == 0
    detail = warehouse_table(spark, layout, "derivative_detail")
    assert orphans(history, detail, "derivative_detail_id", "id").count() == 0
    assert warehouse_table(spark, layout, "index_history").count() > 0


def test_candles(spark, layout):
    candles = candles_of_contract(spark, layout, "TX", "M", 15, "2022-01-20", "2022-01-21").collect()
    first = candles[0].asDict()
    assert first == {
        "datetime": dt.datetime(2022, 1, 20, 0, 45),
        "open": 18210.0,
        "high": 18212.0,
        "low": 18210.0,
        "close": 18212.0,
        "volume": 4,
    }
    assert [r.datetime for r in candles] == sorted(r.datetime for r in candles)
    # Two spread legs at 01:00:01 and 01:00:02 fall in the bar that ends at 01:15.
    assert candles[-1].asDict()["volume"] == 3
    index = candles_of_index(spark, layout, "TAIEX", 5, "2022-01-20", "2022-01-21").collect()
    assert [tuple(r) for r in index] == [
        (dt.datetime(2022, 1, 20, 1, 0), 18210.35, 18210.35, 18210.35, 18210.35),
        (dt.datetime(2022, 1, 20, 1, 5), 18211.0, 18211.0, 18200.1, 18200.1),
    ]


def test_candles_as_sql_text(spark, layout):
    register_views(spark, layout)
    rows = spark.sql(
        """with front_month as (
          select id from derivative_detail where expire_code = 'M' and derivative_id in
            (select id from derivative where name = 'TX'))
        select datetime, price_open, volume from derivative_detail_history
        where scale = 15 and date(datetime) = date '2022-01-20'
          and derivative_detail_id in (select id from front_month)
        order by 1"""
    ).collect()
    assert rows[0].price_open == Decimal("18210.00") and rows[0].volume == 4


def test_candle_scan_is_pruned(spark, layout):
    candles = candles_of_contract(spark, layout, "TX", "M", 15, "2022-01-20", "2022-01-21")
    plan = candles._jdf.queryExecution().toString()
    assert "EqualTo(scale,15)" in plan and "GreaterThanOrEqual(datetime" in plan and "BroadcastHashJoin" in plan
    scan = [line for line in plan.splitlines() if "FileScan" in line and "price_open" in line]
    assert scan and all("price_mean" not in line for line in scan)


def test_running_again_changes_nothing(spark, layout):
    before = snapshot(spark, layout)
    run_day(spark, layout, ISO, subjects=["etf", "options", "index"])
    assert snapshot(spark, layout) == before


def test_range_is_the_same_as_its_days(spark, tmp_path):
    single, ranged = Layout(str(tmp_path / "a")), Layout(str(tmp_path / "b"))
    days = ["2022_01_20", "2022_01_21", "2022_01_22"]
    for where in (single, ranged):
        land_holidays(where.root)
        for day in days:
            land_day(where.root, day)
    some = ["futures", "index"]
    for day in days:
        run_day(spark, single, day.replace("_", "-"), subjects=some)
    assert run_days(spark, ranged, "2022-01-20", "2022-01-23", subjects=some) == days
    one = read_table(spark, single.bars, BARS)
    many = read_table(spark, ranged.bars, BARS)
    assert one.exceptAll(many).count() == 0 and many.exceptAll(one).count() == 0
    assert snapshot(spark, single)["index_history"] == snapshot(spark, ranged)["index_history"]


def test_closed_days_are_skipped(spark, layout):
    assert open_days(spark, layout, "2022-01-28", "2022-02-02") == [
        "2022_01_28",
        "2022_01_31",
        "2022_02_02",
    ]
    assert run_day(spark, layout, "2022-02-01") == []


def test_gate_holds_back_bad_days_only(spark, tmp_path):
    where = Layout(str(tmp_path))
    land_holidays(where.root)
    land_futures(where.root, "2022_01_20")
    bad = crlf(FUTURES_HEADER, "20220121,TX     ,202202     ,084500,18210,x,-,-,*")
    put(f"{where.root}/raw/futures/Daily_2022_01_21.zip", zipped(trades=bad))
    with pytest.raises(DataQualityError, match="2022_01_21") as error:
        run_days(spark, where, "2022-01-20", "2022-01-24", subjects=["futures"])
    assert "2022_01_24" in str(error.value) and "2022_01_20" not in str(error.value)
    history = warehouse_table(spark, where, "derivative_detail_history")
    assert {r.ds for r in history.select("ds").collect()} == {dt.date(2022, 1, 20)}
    rejected = rejected_ticks(read_table(spark, where.ticks, TICKS)).where("null_volume > 0")
    assert [(str(r.ds), r.null_volume) for r in rejected.collect()] == [("2022-01-21", 1)]


def test_expiry_with_two_codes_is_not_counted_twice(spark, tmp_path):
    """In the week of the third Wednesday an expiry is weekly and monthly at once."""
    where = Layout(str(tmp_path))
    land_holidays(where.root)
    lines = crlf(
        FUTURES_HEADER,
        "20220118,TX     ,202201     ,084501,18210,3,-,-,*",
        "20220118,TX     ,202201     ,084502,18211,4,-,-,*",
    )
    put(f"{where.root}/raw/futures/Daily_2022_01_18.zip", zipped(trades=lines))
    run_day(spark, where, "2022-01-18", subjects=["futures"])
    bars = read_table(spark, where.bars, BARS).where("scale = 60")
    found = {r.expire_code: r.volume for r in bars.collect()}
    assert found == {"W": 7, "M": 7}


def test_submit_script_runs_single_steps(spark, tmp_path, capsys):
    import run_days as script

    where = Layout(str(tmp_path))
    land_day(where.root)
    land_holidays(where.root)
    for step in ("ingest", "aggregate", "load"):
        script.main([where.root, ISO, "--step", step, "--subject", "index"])
    assert warehouse_table(spark, where, "index_history").count() == 11
    script.main([where.root, "2022-02-01"])
    assert "0 trading days" in capsys.readouterr().out


def test_a_cut_archive_is_an_error_and_leaves_no_old_rows(spark, tmp_path):
    where = Layout(str(tmp_path))
    land_holidays(where.root)
    land_day(where.root)
    assert run_day(spark, where, ISO, subjects=["futures", "index"]) == [DAY]
    for name in (f"Daily_{DAY}.zip", f"Daily_{DAY}_C.zip"):
        path = f"{where.root}/raw/futures/{name}"
        with open(path, "rb") as file:
            content = file.read()
        put(path, content[: len(content) // 2])
    with pytest.raises(DataQualityError, match="futures"):
        run_day(spark, where, ISO, subjects=["futures", "index"])
    assert warehouse_table(spark, where, "derivative_detail_history").count() == 0
    assert read_table(spark, where.ticks, TICKS).where("subject = 'futures'").count() == 0
    assert warehouse_table(spark, where, "index_history").count() > 0


def test_an_absent_folder_does_not_stop_others(spark, tmp_path):
    where = Layout(str(tmp_path))
    land_holidays(where.root)
    land_day(where.root)
    import shutil

    shutil.move(f"{where.root}/raw/etf", f"{where.root}/elsewhere")
    with pytest.raises(DataQualityError, match="etf"):
        run_day(spark, where, ISO, subjects=["etf", "index"])
    assert warehouse_table(spark, where, "index_history").count() > 0


def test_archives_of_one_kind_and_day_have_unique_seq(spark, tmp_path):
    root = str(tmp_path)
    lines = crlf(FUTURES_HEADER, "20220120,TX     ,202202     ,084500,18210,3,-,-,*")
    for n in range(3):
        put(f"{root}/raw/futures/Part{n}_Daily_{DAY}.zip", zipped(trades=lines))
    from barweave.sources.landed import read_futures

    found = [r.seq for r in read_futures(spark, f"{root}/raw/futures", [DAY]).collect()]
    assert len(found) == len(set(found)) == 3
