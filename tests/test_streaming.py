from __future__ import annotations

import datetime as dt

from landing import land_day, land_holidays
from pyspark.sql import functions as F

from barweave.operators.bars import bars
from barweave.plans.layout import Layout
from barweave.plans.warehouse import warehouse_table
from barweave.streaming.catch_up import catch_up
from barweave.streaming.live_bars import live_bars


def test_catch_up_runs_landed_days_once(spark, tmp_path):
    where, checkpoint = Layout(str(tmp_path / "lake")), str(tmp_path / "checkpoint")
    land_day(where.root, "2022_01_20")
    land_holidays(where.root)
    ran = []

    def run(session, layout, days):
        ran.append(days)

    catch_up(spark, where, checkpoint, run=run).awaitTermination()
    catch_up(spark, where, checkpoint, run=run).awaitTermination()
    assert ran == [["2022_01_20"]]
    land_day(where.root, "2022_01_24")
    land_day(where.root, "2022_01_21")
    catch_up(spark, where, checkpoint, run=run).awaitTermination()
    assert ran == [["2022_01_20"], ["2022_01_21", "2022_01_24"]]


def test_catch_up_fills_the_warehouse(spark, tmp_path):
    where = Layout(str(tmp_path / "lake"))
    land_day(where.root, "2022_01_20")
    land_holidays(where.root)
    query = catch_up(spark, where, str(tmp_path / "c"), subjects=["futures", "index"])
    query.awaitTermination()
    assert query.exception() is None
    assert warehouse_table(spark, where, "index_history").count() > 0
    assert warehouse_table(spark, where, "derivative_detail_history").count() > 0


def test_live_bars_equal_batch_bars_once_closed(spark, tmp_path):
    start = dt.datetime(2022, 1, 20, 1, 0)
    rows = [
        ("TX", start + dt.timedelta(seconds=s), 100 + s % 17, 1 + s % 3, i)
        for i, s in enumerate([0, 0, 60, 61, 119, 120, 121, 299, 300, 301, 600, 900])
    ]
    ticks = spark.createDataFrame(rows, "contract string, ts timestamp, price int, volume int, seq bigint")
    ticks = ticks.withColumn("price", F.col("price").cast("decimal(10,2)"))
    path = str(tmp_path / "ticks")
    ticks.write.parquet(path)
    stream = spark.readStream.schema(ticks.schema).parquet(path)
    live = live_bars(stream, ["contract"], 5, "1 minute")
    query = (
        live.writeStream.format("parquet")
        .option("path", str(tmp_path / "bars"))
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    found = spark.read.schema(live.schema).parquet(str(tmp_path / "bars"))
    closed = bars(ticks, ["contract"], [5]).where(F.col("datetime") < "2022-01-20 01:14:00")
    key = ["contract", "scale", "datetime", "price_open", "price_high", "price_low", "price_close", "price_mean", "volume"]
    assert sorted(map(tuple, found.select(*key).collect())) == sorted(
        map(tuple, closed.select(*key).collect())
    )
    assert found.count() == 3
