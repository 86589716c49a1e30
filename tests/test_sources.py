from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from landing import DAY, crlf, land_day, land_holidays, put, zipped
from pyspark.sql import functions as F

from barweave.operators.normalize import (
    normalize_etf,
    normalize_futures,
    normalize_index,
    normalize_options,
)
from barweave.schemas import BARS, TICKS
from barweave.sources import landed
from barweave.sources.tables import conform, read_days, read_table, write_partitions


def at(*args):
    return dt.datetime(2022, 1, 20, *args)


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    path = str(tmp_path_factory.mktemp("landing"))
    land_day(path)
    land_day(path, "2022_01_21")
    land_holidays(path)
    return path


def ticks(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_futures_ticks(spark, root):
    found = normalize_futures(landed.read_futures(spark, f"{root}/raw/futures", [DAY]))
    assert ticks(found, "contract", "expire", "ts", "price", "volume") == sorted(
        [
            ("TX", "202202", at(0, 45, 0), Decimal("18210.00"), 3),
            ("TX", "202202", at(0, 45, 0), Decimal("18212.00"), 1),
            ("TX", "202202", at(0, 45, 1), Decimal("18208.50"), 2),
            ("MTX", "202201W4", at(0, 46, 59), Decimal("18209.00"), 5),
            ("MTX", "209912", at(0, 46, 59), Decimal("18209.00"), 5),
            ("TX", "202202", at(1, 0, 1), Decimal("18200.00"), 2),
            ("TX", "202203", at(1, 0, 1), Decimal("18180.00"), 2),
            ("MTX", "202201W4", at(1, 0, 1), Decimal("18201.00"), 1),
            ("MTX", "202202", at(1, 0, 1), Decimal("18196.00"), 1),
            ("TX", "202202", at(1, 0, 2), Decimal("18200.00"), 1),
        ]
    )
    assert {r.ds for r in found.select("ds").collect()} == {dt.date(2022, 1, 20)}


def test_order_of_records(spark, root):
    """Outright records come before spreads, each in line order."""
    raw = landed.read_futures(spark, f"{root}/raw/futures", [DAY]).orderBy("seq").collect()
    names = [r.source_file.rsplit("/", 1)[1] for r in raw]
    assert names == [f"Daily_{DAY}.zip"] * 7 + [f"Daily_{DAY}_C.zip"] * 3
    assert [r.line_no for r in raw] == [1, 2, 3, 4, 5, 6, 7, 1, 2, 3]
    assert len({r.seq for r in raw}) == 10 and max(r.seq for r in raw) < 2**53


def test_all_days_without_glob(spark, root):
    assert landed.read_options(spark, f"{root}/raw/options").select("ds").distinct().count() == 2
    two = landed.read_options(spark, f"{root}/raw/options", [DAY, "2022_01_21"])
    assert two.count() == 10


def test_options_ticks(spark, root):
    found = normalize_options(landed.read_options(spark, f"{root}/raw/options", [DAY]))
    assert ticks(found, "contract", "expire", "strike_price", "option_type", "ts", "price") == [
        ("TXO", "202201W4", "17900", "C", at(0, 45, 30), Decimal("60.00")),
        ("TXO", "202202", "17800", "C", at(0, 45), Decimal("120.50")),
        ("TXO", "202202", "17800", "C", at(0, 45, 30), Decimal("121.00")),
        ("TXO", "202202", "17800", "P", at(0, 45, 30), Decimal("80.00")),
    ]


def test_index_ticks(spark, root):
    found = normalize_index(landed.read_index(spark, f"{root}/raw/index", [DAY]))
    assert ticks(found, "contract", "ts", "price") == [
        ("TAIEX", at(1, 0, 0), Decimal("18210.35")),
        ("TAIEX", at(1, 0, 5), Decimal("18211.00")),
        ("TAIEX", at(1, 4, 59), Decimal("18200.10")),
    ]
    assert found.where(F.col("volume").isNotNull()).count() == 0


def test_index_line_slice(spark, root):
    assert landed.read_index(spark, f"{root}/raw/index", [DAY], stop=4).count() == 2


def test_etf_ticks(spark, root):
    found = normalize_etf(landed.read_etf(spark, f"{root}/raw/etf", [DAY]))
    assert ticks(found, "contract", "ts", "price", "volume") == [
        ("006204", at(1, 0, 3), Decimal("101.25"), 4),
        ("006204", at(1, 0, 3), Decimal("101.50"), 1),
        ("006204", at(1, 20), Decimal("101.00"), 2),
    ]
    assert [r.seq % 2**34 for r in found.orderBy("seq").collect()] == [0, 1, 2]


def test_holidays_in_big5(spark, root):
    rows = landed.read_holidays(spark, f"{root}/raw/holidays").collect()
    assert [(r.date, r.description, r.year) for r in rows] == [
        ("2月1日", "休市, 放假", 2022),
        ("1月22日", "補行交易", 2022),
        ("1月1日", "依規定放假", 2022),
    ]


def test_members_and_batches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(landed, "BATCH_LINES", 3)
    first = crlf(*(f"a{i}" for i in range(7)))
    put(f"{tmp_path}/x.zip", zipped(one=first, two=crlf("b0", "b1"), none=""))
    rows = landed.read_lines(spark, str(tmp_path), "*.zip", zipped=True).orderBy("row_no").collect()
    assert [r.line for r in rows] == [f"a{i}" for i in range(7)] + ["b0", "b1"]
    assert [r.row_no for r in rows] == list(range(9))
    assert [r.line_no for r in rows] == [*range(7), 0, 1]


def test_undecodable_bytes_do_not_lose_the_line(spark, tmp_path):
    put(f"{tmp_path}/x.csv", b"ok\r\nbad \xff\xfe byte\r\n")
    rows = landed.read_lines(spark, str(tmp_path)).orderBy("line_no").collect()
    assert rows[0].line == "ok" and rows[1].line.startswith("bad ")


def test_partitions_are_replaced_one_by_one(spark, tmp_path):
    path = str(tmp_path / "t")

    def put_rows(*rows):
        df = spark.createDataFrame(rows, "subject string, ds date, x int")
        write_partitions(df, path, ("subject", "ds"), ("x",))

    d1, d2 = dt.date(2022, 1, 20), dt.date(2022, 1, 21)
    put_rows(("a", d1, 1), ("a", d2, 2), ("b", d1, 3))
    put_rows(("a", d1, 10), ("a", d1, 11))
    schema = spark.read.parquet(path).schema
    found = read_table(spark, path, schema).select("subject", "ds", "x")
    assert sorted(map(tuple, found.collect())) == [
        ("a", d1, 10),
        ("a", d1, 11),
        ("a", d2, 2),
        ("b", d1, 3),
    ]
    pruned = read_days(spark, path, schema, "a", "2022-01-21")
    assert [r.x for r in pruned.collect()] == [2]
    plan = pruned._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(subject" in plan


def test_missing_table_is_empty(spark, tmp_path):
    assert read_table(spark, str(tmp_path / "none"), BARS).count() == 0


def test_conform(spark):
    df = spark.sql("select 1 as b, 'x' as a, 2 as extra")
    shaped = conform(df, spark.sql("select 'x' as a, 1 as b").schema)
    assert shaped.columns == ["a", "b"]
    with pytest.raises(ValueError, match="missing"):
        conform(df, TICKS)


def test_conform_refuses_nulls_and_lossy_types(spark):
    wanted = spark.range(1).schema
    assert conform(spark.sql("select cast(1 as int) as id"), wanted).first().id == 1
    holed = spark.sql("select cast(x as bigint) as id from values (1), (null) t(x)")
    with pytest.raises(Exception, match="null in column id"):
        conform(holed, wanted).collect()
    with pytest.raises(Exception, match="INVALID_COLUMN_OR_FIELD_DATA_TYPE"):
        conform(spark.sql("select 'x' as id"), wanted).collect()
