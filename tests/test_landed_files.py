"""The manifest of landed files, and runs of the days whose files have changed."""

from __future__ import annotations

import os

import pytest
from landing import DAY, crlf, land_day, land_holidays, put

from barweave.operators.quality import DataQualityError
from barweave.plans.landed_files import manifest, run_changed, touched_files
from barweave.plans.layout import Layout
from barweave.plans.warehouse import warehouse_table

OTHER = "2022_01_21"


def index_file(price: str) -> bytes:
    return crlf('"title"', '"time","TAIEX"', f'"09:00:00","{price}"').encode()


@pytest.fixture
def layout(tmp_path):
    where = Layout(str(tmp_path / "lake"))
    land_holidays(where.root)
    for day in (DAY, OTHER):
        put(f"{where.root}/raw/index/index_{day}.csv", index_file("100.00"))
    return where


def later(path: str, seconds: int) -> None:
    at = os.stat(path).st_mtime + seconds
    os.utime(path, (at, at))


def test_a_replaced_file_runs_its_day_again(spark, layout):
    assert run_changed(spark, layout, ["index"]) == [DAY, OTHER]
    assert run_changed(spark, layout, ["index"]) == []
    path = f"{layout.root}/raw/index/index_{OTHER}.csv"
    put(path, index_file("123.00"))
    later(path, 5)
    assert run_changed(spark, layout, ["index"]) == [OTHER]
    facts = warehouse_table(spark, layout, "index_history").where("scale = 1")
    closes = {str(r.ds): float(r.price_close) for r in facts.collect()}
    assert closes == {"2022-01-20": 100.0, "2022-01-21": 123.0}
    assert run_changed(spark, layout, ["index"]) == []
    assert manifest(spark, layout).count() == 2


def test_same_content_at_a_new_time_is_not_run(spark, layout):
    ran = []
    run = lambda session, where, days: ran.append(days)
    run_changed(spark, layout, ["index"], run=run)
    later(f"{layout.root}/raw/index/index_{DAY}.csv", 60)
    touched = touched_files(spark, layout, ["index"]).collect()
    assert [(str(r.ds), r.changed) for r in touched] == [("2022-01-20", False)]
    assert run_changed(spark, layout, ["index"], run=run) == []
    # The new time is known now, and the file need not be read again.
    assert touched_files(spark, layout, ["index"]).count() == 0
    os.remove(f"{layout.root}/raw/index/index_{DAY}.csv")
    assert run_changed(spark, layout, ["index"], run=run) == []
    assert ran == [[DAY, OTHER]]


def test_a_failed_run_is_not_recorded(spark, layout):
    def failing(session, where, days):
        raise DataQualityError("no")

    with pytest.raises(DataQualityError):
        run_changed(spark, layout, ["index"], run=failing)
    assert manifest(spark, layout).count() == 0
    assert run_changed(spark, layout, ["index"], run=lambda *_: None) == [DAY, OTHER]


def test_absent_folders_and_names_without_a_day(spark, tmp_path):
    where = Layout(str(tmp_path))
    assert run_changed(spark, where, run=lambda *_: None) == []
    land_day(where.root)
    put(f"{where.root}/raw/index/notes.csv", b"")
    assert run_changed(spark, where, run=lambda *_: None) == [DAY]
    assert manifest(spark, where).count() == 5
