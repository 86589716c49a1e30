"""Every registered query against its SQL, and the plans it must have."""

from __future__ import annotations

import os

import pytest
from oracle import compare, connect

import __spark_entry__ as entry_module

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = entry_module.QUERIES, entry_module.ORACLES


@pytest.fixture(scope="module")
def duck():
    con = connect(SF_DIR)
    yield con
    con.close()


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    difference = compare(df, duck, ORACLES[name])
    assert difference is None, difference


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_stays_on_the_jvm(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    for word in ("EvalPython", "MapInPandas", "MapInArrow", "CartesianProduct", "NestedLoop"):
        assert word not in plan, word


@pytest.mark.parametrize(
    "name", [n for n in sorted(QUERIES) if n.startswith(("bars_", "first_", "topn"))]
)
def test_bars_hash_aggregate_without_window(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    assert "HashAggregate" in plan
    for word in ("Window", "SortAggregate", "ObjectHashAggregate"):
        assert word not in plan, word


def test_ticks_are_shuffled_as_partial_states(spark):
    """Before the first exchange there is a partial aggregate, and ticks are not expanded."""
    plan = plan_of(QUERIES["bars_all_scales"](spark, SF_DIR))
    assert plan.count("Exchange hashpartitioning") == 2
    below_first_exchange = plan.split("Exchange hashpartitioning")[-1]
    assert "partial_min_by" in below_first_exchange
    assert "Generate" not in below_first_exchange


def test_scan_reads_only_what_is_needed(spark):
    plan = plan_of(QUERIES["bars_index_no_key"](spark, SF_DIR))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,value:double>" in plan
    assert "PushedFilters: [IsNotNull(ts)" in plan


@pytest.mark.parametrize(
    "name", ["spread_unpack", "label_expiry_codes", "roundup_minutes", "contract_filter"]
)
def test_narrow_steps_do_not_shuffle(spark, name):
    assert "Exchange" not in plan_of(QUERIES[name](spark, SF_DIR))


def test_ticks_meet_their_statistics_with_few_exchanges(spark):
    """One scan for the bars, one for the ticks; minutes come from the bars' bitmaps."""
    plan = plan_of(QUERIES["tick_stats_all_scales"](spark, SF_DIR))
    assert plan.count("FileScan") == 2 and plan.count("Exchange hashpartitioning") <= 5
    assert "bit_or" in plan


def test_candles_are_pruned_by_day(spark):
    plan = plan_of(QUERIES["candles_by_zone"](spark, SF_DIR))
    assert "dynamicpruning" in plan and "LeftSemi" in plan


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()
