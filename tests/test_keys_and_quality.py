from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from barweave.operators.keys import absent_rows, new_dimension_rows, number_rows
from barweave.operators.lookups import detail_facts, with_single_id
from barweave.operators.quality import (
    DataQualityError,
    duplicate_keys,
    null_counts,
    null_flags,
    orphans,
    require_complete,
)
from barweave.schemas import DETAIL_DIM, DETAIL_KEYS

DETAIL = "derivative_id int, expire string, expire_code string, strike_price string, option_type string"


def test_ids_are_dense_and_in_key_order(spark):
    n = 5000
    rows = spark.range(n).select(
        F.lpad(F.pmod(F.col("id") * 7919, F.lit(n)).cast("string"), 5, "0").alias("name")
    )
    numbered = number_rows(rows.repartition(13), ["name"], F.lit(40)).orderBy("name").collect()
    assert [r.id for r in numbered] == list(range(40, 40 + n))


def test_first_id_is_zero_and_rerun_adds_nothing(spark):
    details = spark.createDataFrame(
        [(0, None, None, None, None), (1, "202202", "M", None, None), (1, "202202", "W", None, None)]
        * 2,
        DETAIL,
    )
    dim = spark.createDataFrame([], DETAIL_DIM)
    first = new_dimension_rows(dim, details, DETAIL_KEYS)
    assert sorted(r.id for r in first.collect()) == [0, 1, 2]
    dim = dim.unionByName(first)
    assert new_dimension_rows(dim, details, DETAIL_KEYS).count() == 0
    more = details.unionByName(spark.createDataFrame([(0, None, "M", None, None)], DETAIL))
    added = new_dimension_rows(dim, more, DETAIL_KEYS).collect()
    assert [(r.id, r.derivative_id, r.expire_code) for r in added] == [(3, 0, "M")]


def test_plain_equality_would_insert_again(spark):
    """Why the match is null-safe."""
    a = spark.createDataFrame([(0, None)], "k int, e string")
    assert absent_rows(a, a, ["k", "e"]).count() == 0
    assert a.join(a.select("k", "e"), ["k", "e"], "left_anti").count() == 1


def test_single_id(spark):
    dim = spark.createDataFrame([(7, "TAIEX", "TW"), (8, "X", "TW")], "id int, name string, market string")
    rows = spark.range(3)
    with_id = with_single_id(rows, dim, "index_id", name="TAIEX", market="TW")
    assert [tuple(r) for r in with_id.collect()] == [(7, 0), (7, 1), (7, 2)]
    assert with_single_id(rows, dim, "index_id", name="none").count() == 0
    assert "Join" not in with_id._jdf.queryExecution().executedPlan().toString()



def test_detail_facts_drop_unknown_contracts(spark):
    bars = spark.createDataFrame([("TX", "M", 1), ("??", "M", 2)], "contract string, expire_code string, v int")
    contracts = spark.createDataFrame([(5, "TX", "M")], "derivative_detail_id int, contract string, expire_code string")
    found = detail_facts(bars, contracts, ["contract", "expire_code"]).collect()
    assert [tuple(r) for r in found] == [(5, 1)]


def test_null_checks(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", None, None), ("b", 2, 3)], "g string, x int, y int")
    counts = {r.g: (r.n_rows, r.null_x, r.null_y) for r in null_counts(df, ["x", "y"], ["g"]).collect()}
    assert counts == {"a": (2, 1, 2), "b": (1, 0, 0)}
    flags = {r.g: (r.ok_x, r.ok_y) for r in null_flags(df, ["x", "y"], ["g"]).collect()}
    assert flags == {"a": (False, False), "b": (True, True)}
    require_complete(df, ["g"], "t")
    with pytest.raises(DataQualityError, match="'x': 1"):
        require_complete(df, ["g", "x"], "t")


def test_empty_table_fails_the_gate(spark):
    nothing = spark.createDataFrame([], "x int")
    assert null_flags(nothing, ["x"]).first().ok_x is None
    with pytest.raises(DataQualityError, match="no rows"):
        require_complete(nothing, ["x"], "t")


def test_duplicates_and_orphans(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "a"), (None, "b")], "k int, v string")
    assert [tuple(r) for r in duplicate_keys(df, ["k", "v"]).collect()] == [(1, "a", 2)]
    parent = spark.createDataFrame([(2,)], "id int")
    assert [tuple(r) for r in orphans(df, parent, "k", "id").collect()] == [(1, 2)]
