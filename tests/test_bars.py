from __future__ import annotations

import datetime as dt
import random
import statistics
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from barweave.functions.buckets import floor_second, round_up_minutes
from barweave.operators import bars as bars_module
from barweave.operators.bars import bars
from barweave.operators.tick_stats import first_ticks, tick_bar_stats
from barweave.schemas import SCALES

SCHEMA = "contract string, ts timestamp, price decimal(10,2), volume int, seq bigint"
EPOCH = dt.datetime(1970, 1, 1)


def bar_end(ts: dt.datetime, minutes: int) -> dt.datetime:
    """The plain definition: the smallest multiple that is not before ``ts``."""
    width = dt.timedelta(minutes=minutes)
    whole, rest = divmod(ts - EPOCH, width)
    return EPOCH + width * (whole + (1 if rest else 0))


def brute_force(rows, scales=SCALES):
    groups = {}
    for contract, ts, price, volume, seq in rows:
        for scale in scales:
            groups.setdefault((contract, scale, bar_end(ts, scale)), []).append(
                (ts, seq, price, volume)
            )
    result = {}
    for key, ticks in groups.items():
        ticks.sort()
        prices = [t[2] for t in ticks]
        mean = (sum(prices) / len(prices)).quantize(Decimal("0.000001"), ROUND_HALF_UP)
        deviation = statistics.stdev(prices) if len(prices) > 1 else None
        volume = sum(t[3] for t in ticks)
        result[key] = (prices[0], max(prices), min(prices), prices[-1], mean, deviation, volume)
    return result


def collect(df):
    return {
        (r.contract, r.scale, r.datetime): (
            r.price_open,
            r.price_high,
            r.price_low,
            r.price_close,
            r.price_mean,
            r.price_std,
            r.volume,
        )
        for r in df.collect()
    }


def assert_same(found, expected):
    assert found.keys() == expected.keys()
    for key, want in expected.items():
        have = found[key]
        assert have[:5] == want[:5] and have[6] == want[6], key
        if want[5] is None:
            assert have[5] is None
        else:
            assert have[5] == pytest.approx(float(want[5]), rel=1e-12, abs=1e-12)


def random_ticks(n, seed, low=1, high=50_000, seq_of=lambda i: i):
    """Many ties: whole seconds over an hour and a half, and repeated prices."""
    rng = random.Random(seed)
    start = dt.datetime(2022, 1, 20, 0, 45)
    return [
        (
            rng.choice(["TX", "MTX"]),
            start + dt.timedelta(seconds=rng.randrange(0, 5400, 7)),
            Decimal(rng.randrange(low, high)) / 100,
            rng.randrange(1, 50),
            seq_of(i),
        )
        for i in rng.sample(range(n), n)
    ]


@pytest.mark.parametrize(
    "seq_of",
    [
        lambda i: i,
        lambda i: (i - 1500) << 27,
        lambda i: (i % 3 - 1) * (1 << 40) + i,
    ],
    ids=["one run", "many runs", "far runs"],
)
def test_against_brute_force(spark, seq_of):
    rows = random_ticks(3000, seed=1, seq_of=seq_of)
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    assert_same(collect(bars(df, ["contract"])), brute_force(rows))


def test_deviation_at_index_level(spark):
    rows = random_ticks(4000, seed=2, low=1_800_000, high=1_800_300)
    df = spark.createDataFrame(rows, SCHEMA)
    assert_same(collect(bars(df, ["contract"])), brute_force(rows))


def test_largest_prices(spark):
    rows = random_ticks(500, seed=3, low=10**10 - 5000, high=10**10)
    df = spark.createDataFrame(rows, SCHEMA)
    assert_same(collect(bars(df, ["contract"])), brute_force(rows))


def test_negative_prices(spark):
    rows = random_ticks(500, seed=4, low=-3_000_000, high=-100)
    found = collect(bars(spark.createDataFrame(rows, SCHEMA), ["contract"]))
    assert_same(found, brute_force(rows))


def test_other_scales(spark):
    scales = [7, 90, 1023]
    rows = random_ticks(600, seed=5)
    df = spark.createDataFrame(rows, SCHEMA)
    assert_same(collect(bars(df, ["contract"], scales)), brute_force(rows, scales))
    for bad in ([0], [1024], []):
        with pytest.raises(ValueError):
            bars(df, ["contract"], bad)


def test_result_does_not_depend_on_partitioning(spark):
    df = spark.createDataFrame(random_ticks(3000, seed=6), SCHEMA)
    results = [
        {tuple(r) for r in bars(df.repartition(n), ["contract"]).collect()} for n in (1, 3, 16)
    ]
    assert results[0] == results[1] == results[2]


@pytest.mark.parametrize("scale", SCALES)
@pytest.mark.parametrize(
    "text", ["01:00:00", "01:00:01", "00:59:59.999999", "01:07:00.000001", "00:00:00"]
)
def test_bar_boundaries(spark, scale, text):
    ts = dt.datetime.fromisoformat(f"2022-01-20 {text}")
    df = spark.createDataFrame([(ts,)], "ts timestamp")
    wall = F.col("ts").cast("timestamp_ntz")
    row = df.select(
        round_up_minutes(F.col("ts"), scale).alias("a"), round_up_minutes(wall, scale).alias("b")
    ).first()
    assert row.a == row.b == bar_end(ts, scale)
    assert bar_end(ts, scale) - dt.timedelta(minutes=scale) < ts <= row.a


def test_before_the_epoch(spark):
    df = spark.sql("select timestamp'1969-12-31 23:58:30' as ts")
    found = df.select(round_up_minutes(F.col("ts"), 5)).first()[0]
    assert found == dt.datetime(1970, 1, 1)


def test_floor_second(spark):
    df = spark.sql("select timestamp'2022-01-20 09:00:03.999' as ts")
    assert df.select(floor_second(F.col("ts"))).first()[0] == dt.datetime(2022, 1, 20, 9, 0, 3)


def test_missing_values(spark):
    at = dt.datetime(2022, 1, 20, 1, 0, 30)
    later = at + dt.timedelta(seconds=10)
    rows = [
        ("TX", at, None, 1, 1),
        ("TX", later, Decimal("2.00"), 2, 2),
        ("TX", None, Decimal("9.00"), 9, 3),
        ("MTX", at, None, 4, 4),
    ]
    found = collect(bars(spark.createDataFrame(rows, SCHEMA), ["contract"], [1]))
    end = dt.datetime(2022, 1, 20, 1, 1)
    two = Decimal("2.00")
    assert found == {
        ("TX", 1, end): (None, two, two, two, two, None, 3),
        ("MTX", 1, end): (None, None, None, None, None, None, 4),
    }


def test_empty_input(spark):
    assert bars(spark.createDataFrame([], SCHEMA), ["contract"]).count() == 0


def test_sequence_out_of_range_is_an_error(spark):
    at = dt.datetime(2022, 1, 20, 1, 0, 30)
    df = spark.createDataFrame([("TX", at, Decimal(1), 1, 1 << 53)], SCHEMA)
    with pytest.raises(Exception, match="seq must be a number within"):
        bars(df, ["contract"]).collect()


def test_null_key_is_a_group(spark):
    at = dt.datetime(2022, 1, 20, 1, 0, 30)
    df = spark.createDataFrame([(None, at, Decimal(1), 1, 1), (None, at, Decimal(2), 1, 2)], SCHEMA)
    assert [r.price_close for r in bars(df, ["contract"], [1]).collect()] == [Decimal("2.00")]


def test_invariants_and_volume(spark):
    rows = random_ticks(2000, seed=8)
    made = bars(spark.createDataFrame(rows, SCHEMA), ["contract"])
    assert (
        made.where(
            "price_low > least(price_open, price_close, price_mean) "
            "or price_high < greatest(price_open, price_close, price_mean)"
        ).count()
        == 0
    )
    total = sum(r[3] for r in rows)
    sums = {r.scale: r.v for r in made.groupBy("scale").agg(F.sum("volume").alias("v")).collect()}
    assert sums == {scale: total for scale in SCALES}


def test_sums_of_a_full_run_fit():
    """The bound that makes overflow of a state impossible."""
    largest = 10**10 - 1
    high, low = largest >> bars_module.LIMB_BITS, (1 << bars_module.LIMB_BITS) - 1
    ticks = 1 << bars_module.LOW_BITS
    assert ticks * max(high * high, high * low, low * low, largest) < 1 << 63
    rank_bits = 10 + bars_module.OFFSET_BITS + bars_module.RUN_BITS
    assert rank_bits < 63 and bars_module.MAX_SCALE < 1 << 10


def test_first_ticks(spark):
    rows = random_ticks(1000, seed=9)
    df = spark.createDataFrame(rows, SCHEMA)
    first = first_ticks(df.withColumn("no", F.col("seq")), ["contract"], ["no"])
    found = {(r.contract, r.scale, r.datetime): r.no for r in first.collect()}
    expected = {}
    for contract, ts, _, _, seq in sorted(rows, key=lambda r: (r[1], r[4])):
        for scale in SCALES:
            expected.setdefault((contract, scale, bar_end(ts, scale)), seq)
    assert found == expected


def test_tick_bar_stats(spark):
    rows = random_ticks(400, seed=10) + [(None, dt.datetime(2022, 1, 20), Decimal(1), 1, 999)]
    df = spark.createDataFrame(rows, SCHEMA)
    found = tick_bar_stats(df, ["contract"]).collect()
    assert len(found) == len(rows) * len(SCALES)
    expected = brute_force(rows)
    for r in found:
        want = expected[(r.contract, r.scale, r.datetime)]
        assert (r.bar_price_open, r.bar_price_close, r.bar_volume) == (want[0], want[3], want[6])
        assert r.datetime == bar_end(r.ts, r.scale)
