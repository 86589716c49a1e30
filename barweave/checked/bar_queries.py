"""Bars, buckets and ticks in bars, over events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barweave.checked import checked, table
from barweave.checked.views import EVENT_TICKS, event_ticks, sql_bar_end, sql_bars
from barweave.functions.buckets import floor_second, round_up_minutes
from barweave.operators.bars import bars
from barweave.operators.tick_stats import first_ticks, tick_bar_stats
from barweave.schemas import PRICE, SCALES


@checked(sql_bars(EVENT_TICKS, ["contract"]))
def bars_all_scales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars(event_ticks(spark, sf_dir), ["contract"])


_AT_INDEX_LEVEL = f"""
select * replace (cast(price + 18000 as decimal(10,2)) as price) from ({EVENT_TICKS})"""


@checked(sql_bars(_AT_INDEX_LEVEL, ["contract"], [60]))
def bars_rollup_60(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hour bars at index price level, where the deviation is prone to cancellation."""
    ticks = event_ticks(spark, sf_dir)
    return bars(ticks.withColumn("price", (F.col("price") + 18000).cast(PRICE)), ["contract"], [60])


@checked(sql_bars(EVENT_TICKS, [], volume=False))
def bars_index_no_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One series, as an index has: no key and no volume."""
    return bars(event_ticks(spark, sf_dir), volume=None)


_OPTION_TICKS = f"""
select *, strftime(ts, '%Y%m') as expire, cast(user_id as varchar) as strike_price,
       case when price >= 50 then 'C' else 'P' end as option_type from ({EVENT_TICKS})"""
_OPTION_KEYS = ["contract", "expire", "strike_price", "option_type"]


@checked(sql_bars(_OPTION_TICKS, _OPTION_KEYS))
def bars_options_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    ticks = event_ticks(spark, sf_dir).withColumns(
        {
            "expire": F.date_format("ts", "yyyyMM"),
            "strike_price": F.col("user_id").cast("string"),
            "option_type": F.when(F.col("price") >= 50, "C").otherwise("P"),
        }
    )
    return bars(ticks, _OPTION_KEYS)


_WINDOWED = f"""
select contract, scale, ts, seq, price, volume, datetime,
       row_number() over w as n,
       first_value(price) over w as o, max(price) over w as h, min(price) over w as l,
       last_value(price) over w as c,
       stddev_samp(cast(price as double)) over w as s, sum(volume) over w as v,
       sum(cast(price * 100 as bigint)) over w as cents, count(*) over w as k
from (select *, {sql_bar_end()} as datetime
      from (select *, unnest({list(SCALES)}) as scale from ({EVENT_TICKS})))
window w as (partition by contract, scale, datetime order by ts, seq
             rows between unbounded preceding and unbounded following)"""
_WINDOW_STATS = """cast(o as double) as {0}price_open, cast(h as double) as {0}price_high,
       cast(l as double) as {0}price_low, cast(c as double) as {0}price_close,
       cast((2 * cents * 10000 + k) // (2 * k) as double) / 1000000 as {0}price_mean,
       round(s, 6) as {0}price_std, cast(v as bigint) as {0}volume"""


@checked(
    f"""select contract, scale, datetime, seq, {_WINDOW_STATS.format('')}
from ({_WINDOWED}) where n = 1"""
)
def bars_window_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole-frame window statistics kept at each bar's first tick."""
    ticks = event_ticks(spark, sf_dir).withColumn("first_seq", F.col("seq"))
    made = bars(ticks, ["contract"], first_tick=["first_seq"])
    return made.withColumnRenamed("first_seq", "seq")


@checked(
    f"""select contract, scale, ts, seq, cast(price as double) as price, volume, datetime,
       {_WINDOW_STATS.format('bar_')} from ({_WINDOWED})"""
)
def tick_stats_all_scales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tick at every scale with the statistics of its bar."""
    ticks = event_ticks(spark, sf_dir).drop("user_id")
    stats = tick_bar_stats(ticks, ["contract"])
    return stats.withColumn("bar_price_std", F.round("bar_price_std", 6))


@checked(
    f"""select contract, scale, {sql_bar_end()} as datetime, seq, user_id,
       cast(price as double) as price
from (select *, unnest({list(SCALES)}) as scale from ({EVENT_TICKS}))
qualify row_number() over (partition by contract, scale, datetime order by ts, seq) = 1"""
)
def first_tick_per_bar(spark: SparkSession, sf_dir: str) -> DataFrame:
    ticks = event_ticks(spark, sf_dir).withColumns(
        {"tick_price": F.col("price"), "tick_seq": F.col("seq")}
    )
    first = first_ticks(ticks, ["contract"], ["tick_seq", "user_id", "tick_price"])
    return first.withColumnsRenamed({"tick_seq": "seq", "tick_price": "price"})


@checked(
    "select event_id, "
    + ", ".join(f"{sql_bar_end(str(s))} as end_{s}" for s in SCALES)
    + " from events"
)
def roundup_minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", *(round_up_minutes(F.col("ts"), s).alias(f"end_{s}") for s in SCALES)
    )


@checked("select event_id, date_trunc('second', ts) as second from events")
def floor_to_second(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", floor_second(F.col("ts").cast("timestamp")).alias("second")
    )


@checked(
    """select event_type, cast(count(*) as bigint) as n_ticks,
       cast(sum(cast(json_extract(props, '$.k') as integer)) as bigint) as volume,
       cast(min(cast(json_extract(props, '$.k') as integer)) as integer) as min_volume,
       cast(max(cast(json_extract(props, '$.k') as integer)) as integer) as max_volume
from events group by event_type"""
)
def json_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed field out of a JSON document, summed by contract."""
    parsed = table(spark, sf_dir, "events").select(
        "event_type", F.from_json("props", "k int").getField("k").alias("k")
    )
    return parsed.groupBy("event_type").agg(
        F.count("*").alias("n_ticks"),
        F.sum("k").alias("volume"),
        F.min("k").alias("min_volume"),
        F.max("k").alias("max_volume"),
    )


_LATEST = sql_bars(EVENT_TICKS, ["contract"], [60])


@checked(
    f"""select contract, datetime, price_open as open, price_high as high, price_low as low,
       price_close as close, volume
from ({_LATEST}) order by datetime desc, contract limit 20"""
)
def topn_latest_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest bars, named and typed for a chart."""
    hourly = bars(event_ticks(spark, sf_dir), ["contract"], [60])
    return hourly.orderBy(F.desc("datetime"), "contract").limit(20).select(
        "contract",
        "datetime",
        *(F.col(f"price_{n}").cast("double").alias(n) for n in ("open", "high", "low", "close")),
        "volume",
    )
