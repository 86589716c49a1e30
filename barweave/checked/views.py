"""The given tables seen as market data, in Spark and in SQL."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barweave.checked import table
from barweave.functions.expiry import month_name, next_weekly_settlement, weekly_name
from barweave.schemas import PRICE, SCALES

# --- events as ticks: contract, ts, price, volume, seq ----------------------------------

EVENT_TICKS = """
select event_type as contract, ts, event_id as seq, user_id,
       cast(value as decimal(10,2)) as price,
       cast(json_extract_string(props, '$.k') as integer) as volume
from events"""


def event_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("contract"),
        "ts",
        F.col("event_id").alias("seq"),
        "user_id",
        F.col("value").cast(PRICE).alias("price"),
        F.get_json_object("props", "$.k").try_cast("int").alias("volume"),
    )


# --- orders as raw futures trades ---------------------------------------------------------


def order_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw text records: padded contracts, spreads for status P, dashes for no price."""
    day = F.col("o_orderdate").cast("date")
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    price = F.col("o_totalprice").cast(PRICE)
    next_month = month_name(F.add_months(F.trunc(day, "MM"), 1))
    expire = (
        F.when(status == "P", F.concat_ws("/", month_name(day), next_month))
        .when(status == "F", weekly_name(next_weekly_settlement(day)))
        .otherwise(month_name(day))
    )
    contract = (
        F.when(priority.isin("1-URGENT", "2-HIGH"), "TX")
        .when(priority == "3-MEDIUM", "MTX")
        .otherwise("ZZZ")
    )
    far = F.when(priority == "2-HIGH", "-").otherwise((price - 20).cast("string"))
    spread = status == "P"
    return table(spark, sf_dir, "orders").select(
        F.date_format(day, "yyyyMMdd").alias("date"),
        F.concat(contract, F.lit("    ")).alias("contract"),
        F.concat(expire, F.lit("   ")).alias("expire"),
        F.date_format(F.timestamp_seconds(price.cast("bigint")), "HHmmss").alias("time"),
        F.when(spread, F.lit("-20")).otherwise(price.cast("string")).alias("price"),
        F.concat(F.lit(" "), F.dayofyear(day)).alias("volume"),
        F.when(spread, price.cast("string")).otherwise("-").alias("near_price"),
        F.when(spread, far).otherwise("-").alias("far_price"),
        day.alias("ds"),
        F.col("o_orderkey").alias("seq"),
        F.lit("orders").alias("source_file"),
        F.col("o_orderkey").alias("line_no"),
    )


def sql_weekly(day: str) -> str:
    week = f"((day({day}) + 6) // 7)"
    return f"strftime({day}, '%Y%m') || case when {week} = 3 then '' else 'W' || {week} end"


def sql_next_wednesday(day: str) -> str:
    return f"cast({day} + cast(1 + (9 - isodow({day})) % 7 as integer) as date)"


# Ticks of TX and MTX, spreads unpacked.
FUTURES_TICKS = f"""
select * from (
  with trade as (
    select o_orderkey as seq, cast(o_orderdate as date) as ds, o_orderstatus as st,
           o_orderpriority as pr, cast(o_totalprice as decimal(10,2)) as p,
           dayofyear(o_orderdate) as v,
           case when o_orderpriority in ('1-URGENT', '2-HIGH') then 'TX' else 'MTX' end as contract,
           cast(o_orderdate as timestamp)
             + to_seconds(cast(floor(o_totalprice) as bigint) % 86400) - interval 8 hours as ts
    from orders where o_orderpriority in ('1-URGENT', '2-HIGH', '3-MEDIUM'))
  select seq, ds, contract, ts, p as price, cast(v as integer) as volume,
         case when st = 'F' then {sql_weekly(sql_next_wednesday('ds'))}
              else strftime(ds, '%Y%m') end as expire
  from trade where st <> 'P'
  union all
  select seq, ds, contract, ts, p, cast(v // 2 as integer), strftime(ds, '%Y%m')
  from trade where st = 'P'
  union all
  select seq, ds, contract, ts, p - 20, cast(v // 2 as integer),
         strftime(date_trunc('month', ds) + interval 1 month, '%Y%m')
  from trade where st = 'P' and pr <> '2-HIGH')"""


# --- bars ------------------------------------------------------------------------------------


def sql_bar_end(scale: str = "scale", ts: str = "ts") -> str:
    width = f"(60000000 * cast({scale} as bigint))"
    return f"make_timestamp(cast(((epoch_us({ts}) + {width} - 1) // {width}) * {width} as bigint))"


def sql_bars(
    ticks: str,
    keys: Sequence[str],
    scales: Sequence[int] = SCALES,
    volume: bool = True,
) -> str:
    """Bars straight from their definition, over a subquery of ticks."""
    listed = "".join(f"{key}, " for key in keys)
    return f"""
select {listed}scale, datetime,
       cast(arg_min(price, (ts, seq)) as double) as price_open,
       cast(max(price) as double) as price_high,
       cast(min(price) as double) as price_low,
       cast(arg_max(price, (ts, seq)) as double) as price_close,
       cast((2 * sum(cast(price * 100 as bigint)) * 10000 + count(*)) // (2 * count(*)) as double)
         / 1000000 as price_mean,
       round(stddev_samp(cast(price as double)), 6) as price_std
       {', cast(sum(volume) as bigint) as volume' if volume else ''}
from (select *, {sql_bar_end()} as datetime
      from (select *, unnest({list(scales)}) as scale from ({ticks})))
group by {listed}scale, datetime"""


# --- expiry calendar --------------------------------------------------------------------------


def sql_calendar(days: str) -> str:
    """``ds, code_no, expire_code, expire`` for a subquery of dates ``ds``."""
    later = [
        (i + 1, f"M{'+' + str(i) if i else ''}", f"front + interval {i} month") for i in range(3)
    ] + [
        (i + 3, f"Q+{i}", f"date_trunc('quarter', front) + interval {2 + 3 * i} month")
        for i in (1, 2, 3)
    ]
    others = "".join(
        f"""
  union all
  select ds, {no} + wed, '{code}', strftime({month}, '%Y%m') from rolled"""
        for no, code, month in later
    )
    return f"""
select * from (
  with given as (
    select ds, cast(date_trunc('month', ds) as date) as m0,
           cast(isodow(ds) = 3 as integer) as wed from ({days})),
  settled as (
    select *, m0 + 14 + cast((10 - isodow(m0 + 14)) % 7 as integer) as settlement,
           {sql_next_wednesday('ds')} as next_wed from given),
  rolled as (
    select *, case when ds > settlement then m0 + interval 1 month else m0 end as front
    from settled)
  select ds, wed as code_no, 'W' as expire_code, {sql_weekly('next_wed')} as expire from rolled
  union all
  select ds, 0, 'W', {sql_weekly('ds')} from rolled where wed = 1{others})"""
