"""Cleaning, parsing and spread trades, over orders, part, customer and events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barweave.checked import checked, table
from barweave.checked.views import FUTURES_TICKS, order_trades, sql_bars, sql_calendar
from barweave.functions.clock import exchange_time_to_utc
from barweave.functions.text import (
    clock_time,
    far_leg,
    near_leg,
    to_count,
    to_price,
    without_spaces,
)
from barweave.operators.bars import bars
from barweave.operators.labels import label_expiry
from barweave.operators.normalize import is_spread, normalize_futures, only_contracts
from barweave.schemas import FUTURES, FUTURES_CONTRACTS, OPTIONS, OPTIONS_CONTRACTS, PRICE

TICK_COLUMNS = ("seq", "ds", "contract", "expire", "ts", "price", "volume")


@checked(
    f"""select seq, cast(ds as varchar) as ds, contract, expire, ts,
       cast(price as double) as price, volume from ({FUTURES_TICKS})"""
)
def spread_unpack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trades to ticks: contracts filtered, spreads split, local time to UTC."""
    return normalize_futures(order_trades(spark, sf_dir)).select(*TICK_COLUMNS)


@checked(
    """select o_orderkey as seq, strftime(o_orderdate, '%Y%m') as near,
       strftime(date_trunc('month', o_orderdate) + interval 1 month, '%Y%m') as far
from orders where o_orderstatus = 'P'"""
)
def spread_split_regex(spark: SparkSession, sf_dir: str) -> DataFrame:
    trades = order_trades(spark, sf_dir)
    return trades.where(is_spread(F.col("expire"))).select(
        "seq", near_leg(F.col("expire")).alias("near"), far_leg(F.col("expire")).alias("far")
    )


@checked(
    f"""select seq, cast(ds as varchar) as ds, contract, expire, ts,
       cast(price as double) as price, volume from ({FUTURES_TICKS})"""
)
def union_dealt_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outright and spread records kept apart, cleaned alike, then united."""
    trades = order_trades(spark, sf_dir)
    spread = is_spread(F.col("expire"))
    parts = [normalize_futures(trades.where(part)) for part in (~spread, spread)]
    return parts[0].unionByName(parts[1]).select(*TICK_COLUMNS)


@checked(
    """select o_orderkey as seq,
       case when o_orderpriority in ('1-URGENT', '2-HIGH') then 'TX' else 'MTX' end as contract
from orders where o_orderpriority in ('1-URGENT', '2-HIGH', '3-MEDIUM')"""
)
def contract_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return only_contracts(order_trades(spark, sf_dir), ("TX", "MTX")).select("seq", "contract")


_FUTURES_BARS = sql_bars(FUTURES_TICKS, ["ds", "contract", "expire"])


@checked(
    f"""select b.* replace (cast(b.ds as varchar) as ds), c.expire_code
from ({_FUTURES_BARS}) b
join ({sql_calendar('select distinct cast(o_orderdate as date) as ds from orders')}) c
  on c.ds = b.ds and c.expire = b.expire"""
)
def bars_futures_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trades to labelled bars; an expiry with two codes has one bar for either."""
    ticks = normalize_futures(order_trades(spark, sf_dir))
    return label_expiry(bars(ticks, ["ds", *FUTURES.bar_keys]))


@checked(
    f"""select b.* exclude (ds, contract, expire)
from (select b.*, c.expire_code
      from ({sql_bars(FUTURES_TICKS, ['ds', 'contract', 'expire'], [30])}) b
      join ({sql_calendar('select distinct cast(o_orderdate as date) as ds from orders')}) c
        on c.ds = b.ds and c.expire = b.expire) b
where contract = 'TX' and expire_code = 'M'"""
)
def bars_one_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One group of all contracts and codes: half-hour bars of TX in the front month."""
    ticks = normalize_futures(order_trades(spark, sf_dir), ("TX",))
    labelled = label_expiry(bars(ticks, ["ds", *FUTURES.bar_keys], [30]))
    return labelled.where(F.col("expire_code") == "M").drop("ds", "contract", "expire")


@checked(
    """select o_orderkey as seq,
       case when o_orderpriority in ('1-URGENT', '2-HIGH') then 'TX'
            when o_orderpriority = '3-MEDIUM' then 'MTX' else 'ZZZ' end as contract,
       case when o_orderpriority in ('1-URGENT', '2-HIGH', '3-MEDIUM') then 'Futures' end
         as derivative_type
from orders"""
)
def derivative_type_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Map lookup where an unknown contract gives null."""
    types = {name: FUTURES.derivative_type for name in FUTURES_CONTRACTS}
    types |= {name: OPTIONS.derivative_type for name in OPTIONS_CONTRACTS}
    literal = F.create_map(*(F.lit(part) for pair in types.items() for part in pair))
    contract = F.trim("contract")
    return order_trades(spark, sf_dir).select(
        "seq", contract.alias("contract"), literal[contract].alias("derivative_type")
    )


@checked(
    """select p_partkey, trim(p_name) as name, replace(p_name, ' ', '') as name_packed,
       p_brand || ' ' || p_type as brand_type,
       lpad(cast(p_size % 24 as varchar), 2, '0') || ':30:00' as clock, '' as no_clock,
       cast(p_retailprice as decimal(10,2))::double as price
from part"""
)
def clean_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Padded, wrapped and comma-grouped text back to clean values."""
    wrapped = F.concat(
        F.lit('="'), F.lpad((F.col("p_size") % 24).cast("string"), 2, "0"), F.lit(':30:00"')
    )
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        F.trim(F.concat(F.lit("  "), F.col("p_name"), F.lit("   "))).alias("name"),
        without_spaces(F.concat(F.col("p_name"), F.lit("  "))).alias("name_packed"),
        F.concat_ws(" ", "p_brand", "p_type").alias("brand_type"),
        clock_time(wrapped).alias("clock"),
        clock_time(F.col("p_name")).alias("no_clock"),
        to_price(F.concat(F.lit(" "), F.format_number("p_retailprice", 2))).alias("price"),
    )


@checked(
    """select event_id, date_trunc('second', ts) - interval 8 hours as trade_time,
       date_trunc('second', ts) - interval 8 hours as index_time,
       date_trunc('millisecond', ts) - interval 8 hours as etf_time,
       cast(null as timestamp) as unreadable
from events"""
)
def parse_local_to_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
    def parsed(date: str, time: str, pattern: str):
        return exchange_time_to_utc(F.date_format("ts", date), F.date_format("ts", time), pattern)

    return table(spark, sf_dir, "events").select(
        "event_id",
        parsed("yyyyMMdd", "HHmmss", "yyyyMMdd HHmmss").alias("trade_time"),
        parsed("yyyy_MM_dd", "HH:mm:ss", "yyyy_MM_dd HH:mm:ss").alias("index_time"),
        parsed("yyyy-MM-dd", "HH:mm:ss.SSS", "yyyy-MM-dd HH:mm:ss.SSS").alias("etf_time"),
        parsed("yyyy-MM", "HH:mm", "yyyyMMdd HHmmss").alias("unreadable"),
    )


@checked(
    """select o_orderkey, cast(cast(o_totalprice as decimal(10,2)) as double) as price,
       cast(day(o_orderdate) as integer) as volume
from orders where o_orderstatus <> 'P' and o_orderpriority <> '5-LOW'"""
)
def try_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dashes and words become null instead of failing; rows with a null are dropped."""
    price = F.format_number("o_totalprice", 2)
    return (
        table(spark, sf_dir, "orders")
        .select(
            "o_orderkey",
            to_price(F.when(F.col("o_orderstatus") == "P", "-").otherwise(price)).alias("price"),
            to_count(
                F.when(F.col("o_orderpriority") == "5-LOW", "n/a").otherwise(
                    F.concat(F.lit(" "), F.day("o_orderdate"), F.lit(" "))
                )
            ).alias("volume"),
        )
        .na.drop()
    )


@checked(
    """select distinct l_returnflag as contract, cast(year(l_shipdate) as integer) as expire,
       l_linestatus as option_type from lineitem"""
)
def distinct_contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "lineitem")
        .select(
            F.col("l_returnflag").alias("contract"),
            F.year("l_shipdate").alias("expire"),
            F.col("l_linestatus").alias("option_type"),
        )
        .distinct()
    )


@checked("select distinct cast(cast(l_shipdate as date) as varchar) as ds from lineitem")
def distinct_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    shipped = F.col("l_shipdate").cast("date").alias("ds")
    return table(spark, sf_dir, "lineitem").select(shipped).distinct()


@checked(
    """select l_orderkey, l_linenumber, cast(cast(l_quantity as integer) // 2 as bigint) as half,
       case when l_returnflag = 'R' then 'return' else 'keep' end as kind,
       cast(cast(l_extendedprice as decimal(10,2)) as double) as price
from lineitem"""
)
def integer_halving(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.expr("cast(l_quantity as int) div 2").alias("half"),
        F.when(F.col("l_returnflag") == "R", "return").otherwise("keep").alias("kind"),
        F.col("l_extendedprice").cast(PRICE).alias("price"),
    )
