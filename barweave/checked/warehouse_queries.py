"""Dimensions, facts, checks and candles."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barweave.checked import checked, table
from barweave.checked.views import (
    EVENT_TICKS,
    FUTURES_TICKS,
    event_ticks,
    order_trades,
    sql_bars,
    sql_calendar,
)
from barweave.operators.bars import bars
from barweave.operators.candles import contract_candles, in_range, index_candles
from barweave.operators.keys import new_dimension_rows
from barweave.operators.labels import label_expiry
from barweave.operators.lookups import (
    contract_ids,
    detail_facts,
    with_single_id,
)
from barweave.operators.normalize import normalize_futures
from barweave.operators.quality import duplicate_keys, null_counts, null_flags, orphans
from barweave.operators.zones import zones_of
from barweave.schemas import DERIVATIVE_DIM, DETAIL_DIM, DETAIL_KEYS, FUTURES, SCALES
from barweave.session import materialize, shared_folder
from barweave.sources.tables import write_partitions


def _grown(existing: DataFrame, candidates: DataFrame, keys) -> DataFrame:
    return existing.unionByName(new_dimension_rows(existing, candidates, keys))


_DERIVATIVE_KEYS = ("index_id", "name", "derivative_type")


@checked(
    """with existing as (
  select n_nationkey as id, n_regionkey as index_id, n_name as name, 'Futures' as derivative_type
  from nation where n_regionkey <= 2),
candidates as (
  select distinct n_regionkey as index_id, n_name as name, 'Futures' as derivative_type
  from supplier join nation on s_nationkey = n_nationkey),
fresh as (
  select * from candidates c where not exists (
    select 1 from existing e where e.index_id = c.index_id and e.name = c.name
      and e.derivative_type = c.derivative_type))
select id, index_id, name, derivative_type from existing
union all
select cast((select max(id) from existing)
            + row_number() over (order by index_id, name, derivative_type) as integer),
       index_id, name, derivative_type
from fresh"""
)
def dim_insert_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Derivatives of three regions exist; those traded by suppliers are added."""
    named = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("id"),
        F.col("n_regionkey").alias("index_id"),
        F.col("n_name").alias("name"),
        F.lit("Futures").alias("derivative_type"),
    )
    # Twenty-five nations at every scale factor; suppliers are reduced to keys first.
    traded = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("id")).distinct()
    candidates = traded.join(named, "id")
    return _grown(named.where("index_id <= 2"), candidates, _DERIVATIVE_KEYS)


_DETAILS = """
select {nation} as derivative_id, {expire} as expire, {code} as expire_code,
       cast(null as varchar) as strike_price,
       case when {balance} < 0 then 'P' when {balance} > 5000 then 'C' end as option_type
from {table}"""
_SUPPLIED = _DETAILS.format(
    nation="s_nationkey",
    expire="cast(null as varchar)",
    code="'W'",
    balance="s_acctbal",
    table="supplier",
)
_BOUGHT = _DETAILS.format(
    nation="c_nationkey",
    expire="case when c_mktsegment <> 'BUILDING' then c_mktsegment end",
    code="'W'",
    balance="c_acctbal",
    table="customer",
)
_DETAIL_ORDER = ", ".join(f"{key} nulls first" for key in DETAIL_KEYS)


@checked(
    f"""with existing as (
  select cast(row_number() over (order by {_DETAIL_ORDER}) - 1 as integer) as id, *
  from (select distinct * from ({_SUPPLIED}))),
fresh as (
  select distinct * from ({_BOUGHT}) c where not exists (
    select 1 from existing e where
      {' and '.join(f'e.{k} is not distinct from c.{k}' for k in DETAIL_KEYS)}))
select id, {', '.join(DETAIL_KEYS)} from existing
union all
select cast((select max(id) from existing) + row_number() over (order by {_DETAIL_ORDER})
            as integer), {', '.join(DETAIL_KEYS)} from fresh"""
)
def dim_insert_null_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract details with absent attributes: a null key is met again as the same key."""

    def details(name: str, prefix: str, expire) -> DataFrame:
        balance = F.col(f"{prefix}_acctbal")
        return table(spark, sf_dir, name).select(
            F.col(f"{prefix}_nationkey").alias("derivative_id"),
            expire.cast("string").alias("expire"),
            F.lit("W").alias("expire_code"),
            F.lit(None).cast("string").alias("strike_price"),
            F.when(balance < 0, "P").when(balance > 5000, "C").alias("option_type"),
        )

    segment = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment"))
    nothing = spark.createDataFrame([], DETAIL_DIM)
    existing = _grown(nothing, details("supplier", "s", F.lit(None)), DETAIL_KEYS)
    return _grown(existing, details("customer", "c", segment), DETAIL_KEYS)


_HOURLY = sql_bars(EVENT_TICKS, [], [60], volume=False)


@checked(
    f"""select (select r_regionkey from region where r_name = 'ASIA') as index_id, b.*
from ({_HOURLY}) b"""
)
def cross_single_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index bars with the id of the one index they belong to."""
    index = table(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("id"), F.col("r_name").alias("name")
    )
    hourly = bars(event_ticks(spark, sf_dir), scales=[60], volume=None)
    return with_single_id(hourly, index, "index_id", name="ASIA")


@checked(
    """select l_orderkey, l_linenumber, cast(l_quantity as double) as l_quantity, p_name as part,
       n_name as nation, r_name as region
from lineitem join part on l_partkey = p_partkey
join supplier on l_suppkey = s_suppkey
join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey"""
)
def fact_key_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts against a snowflake of dimensions.

    No hint: part and supplier grow with the facts, so Catalyst broadcasts them only
    below its threshold and adaptive execution splits skewed partitions above it. The
    small dimensions are joined to supplier first, and facts meet the result once.
    """
    nation = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    supplier = table(spark, sf_dir, "supplier").join(
        nation, F.col("s_nationkey") == F.col("n_nationkey")
    )
    return (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            "l_orderkey",
            "l_linenumber",
            "l_quantity",
            F.col("p_name").alias("part"),
            F.col("n_name").alias("nation"),
            F.col("r_name").alias("region"),
        )
    )


# --- the futures warehouse, filled from orders -------------------------------------------------


def _staged(spark: SparkSession, sf_dir: str, scales=SCALES) -> DataFrame:
    """Labelled bars at rest, as dimensions and facts are loaded from."""
    ticks = normalize_futures(order_trades(spark, sf_dir))
    return materialize(label_expiry(bars(ticks, ["ds", *FUTURES.bar_keys], scales)))


def _dimensions(spark: SparkSession, staged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Derivatives and details as the load makes them from empty tables."""
    traded = materialize(staged.select(*FUTURES.staging_keys).distinct())
    derivative = new_dimension_rows(
        spark.createDataFrame([], DERIVATIVE_DIM),
        traded.select(
            F.lit(0).alias("index_id"),
            F.col("contract").alias("name"),
            F.lit("Futures").alias("derivative_type"),
        ),
        _DERIVATIVE_KEYS,
    )
    nothing = F.lit(None).cast("string")
    named = derivative.select(F.col("id").alias("derivative_id"), F.col("name").alias("contract"))
    detail = new_dimension_rows(
        spark.createDataFrame([], DETAIL_DIM),
        traded.join(named, "contract").select(
            "derivative_id",
            "expire",
            "expire_code",
            nothing.alias("strike_price"),
            nothing.alias("option_type"),
        ),
        DETAIL_KEYS,
    )
    return derivative, detail


_CALENDAR = sql_calendar("select distinct cast(o_orderdate as date) as ds from orders")


def _warehouse_sql(scales=SCALES) -> str:
    return f"""
staged as (
  select b.*, c.expire_code from ({sql_bars(FUTURES_TICKS, ['ds', 'contract', 'expire'], scales)}) b
  join ({_CALENDAR}) c on c.ds = b.ds and c.expire = b.expire),
keys as (
  select distinct t.contract, t.expire, c.expire_code
  from ({FUTURES_TICKS}) t join ({_CALENDAR}) c on c.ds = t.ds and c.expire = t.expire),
derivative as (
  select row_number() over (order by contract) - 1 as id, contract as name
  from (select distinct contract from keys)),
detail as (
  select row_number() over (order by d.id, k.expire, k.expire_code) - 1 as id,
         d.id as derivative_id, k.contract, k.expire, k.expire_code
  from keys k join derivative d on d.name = k.contract)"""


@checked(
    f"""with {_warehouse_sql()}
select cast(d.id as integer) as derivative_detail_id,
       s.* exclude (contract, expire, expire_code) replace (cast(s.ds as varchar) as ds)
from staged s join detail d using (contract, expire, expire_code)"""
)
def warehouse_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trades to contract history with surrogate keys: the whole day's chain."""
    staged = _staged(spark, sf_dir)
    derivative, detail = _dimensions(spark, staged)
    keys = FUTURES.staging_keys
    contracts = contract_ids(derivative, detail, "Futures", keys)
    return detail_facts(staged, contracts, keys)


_RANGE = ("1996-01-01", "1998-12-31")


@checked(
    f"""with {_warehouse_sql([15])}
select datetime, price_open as open, price_high as high, price_low as low, price_close as close,
       volume
from staged where contract = 'TX' and expire_code = 'M'
  and datetime between timestamp '{_RANGE[0]}' and timestamp '{_RANGE[1]}'
order by datetime"""
)
def candles_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarter-hour candles of the front month over three years of orders."""
    keys = FUTURES.staging_keys
    staged = _staged(spark, sf_dir, [15])
    derivative, detail = _dimensions(spark, staged)
    contracts = contract_ids(derivative, detail, "Futures", keys)
    history = detail_facts(staged, contracts, keys)
    return contract_candles(derivative, detail, history, "TX", "M", 15, *_RANGE)


_MONTH = ("2024-01-05 00:05:00", "2024-01-20 12:00:00")


@checked(
    f"""select datetime, price_open as open, price_high as high, price_low as low,
       price_close as close
from ({sql_bars(EVENT_TICKS, [], [5], volume=False)})
where datetime between timestamp '{_MONTH[0]}' and timestamp '{_MONTH[1]}'
order by datetime"""
)
def candles_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = table(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("id"), F.col("r_name").alias("name")
    )
    five = bars(event_ticks(spark, sf_dir), scales=[5], volume=None)
    history = with_single_id(five, index, "index_id", name="ASIA")
    return index_candles(index, history, "ASIA", 5, *_MONTH)


_ONE_DAY = ("2024-01-10 00:00:00", "2024-01-10 23:59:59")
# Archives of a day that also hold times of the two days after it.
_LATE_TICKS = f"select *, cast(ts as date) - cast(seq % 3 as integer) as ds from ({EVENT_TICKS})"


@checked(
    f"""select cast(ds as varchar) as ds, contract, datetime, price_open as open, price_high as high,
       price_low as low, price_close as close
from ({sql_bars(_LATE_TICKS, ['ds', 'contract'], [5], volume=False)})
where datetime between timestamp '{_ONE_DAY[0]}' and timestamp '{_ONE_DAY[1]}'"""
)
def candles_by_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One day's candles of a history at rest, of which only days that hold such times are read."""
    late = F.date_sub(F.to_date("ts"), (F.col("seq") % 3).cast("int"))
    ticks = event_ticks(spark, sf_dir).withColumn("ds", late)
    facts = bars(ticks, ["ds", "contract"], [5], volume=None).withColumn("subject", F.lit("events"))
    path = f"{shared_folder(spark)}/history-{uuid.uuid4()}"
    write_partitions(facts, path, ("subject", "ds"), ("scale", "datetime"))
    history = spark.read.schema(facts.schema).parquet(path)
    zones = materialize(zones_of(history))
    rows = in_range(history, 5, *_ONE_DAY, zones)
    prices = [F.col(f"price_{name}").cast("double").alias(name) for name in ("open", "high", "low", "close")]
    return rows.select("ds", "contract", "datetime", *prices)


# --- checks ---------------------------------------------------------------------------------------

_HOLED = """
select o_orderstatus, o_orderkey, nullif(o_orderpriority, '5-LOW') as priority,
       case when o_orderstatus <> 'P' then o_totalprice end as price
from orders"""


def _holed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderstatus",
        "o_orderkey",
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("price"),
    )


@checked(
    f"""select o_orderstatus, cast(count(*) as bigint) as n_rows,
       cast(count(*) filter (o_orderkey is null) as bigint) as null_o_orderkey,
       cast(count(*) filter (priority is null) as bigint) as null_priority,
       cast(count(*) filter (price is null) as bigint) as null_price
from ({_HOLED}) group by o_orderstatus"""
)
def dq_null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ("o_orderkey", "priority", "price")
    return null_counts(_holed(spark, sf_dir), columns, by=("o_orderstatus",))


@checked(
    f"""select o_orderstatus,
       sum(case when o_orderkey is null then 1 else 0 end) = 0 as ok_o_orderkey,
       sum(case when priority is null then 1 else 0 end) = 0 as ok_priority,
       sum(case when price is null then 1 else 0 end) = 0 as ok_price
from ({_HOLED}) group by o_orderstatus"""
)
def dq_gate_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ("o_orderkey", "priority", "price")
    return null_flags(_holed(spark, sf_dir), columns, by=("o_orderstatus",))


_BAR_COLUMNS = tuple(name for name in FUTURES.required if not name.startswith("expire"))


@checked(
    "select cast(count(*) as bigint) as n_rows, "
    + ", ".join(
        f"cast(count(*) filter ({c} is null) as bigint) as null_{c}" for c in _BAR_COLUMNS
    )
    + f" from ({sql_bars(EVENT_TICKS, ['contract'])})"
)
def dq_bars_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The load gate over all bars of all scales."""
    return null_counts(bars(event_ticks(spark, sf_dir), ["contract"]), _BAR_COLUMNS)


@checked(
    """select l_orderkey, l_linenumber, cast(count(*) as bigint) as n_rows
from lineitem group by 1, 2 having count(*) > 1"""
)
def dq_duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_keys(table(spark, sf_dir, "lineitem"), ("l_orderkey", "l_linenumber"))


@checked(
    """select l_orderkey, cast(count(*) as bigint) as n_rows from lineitem
where not exists (select 1 from orders where o_orderkey = l_orderkey and o_orderstatus <> 'P')
group by l_orderkey"""
)
def dq_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines whose order is not among the settled ones."""
    settled = table(spark, sf_dir, "orders").where("o_orderstatus <> 'P'")
    return orphans(table(spark, sf_dir, "lineitem"), settled, "l_orderkey", "o_orderkey")
