"""Expiry codes, trading days and date functions, over orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barweave.checked import checked, table
from barweave.checked.views import sql_calendar
from barweave.functions.clock import (
    day_label,
    day_of_label,
    day_of_month_day,
    month_day_label,
    roc_year,
)
from barweave.functions.expiry import (
    month_name,
    monthly_settlement,
    next_weekly_settlement,
    weekly_name,
)
from barweave.operators.calendar import SATURDAY, holiday_list, mark_trading_days, trading_days
from barweave.operators.labels import codes_by_expire, expiry_calendar, label_expiry
from barweave.schemas import MAKE_UP_MEMO

_ORDER_DAYS = "select distinct cast(o_orderdate as date) as ds from orders"


def _day() -> Column:
    return F.col("o_orderdate").cast("date")


def _order_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(_day().alias("ds")).distinct()


@checked(
    f"""select cast(ds as varchar) as ds, code_no, expire_code, expire
from ({sql_calendar(_ORDER_DAYS)})"""
)
def expiry_codes_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all days on which there are orders."""
    return expiry_calendar(_order_days(spark, sf_dir))


@checked(
    f"""select cast(ds as varchar) as ds, expire,
       string_agg(expire_code, ',' order by code_no) as expire_codes
from ({sql_calendar(_ORDER_DAYS)}) group by ds, expire"""
)
def expiry_codes_inverted(spark: SparkSession, sf_dir: str) -> DataFrame:
    inverted = codes_by_expire(expiry_calendar(_order_days(spark, sf_dir)))
    return inverted.withColumn("expire_codes", F.concat_ws(",", "expire_codes"))


_AHEAD = """cast(substr(o_orderpriority, 1, 1) as integer) - 1
            + case o_orderstatus when 'O' then 0 when 'P' then 5 else 10 end"""
_EXPIRING = f"""
select o_orderkey, o_orderdate as ds,
       strftime(date_trunc('month', o_orderdate) + to_months({_AHEAD}), '%Y%m') as expire
from orders"""


@checked(
    f"""select o.o_orderkey, cast(cast(o.ds as date) as varchar) as ds, o.expire, c.expire_code
from ({_EXPIRING}) o join ({sql_calendar(_ORDER_DAYS)}) c
  on c.ds = cast(o.ds as date) and c.expire = o.expire"""
)
def label_expiry_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly expiries up to 14 months ahead; those without a code vanish."""
    status = F.col("o_orderstatus")
    by_status = F.when(status == "O", 0).when(status == "P", 5).otherwise(10)
    ahead = F.substring("o_orderpriority", 1, 1).cast("int") - 1 + by_status
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        _day().alias("ds"),
        month_name(F.add_months(F.trunc(_day(), "MM"), ahead)).alias("expire"),
    )
    return label_expiry(orders)


@checked(
    f"""select cast(ds as varchar) as ds, expire_code, cast(count(*) as bigint) as n_orders
from (select cast(o_orderdate as date) as d, strftime(o_orderdate, '%Y%m') as ex from orders)
join ({sql_calendar(_ORDER_DAYS)}) on ds = d and expire = ex
group by ds, expire_code"""
)
def orders_by_expiry_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per day and code of their month, counted before they are labelled."""
    per_month = (
        table(spark, sf_dir, "orders")
        .select(_day().alias("ds"), month_name(_day()).alias("expire"))
        .groupBy("ds", "expire")
        .agg(F.count("*").alias("n_orders"))
    )
    return label_expiry(per_month).select("ds", "expire_code", "n_orders")


_SCHEDULE = """
select cast(o_orderdate as date) as ds, count(*) as n_orders,
       count(*) filter (o_orderstatus = 'F') > count(*) filter (o_orderstatus = 'O') as listed,
       count(*) filter (o_orderstatus = 'F') >= 2 * count(*) filter (o_orderstatus = 'O') as open
from orders group by 1"""


def _days_and_schedule(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Order days with their counts, and a holiday schedule as text taken from them."""

    def having(status: str):
        return F.count_if(F.col("o_orderstatus") == status)

    days = (
        table(spark, sf_dir, "orders")
        .groupBy(_day().alias("ds"))
        .agg(
            F.count("*").alias("n_orders"),
            (having("F") > having("O")).alias("listed"),
            (having("F") >= 2 * having("O")).alias("open"),
        )
    )
    schedule = days.where("listed").select(
        month_day_label(F.col("ds")).alias("date"),
        F.year("ds").alias("year"),
        F.when(F.col("open"), MAKE_UP_MEMO).alias("memo"),
    )
    return days, schedule


@checked(
    f"""select cast(ds as varchar) as ds, cast(n_orders as bigint) as n_orders,
       case when listed then open else isodow(ds) <= 5 end as is_trading
from ({_SCHEDULE})"""
)
def trading_day_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    days, schedule = _days_and_schedule(spark, sf_dir)
    return mark_trading_days(days.select("ds", "n_orders"), holiday_list(schedule))


@checked(
    f"""with listed as (select ds, open from ({_SCHEDULE}) where listed),
bounds as (
  select cast(min(o_orderdate) as date) as a, cast(max(o_orderdate) as date) as b from orders),
every as (select cast(unnest(generate_series(a, b, interval 1 day)) as date) as day from bounds)
select cast(day as varchar) as ds
from every left join listed on ds = day
where coalesce(open, isodow(day) <= 5)"""
)
def trading_days_listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All trading days from the first order's day to the last one's."""
    _, schedule = _days_and_schedule(spark, sf_dir)
    every = (
        table(spark, sf_dir, "orders")
        .agg(F.min(_day()).alias("a"), F.max(_day()).alias("b"))
        .select(F.explode(F.sequence("a", "b")).alias("ds"))
    )
    return trading_days(every, holiday_list(schedule))


@checked(
    """select o_orderkey, cast(year(o_orderdate) - 1911 as integer) as roc_year,
       strftime(o_orderdate, '%Y_%m_%d') as label,
       month(o_orderdate) || '月' || day(o_orderdate) || '日' as month_day,
       cast(cast(o_orderdate as date) as varchar) as day,
       cast(cast(o_orderdate as date) as varchar) as label_day,
       cast(isodow(o_orderdate) - 1 as integer) as weekday,
       isodow(o_orderdate) > 5 as is_weekend
from orders"""
)
def roc_year_monthday(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        roc_year(_day()).alias("roc_year"),
        day_label(_day()).alias("label"),
        month_day_label(_day()).alias("month_day"),
        F.weekday(_day()).alias("weekday"),
        (F.weekday(_day()) >= SATURDAY).alias("is_weekend"),
    )
    year = F.col("roc_year") + 1911
    return named.withColumns(
        {
            "day": day_of_month_day(F.col("month_day"), year),
            "label_day": day_of_label(F.col("label")),
        }
    )


@checked(
    """select distinct cast(cast(o_orderdate as date) as varchar) as ds,
       cast(make_date(year(o_orderdate), month(o_orderdate), 15)
         + cast((10 - isodow(make_date(year(o_orderdate), month(o_orderdate), 15))) % 7 as integer)
         as varchar) as monthly,
       cast(cast(o_orderdate as date) + cast(1 + (9 - isodow(o_orderdate)) % 7 as integer)
         as varchar) as weekly,
       (select min(case when (day(x) + 6) // 7 = 3 then strftime(x, '%Y%m')
                        else strftime(x, '%Y%m') || 'W' || (day(x) + 6) // 7 end)
        from (select cast(o_orderdate as date)
                     + cast(1 + (9 - isodow(o_orderdate)) % 7 as integer) as x)) as weekly_name
from orders"""
)
def settlement_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    weekly = next_weekly_settlement(F.col("ds"))
    return _order_days(spark, sf_dir).select(
        "ds",
        monthly_settlement(F.col("ds")).alias("monthly"),
        weekly.alias("weekly"),
        weekly_name(weekly).alias("weekly_name"),
    )
