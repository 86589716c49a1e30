"""Landed records of all subjects, and the tables they are written to and read back from."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barweave.checked import checked, table
from barweave.checked.views import EVENT_TICKS, event_ticks, sql_bars
from barweave.functions.clock import day_label
from barweave.operators.bars import bars
from barweave.operators.normalize import normalize_etf, normalize_index, normalize_options
from barweave.plans.layout import Layout
from barweave.plans.warehouse import load_subject, warehouse_table
from barweave.schemas import ETF_RAW, INDEX_RAW, OPTIONS_RAW, PRICE, TICKS
from barweave.session import materialize, shared_folder
from barweave.sources.landed import (
    ROW_BITS,
    origin_columns,
    parse_csv,
    skip_lines,
    with_file_numbers,
)
from barweave.sources.tables import conform, drop_days, read_days, write_partitions

_OPTION_COLUMNS = ("seq", "contract", "strike_price", "expire", "option_type", "ts", "price", "volume")


def _new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4()}"


def _clock(price) -> object:
    return F.timestamp_seconds(price.cast("bigint"))


@checked(
    f"""select 'TAIEX' as contract, {1 << ROW_BITS} + o_orderkey + 2 as seq,
       o_orderkey + 2 as line_no, cast(cast(o_orderdate as date) as varchar) as ds,
       cast(o_orderdate as timestamp)
         + to_seconds(cast(floor(o_totalprice) as bigint) % 86400) - interval 8 hours as ts,
       cast(cast(o_totalprice as decimal(10,2)) as double) as price
from orders where o_orderstatus <> 'P' and not (o_orderstatus = 'F' and o_orderpriority = '5-LOW')"""
)
def index_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV lines of one file a day, with two header lines, blank lines and notes, to ticks."""
    orders = table(spark, sf_dir, "orders")
    price = F.col("o_totalprice").cast(PRICE)
    value = F.concat(
        F.lit('"=""'), F.date_format(_clock(price), "HH:mm:ss"), F.lit('""","'),
        F.format_number(price, 2), F.lit('",more'),
    )
    note = (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "5-LOW")
    body = orders.select(
        F.concat(F.lit("index_"), day_label(F.col("o_orderdate")), F.lit(".csv")).alias("source_file"),
        (F.col("o_orderkey") + 2).alias("line_no"),
        F.when(F.col("o_orderstatus") == "P", "  ").when(note, "note,1").otherwise(value).alias("line"),
    )
    files = body.select("source_file").distinct()
    heads = files.select(
        "source_file", F.posexplode(F.array(F.lit("Values"), F.lit("09:00:00,1"))).alias("line_no", "line")
    )
    lines = skip_lines(body.unionByName(heads.withColumn("line_no", F.col("line_no").cast("bigint"))), 2)
    numbered = with_file_numbers(lines.withColumn("row_no", F.col("line_no")), files)
    raw = parse_csv(numbered, INDEX_RAW, *origin_columns())
    return normalize_index(raw).select("contract", "seq", "line_no", "ds", "ts", "price")


@checked(
    """select event_type as contract, event_id as seq, cast(n as bigint) as line_no,
       date_trunc('second', ts + to_minutes(n)) - interval 8 hours as ts,
       cast(cast(value as decimal(10,2)) as double) as price,
       cast(json_extract_string(props, '$.k') as integer) as volume
from (select *, unnest([0, 1]) as n from events)"""
)
def etf_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON documents with ticks nested in an array, to ticks without the fraction of a second."""
    events = table(spark, sf_dir, "events")

    def tick(minutes: int):
        at = F.col("ts") + F.expr(f"interval {minutes} minutes")
        return F.struct(
            F.date_format(at, "yyyy-MM-dd").alias("date"),
            F.date_format(at, "HH:mm:ss.SSS").alias("Time"),
            F.col("event_type").alias("stock_id"),
            F.col("value").alias("deal_price"),
            F.get_json_object("props", "$.k").cast("bigint").alias("volume"),
        )

    written = events.select(
        F.col("event_id").alias("seq"),
        F.to_json(F.struct(F.array(tick(0), tick(1)).alias("data"))).alias("document"),
    )
    read = written.select("seq", F.from_json("document", ETF_RAW).alias("document"))
    ticks = read.select("seq", F.posexplode("document.data").alias("line_no", "tick"))
    raw = ticks.select("tick.*", "seq", F.col("line_no").cast("bigint").alias("line_no"))
    return normalize_etf(raw).select("contract", "seq", "line_no", "ts", "price", "volume")


@checked(
    """select l_orderkey * 10 + l_linenumber as seq, 'TXO' as contract,
       cast(l_partkey as varchar) as strike_price, strftime(l_shipdate, '%Y%m') as expire,
       case when l_linestatus = 'F' then 'C' else 'P' end as option_type,
       cast(l_shipdate as timestamp)
         + to_seconds(cast(floor(l_extendedprice) as bigint) % 86400) - interval 8 hours as ts,
       case when l_returnflag <> 'R' then cast(cast(l_extendedprice as decimal(10,2)) as double) end
         as price,
       cast(l_quantity as integer) as volume
from lineitem where l_returnflag <> 'A'"""
)
def options_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV lines with padded fields and dashes for prices, to ticks of the wanted contract."""
    price = F.col("l_extendedprice").cast(PRICE)
    fields = (
        F.date_format("l_shipdate", "yyyyMMdd"),
        F.when(F.col("l_returnflag") == "A", "XYZ").otherwise("TXO   "),
        F.concat(F.col("l_partkey").cast("string"), F.lit("  ")),
        F.date_format("l_shipdate", "yyyyMM  "),
        F.when(F.col("l_linestatus") == "F", "C").otherwise(" P"),
        F.date_format(_clock(price), "HHmmss"),
        F.when(F.col("l_returnflag") == "R", "-").otherwise(price.cast("string")),
        F.concat(F.lit(" "), F.col("l_quantity").cast("int")),
        F.lit("beyond the schema"),
    )
    lines = table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"),
        F.concat_ws(",", *fields).alias("line"),
    )
    return normalize_options(parse_csv(lines, OPTIONS_RAW, F.col("seq"))).select(*_OPTION_COLUMNS)


_DAYS = ("2024-01-05", "2024-01-20")
_CHANGED, _GONE = "2024-01-10", "2024-01-12"


@checked(
    f"""select contract, seq, ts, cast(price as double) as price,
       cast(case when cast(ts as date) = date '{_CHANGED}' then volume + 1000 else volume end as integer)
         as volume,
       cast(cast(ts as date) as varchar) as ds
from ({EVENT_TICKS}) where cast(ts as date) between date '{_DAYS[0]}' and date '{_DAYS[1]}'
  and cast(ts as date) <> date '{_GONE}'"""
)
def day_overwritten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks by day at rest: one day replaced, one removed, and a range of days read back."""
    absent = {
        name: F.lit(None).cast("string")
        for name in ("expire", "strike_price", "option_type", "source_file")
    }
    ticks = event_ticks(spark, sf_dir).withColumns(
        {
            **absent,
            "subject": F.lit("etf"),
            "line_no": F.col("seq"),
            "ds": F.col("ts").cast("date"),
        }
    )
    path = _new_folder(spark, "ticks")
    write_partitions(conform(ticks, TICKS), path, ["subject", "ds"], ["ts"])
    changed = ticks.where(F.col("ds") == F.lit(_CHANGED).cast("date"))
    changed = changed.withColumn("volume", F.col("volume") + 1000)
    write_partitions(conform(changed, TICKS), path, ["subject", "ds"], ["ts"])
    drop_days(spark, path, "etf", [_GONE.replace("-", "_")])
    kept = read_days(spark, path, TICKS, "etf", *_DAYS)
    return kept.select("contract", "seq", "ts", "price", "volume", "ds")


_DAILY_TICKS = f"select *, cast(ts as date) as ds from ({EVENT_TICKS})"


@checked(
    f"""select 'TAIEX' as index_name, 'TW' as market, 'ETF' as derivative_type,
       cast(dense_rank() over (order by contract) - 1 as integer) as derivative_detail_id,
       contract as name, b.* exclude (contract, ds), cast(ds as varchar) as ds
from ({sql_bars(_DAILY_TICKS, ["ds", "contract"])}) b"""
)
def history_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars loaded twice into the warehouse's tables, read back with the names of their keys."""
    ticks = event_ticks(spark, sf_dir).withColumn("ds", F.col("ts").cast("date"))
    staged = materialize(bars(ticks, ["ds", "contract"]).withColumn("subject", F.lit("etf")))
    layout = Layout(_new_folder(spark, "lake"))
    for _ in range(2):
        load_subject(spark, layout, "etf", staged)
    index = warehouse_table(spark, layout, "index").select(
        F.col("id").alias("index_id"), F.col("name").alias("index_name"), "market"
    )
    derivative = warehouse_table(spark, layout, "derivative").withColumnRenamed("id", "derivative_id")
    detail = warehouse_table(spark, layout, "derivative_detail").select(
        F.col("id").alias("derivative_detail_id"), "derivative_id"
    )
    named = detail.join(derivative, "derivative_id").join(index, "index_id")
    return (
        warehouse_table(spark, layout, "derivative_detail_history")
        .join(named, "derivative_detail_id")
        .drop("index_id", "derivative_id", "subject")
    )
