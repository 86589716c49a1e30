"""Raw records of the four subjects to the common tick table, in UTC.

Each function takes raw text columns plus ``ds``, ``seq``, ``source_file`` and
``line_no``, and is narrow: no shuffle and no Python.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barweave.functions.buckets import floor_second
from barweave.functions.clock import day_label, exchange_time_to_utc
from barweave.functions.text import clock_time, to_count, to_price
from barweave.schemas import (
    ETF,
    ETF_TIME_FORMAT,
    FUTURES,
    FUTURES_CONTRACTS,
    INDEX,
    INDEX_NAME,
    INDEX_TIME_FORMAT,
    OPTIONS,
    OPTIONS_CONTRACTS,
    PRICE,
    TICKS,
    TRADE_TIME_FORMAT,
    Subject,
)


def _as_ticks(df: DataFrame, subject: Subject) -> DataFrame:
    """Tick schema in its column order; attributes the subject lacks are null."""
    df = df.withColumn("subject", F.lit(subject.name))
    return df.select(
        *(
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in TICKS
        )
    )


def normalize_index(raw: DataFrame, name: str = INDEX_NAME) -> DataFrame:
    """Index values. Lines without a clock time are headers and footers, not values."""
    values = raw.withColumn("time", clock_time(F.col("time"))).where(F.col("time") != "")
    return _as_ticks(
        values.withColumns(
            {
                "contract": F.lit(name),
                "ts": exchange_time_to_utc(
                    day_label(F.col("ds")), F.col("time"), INDEX_TIME_FORMAT
                ),
                "price": to_price(F.col("value")),
            }
        ),
        INDEX,
    )


def normalize_etf(raw: DataFrame) -> DataFrame:
    """ETF ticks; the fraction of a second is dropped."""
    return _as_ticks(
        raw.select(
            F.col("stock_id").alias("contract"),
            floor_second(
                exchange_time_to_utc(F.col("date"), F.col("Time"), ETF_TIME_FORMAT)
            ).alias("ts"),
            F.col("deal_price").try_cast(PRICE).alias("price"),
            F.col("volume").try_cast("int").alias("volume"),
            *(c for c in ("seq", "source_file", "line_no", "ds") if c in raw.columns),
        ),
        ETF,
    )


def only_contracts(raw: DataFrame, contracts: Sequence[str]) -> DataFrame:
    """Rows of the wanted contracts, whose padding is removed."""
    return raw.withColumn("contract", F.trim("contract")).where(F.col("contract").isin(*contracts))


def is_spread(expire: Column) -> Column:
    return F.contains(expire, F.lit("/"))


def unpack_spreads(trades: DataFrame) -> DataFrame:
    """Calendar spreads to their two legs; outright trades pass as they are.

    A spread on ``near/far`` with volume v trades v div 2 of either expiry at the leg's
    own price. A leg or trade without a price is dropped. Expects ``expire`` as text,
    ``price``, ``near_price``, ``far_price`` and ``volume`` as numbers.
    """
    spread = is_spread(F.col("expire"))
    prices = F.when(spread, F.array("near_price", "far_price")).otherwise(F.array("price"))
    legs = F.arrays_zip(F.split("expire", "/").alias("expire"), prices.alias("price"))
    volume = F.when(spread, F.expr("volume div 2").cast("int")).otherwise(F.col("volume"))
    kept = [c for c in trades.columns if c not in ("expire", "price", "near_price", "far_price")]
    return (
        trades.withColumn("volume", volume)
        .select(*kept, F.inline(legs).alias("expire", "price"))
        .where(F.col("price").isNotNull())
    )


def normalize_futures(
    raw: DataFrame, contracts: Sequence[str] = FUTURES_CONTRACTS
) -> DataFrame:
    """Outright and spread trades to ticks per expiry."""
    trades = only_contracts(raw, contracts).withColumns(
        {
            "expire": F.trim("expire"),
            "price": to_price(F.col("price")),
            "near_price": to_price(F.col("near_price")),
            "far_price": to_price(F.col("far_price")),
            "volume": to_count(F.col("volume")),
            "ts": _trade_time(),
        }
    )
    return _as_ticks(unpack_spreads(trades), FUTURES)


def normalize_options(
    raw: DataFrame, contracts: Sequence[str] = OPTIONS_CONTRACTS
) -> DataFrame:
    return _as_ticks(
        only_contracts(raw, contracts).withColumns(
            {
                "expire": F.trim("expire"),
                "strike_price": F.trim("strike_price"),
                "option_type": F.trim("option_type"),
                "price": to_price(F.col("price")),
                "volume": to_count(F.col("volume")),
                "ts": _trade_time(),
            }
        ),
        OPTIONS,
    )


def _trade_time() -> Column:
    return exchange_time_to_utc(F.trim("date"), F.trim("time"), TRADE_TIME_FORMAT)


def dropped_counts(
    subject: str,
    futures: Sequence[str] = FUTURES_CONTRACTS,
    options: Sequence[str] = OPTIONS_CONTRACTS,
) -> dict[str, Column]:
    """By cause, how many raw records (or legs of spreads) a normalizer leaves out, as aggregates."""
    contract = F.coalesce(F.trim("contract"), F.lit(""))
    if subject == "index":
        return {"no_clock_time": F.count_if(F.coalesce(clock_time(F.col("time")), F.lit("")) == "")}
    if subject == "options":
        return {"other_contract": F.count_if(~contract.isin(*options))}
    if subject == "futures":
        lacks = [to_price(F.col(c)).isNull().cast("int") for c in ("price", "near_price", "far_price")]
        legs = F.when(is_spread(F.col("expire")), lacks[1] + lacks[2]).otherwise(lacks[0])
        return {
            "other_contract": F.count_if(~contract.isin(*futures)),
            "legs_without_price": F.sum(F.when(contract.isin(*futures), legs).otherwise(0)),
        }
    return {}


NORMALIZERS = {
    "index": normalize_index,
    "etf": normalize_etf,
    "futures": normalize_futures,
    "options": normalize_options,
}
