"""Schemas of every table and the fixed values of the market data."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Scales, names, codes and patterns given by the data.
SCALES = (1, 5, 15, 30, 60)
INDEX_NAME = "TAIEX"
INDEX_MARKET = "TW"
FUTURES_CONTRACTS = ("TX", "MTX")
OPTIONS_CONTRACTS = ("TXO",)
EXPIRE_CODES = ("W", "M", "M+1", "M+2", "Q+1", "Q+2", "Q+3")
MAKE_UP_MEMO = "o"
EXCHANGE_OFFSET = "+08:00"
ROC_YEAR_OFFSET = 1911
INDEX_TIME_FORMAT = "yyyy_MM_dd HH:mm:ss"
ETF_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS"
TRADE_TIME_FORMAT = "yyyyMMdd HHmmss"
DAY_FORMAT = "yyyy_MM_dd"
CLOCK_PATTERN = r".*(\d{2}:\d{2}:\d{2})"
MONTH_DAY_PATTERN = r"(\d+)月(\d+)日"
SPREAD_PATTERN = r"([0-9W]+)/([0-9W]+)"
ARCHIVE_DAY_PATTERN = r"(\d{4}_\d{2}_\d{2})"
SPREAD_ARCHIVE_PATTERN = r"_C\.zip$"
# ---------------------------------------------------------------------------

PRICE = T.DecimalType(10, 2)
MEAN = T.DecimalType(14, 6)


def _struct(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(name, kind, nullable) for name, kind, nullable in fields])


def _text_struct(*names: str) -> T.StructType:
    return _struct(*((name, T.StringType(), True) for name in names))


# Raw records are read as text: a padded or dashed number must not spoil its row.
FUTURES_RAW = _text_struct(
    "date", "contract", "expire", "time", "price", "volume", "near_price", "far_price"
)
OPTIONS_RAW = _text_struct(
    "date", "contract", "strike_price", "expire", "option_type", "time", "price", "volume"
)
INDEX_RAW = _text_struct("time", "value")
HOLIDAY_RAW = _text_struct("name", "date", "weekday", "description", "memo")
ETF_RAW = _struct(
    (
        "data",
        T.ArrayType(
            _struct(
                ("date", T.StringType(), True),
                ("Time", T.StringType(), True),
                ("stock_id", T.StringType(), True),
                ("deal_price", T.DoubleType(), True),
                ("volume", T.LongType(), True),
            )
        ),
        True,
    )
)

# ``seq`` orders ticks of equal ``ts``; it is unique within a day of a subject.
TICKS = _struct(
    ("subject", T.StringType(), False),
    ("contract", T.StringType(), True),
    ("expire", T.StringType(), True),
    ("strike_price", T.StringType(), True),
    ("option_type", T.StringType(), True),
    ("ts", T.TimestampType(), True),
    ("price", PRICE, True),
    ("volume", T.IntegerType(), True),
    ("seq", T.LongType(), True),
    ("source_file", T.StringType(), True),
    ("line_no", T.LongType(), True),
    ("ds", T.DateType(), True),
)

# Least and greatest time of a subject's day in a history.
LANDED_FILES = _struct(
    ("subject", T.StringType(), True),
    ("year", T.IntegerType(), True),
    ("ds", T.DateType(), True),
    ("path", T.StringType(), True),
    ("length", T.LongType(), True),
    ("modified", T.TimestampType(), True),
    ("checksum", T.StringType(), True),
)

ZONES = _struct(
    ("subject", T.StringType(), True),
    ("year", T.IntegerType(), True),
    ("ds", T.DateType(), True),
    ("first", T.TimestampType(), True),
    ("last", T.TimestampType(), True),
)

_BAR_FIELDS = (
    ("scale", T.IntegerType(), True),
    ("datetime", T.TimestampType(), True),
    ("price_open", PRICE, True),
    ("price_high", PRICE, True),
    ("price_low", PRICE, True),
    ("price_close", PRICE, True),
    ("price_mean", MEAN, True),
    ("price_std", T.DoubleType(), True),
)
_VOLUME = (("volume", T.LongType(), True),)


@dataclass(frozen=True)
class Subject:
    """What differs between the four kinds of market data."""

    name: str
    derivative_type: str | None
    bar_keys: tuple[str, ...]
    label_expiry: bool
    has_volume: bool

    @property
    def staging_keys(self) -> tuple[str, ...]:
        if not self.label_expiry:
            return self.bar_keys
        return (*self.bar_keys[:2], "expire_code", *self.bar_keys[2:])

    @property
    def staging(self) -> T.StructType:
        """Column order of a day's staged bars."""
        keys = tuple((key, T.StringType(), True) for key in self.staging_keys)
        return _struct(*keys, *_BAR_FIELDS, *(_VOLUME if self.has_volume else ()))

    @property
    def required(self) -> tuple[str, ...]:
        """Columns that may hold no null; a single-tick bar has no deviation."""
        return tuple(name for name in self.staging.names if name != "price_std")


INDEX = Subject("index", None, (), False, False)
ETF = Subject("etf", "ETF", ("contract",), False, True)
FUTURES = Subject("futures", "Futures", ("contract", "expire"), True, True)
OPTIONS = Subject(
    "options", "Options", ("contract", "expire", "strike_price", "option_type"), True, True
)
SUBJECTS = {s.name: s for s in (INDEX, ETF, FUTURES, OPTIONS)}

# Bars of all subjects in one table; keys a subject lacks are null.
BARS = _struct(
    *((name, T.StringType(), True) for name in OPTIONS.staging_keys),
    *_BAR_FIELDS,
    *_VOLUME,
    ("subject", T.StringType(), True),
    ("ds", T.DateType(), True),
)

# Warehouse tables. Partition columns stand last, as the file layout has them.
INDEX_DIM = _struct(
    ("id", T.IntegerType(), False),
    ("name", T.StringType(), False),
    ("market", T.StringType(), False),
)
DERIVATIVE_DIM = _struct(
    ("id", T.IntegerType(), False),
    ("index_id", T.IntegerType(), False),
    ("name", T.StringType(), False),
    ("derivative_type", T.StringType(), False),
)
DETAIL_KEYS = ("derivative_id", "expire", "expire_code", "strike_price", "option_type")
DETAIL_DIM = _struct(
    ("id", T.IntegerType(), False),
    ("derivative_id", T.IntegerType(), False),
    *((name, T.StringType(), True) for name in DETAIL_KEYS[1:]),
)
_PARTITIONS = (("subject", T.StringType(), True), ("ds", T.DateType(), True))
INDEX_HISTORY = _struct(
    ("index_id", T.IntegerType(), False), *_BAR_FIELDS[1:], *_PARTITIONS, _BAR_FIELDS[0]
)
DETAIL_HISTORY = _struct(
    ("derivative_detail_id", T.IntegerType(), False),
    *_BAR_FIELDS[1:],
    *_VOLUME,
    *_PARTITIONS,
    _BAR_FIELDS[0],
)
