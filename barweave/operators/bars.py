"""Open/high/low/close/mean/std/volume bars at several scales.

Every scale is a whole number of minutes, so ticks are read once into one-minute
states and the states, not the ticks, are expanded to the scales:

    ticks --hash agg--> states per (keys, minute) --x scales--> hash agg --> bars

Both aggregations combine on the map side, so a contract (or a single minute) that
holds a large share of all ticks reaches a reducer as one row per map task. All buffers
are fixed-width numbers, which keeps both steps on hash aggregation without a sort:

* First and last tick of a minute are found by one bigint: the offset inside the minute
  and the low ``LOW_BITS`` bits of ``seq``. The high bits of ``seq`` (the *run*) are a
  grouping key of the states and come back in the rank the second step orders by, so
  the order is exactly ``(ts, seq)``.
* Mean and deviation come from integer sums of prices in cents. A run holds at most
  ``2**LOW_BITS`` ticks, so no sum of a state can overflow, and the result does not
  depend on the order in which partial results meet.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barweave.functions.buckets import MICROS_PER_MINUTE, bar_end_micros, instant_micros
from barweave.schemas import MEAN, PRICE, SCALES

LOW_BITS = 28
RUN_BITS = 26
OFFSET_BITS = 26  # 60,000,000 < 2**26
MAX_SCALE = 1023  # minutes; ten bits of the rank
LIMB_BITS = 17  # |price in cents| < 10**10 < 2**34


def bars(
    ticks: DataFrame,
    keys: Sequence[str] = (),
    scales: Sequence[int] = SCALES,
    *,
    ts: str = "ts",
    price: str = "price",
    volume: str | None = "volume",
    seq: str = "seq",
    first_tick: Sequence[str] = (),
) -> DataFrame:
    """One row per (keys, scale, bar).

    ``seq`` is a bigint, unique among ticks of equal keys and ``ts``. ``first_tick``
    names further fixed-width columns whose value at the opening tick is wanted.
    Ticks without ``ts`` belong to no bar and are left out; a missing price counts for
    the volume and shows as a null open or close when it is the first or last one.
    """
    if not scales or min(scales) < 1 or max(scales) > MAX_SCALE:
        raise ValueError(f"scales must be 1 to {MAX_SCALE} minutes, got {list(scales)}")
    states = minute_states(
        ticks, keys, ts=ts, price=price, volume=volume, seq=seq, first_tick=first_tick
    )
    return _finish(_roll_up(states, keys, scales, volume is not None, first_tick), keys, volume)


def minute_states(
    ticks: DataFrame,
    keys: Sequence[str],
    *,
    ts: str = "ts",
    price: str = "price",
    volume: str | None = "volume",
    seq: str = "seq",
    first_tick: Sequence[str] = (),
) -> DataFrame:
    """Mergeable state per (keys, minute, run); columns of the state start with ``_``."""
    bound = 1 << (LOW_BITS + RUN_BITS - 1)
    error = f"column {seq} must be a number within +-2**{bound.bit_length() - 1}"
    carried = [*keys, *([volume] if volume is not None else []), *first_tick]
    wanted = {name: f"_at_{name}" if name in first_tick else name for name in carried}
    timed = ticks.where(F.col(ts).isNotNull()).select(
        *(F.col(name).alias(new) for name, new in wanted.items()),
        instant_micros(F.col(ts)).alias("_us"),
        F.expr(
            f"case when `{seq}` between {-bound} and {bound - 1} then cast(`{seq}` as bigint)"
            f" else raise_error('{error}') end as _seq"
        ),
        F.col(price).cast(PRICE).alias("_price"),
    )
    rows = timed.select(
        *wanted.values(),
        "_price",
        F.expr("cast(_price * 100 as bigint) as _cents"),
        bar_end_micros(F.col("_us"), 1).alias("_minute"),
        F.expr(f"shiftright(_seq, {LOW_BITS}) as _run"),
        F.expr(
            f"shiftleft({MICROS_PER_MINUTE} - pmod(-_us, {MICROS_PER_MINUTE}), {LOW_BITS})"
            f" | (_seq & {(1 << LOW_BITS) - 1}) as _ord"
        ),
    )
    high, low = f"shiftright(_cents, {LIMB_BITS})", f"(_cents & {(1 << LIMB_BITS) - 1})"
    aggregates = [
        "min(_ord) as _first",
        "max(_ord) as _last",
        "min_by(_price, _ord) as _open",
        "max(_price) as _high",
        "min(_price) as _low",
        "max_by(_price, _ord) as _close",
        "count(_cents) as _n",
        "sum(_cents) as _sum",
        f"sum({high} * {high}) as _hh",
        f"sum({high} * {low}) as _hl",
        f"sum({low} * {low}) as _ll",
    ]
    if volume is not None:
        aggregates.append(f"sum(`{volume}`) as _volume")
    aggregates += [f"min_by(`_at_{name}`, _ord) as `_at_{name}`" for name in first_tick]
    return rows.groupBy(*keys, "_minute", "_run").agg(*map(F.expr, aggregates))


def _rank(ordinal: str) -> str:
    """Minute inside the bar, offset inside the minute, run: in one bigint."""
    return (
        f"shiftleft(shiftleft(_position, {OFFSET_BITS}) | shiftright({ordinal}, {LOW_BITS}),"
        f" {RUN_BITS}) + (_run + {1 << (RUN_BITS - 1)})"
    )


def _roll_up(
    states: DataFrame,
    keys: Sequence[str],
    scales: Sequence[int],
    has_volume: bool,
    first_tick: Sequence[str],
    minutes: bool = False,
) -> DataFrame:
    """Merge the states of each bar; exact sums leave bigint only here.

    With ``minutes`` a bar also has ``_minutes``, bitmaps of the minutes in it that have ticks:
    64 minutes a word, the bar's first minute in the lowest bit.
    """
    squares = (
        f"cast(cast(_hh as decimal(38,0)) * {1 << (2 * LIMB_BITS)}"
        f" + cast(_hl as decimal(38,0)) * {1 << (LIMB_BITS + 1)}"
        " + cast(_ll as decimal(38,0)) as decimal(38,0)) as _squares"
    )
    expanded = states.select(
        "*",
        F.expr(squares),
        F.explode(F.array(*map(F.lit, scales))).alias("scale"),
    ).select("*", bar_end_micros(F.col("_minute"), F.col("scale")).alias("_end"))
    rows = expanded.select(
        "*", F.expr(f"scale - (_end - _minute) div {MICROS_PER_MINUTE} as _position")
    )
    aggregates = [
        f"min_by(_open, {_rank('_first')}) as price_open",
        "max(_high) as price_high",
        "min(_low) as price_low",
        f"max_by(_close, {_rank('_last')}) as price_close",
        "sum(_n) as _n",
        "sum(_sum) as _sum",
        "sum(_squares) as _squares",
    ]
    if has_volume:
        aggregates.append("sum(_volume) as volume")
    aggregates += [f"min_by(`_at_{name}`, {_rank('_first')}) as `{name}`" for name in first_tick]
    words = range((max(scales) - 1) // 64 + 1) if minutes else ()
    bit = "shiftleft(1L, cast((_position - 1) % 64 as int))"
    aggregates += [
        f"bit_or(if((_position - 1) div 64 = {w}, {bit}, 0L)) as _word{w}" for w in words
    ]
    rolled = rows.groupBy(*keys, "scale", "_end").agg(*map(F.expr, aggregates))
    if not minutes:
        return rolled
    names = [f"_word{w}" for w in words]
    return rolled.withColumn("_minutes", F.array(*names)).drop(*names)


def bars_with_minutes(ticks: DataFrame, keys: Sequence[str], scales: Sequence[int]) -> DataFrame:
    """Bars with ``minutes``: the ends of their minutes that have ticks, in microseconds."""
    states = minute_states(ticks, keys)
    rolled = _roll_up(states, keys, scales, True, (), minutes=True)
    ends = F.expr(
        f"""transform(filter(sequence(0, scale - 1), p -> bit_get(_minutes[p div 64], p % 64) = 1),
        p -> _end - (scale - 1 - p) * {MICROS_PER_MINUTE}L)"""
    )
    return _finish(rolled.withColumn("minutes", ends), keys, "volume")


def _finish(rolled: DataFrame, keys: Sequence[str], volume: str | None) -> DataFrame:
    extra = [c for c in rolled.columns if not c.startswith(("_", "price_"))]
    extra = [c for c in extra if c not in (*keys, "scale", "volume")]
    return rolled.select(
        *keys,
        "scale",
        F.timestamp_micros("_end").alias("datetime"),
        "price_open",
        "price_high",
        "price_low",
        "price_close",
        mean_price(F.col("_n"), F.col("_sum")).alias("price_mean"),
        sample_deviation(F.col("_n"), F.col("_sum"), F.col("_squares")).alias("price_std"),
        *(["volume"] if volume is not None else []),
        *extra,
    )


def mean_price(n: Column, cents: Column) -> Column:
    """Unweighted mean of ``n`` prices, rounded half up to six digits."""
    total = cents.cast("decimal(19,0)") * F.lit("0.01").cast("decimal(2,2)")
    return (total / F.nullif(n, F.lit(0)).cast("decimal(12,0)")).cast(MEAN)


def sample_deviation(n: Column, cents: Column, squares: Column) -> Column:
    """Sample standard deviation from exact sums; null below two prices.

    The subtraction is done on integers: at index level (18,000.00) the two terms agree
    in more digits than a double has.
    """
    wide = "decimal(38,0)"
    spread = n.cast("decimal(12,0)") * squares - cents.cast(wide) * cents.cast(wide)
    pairs = n.cast("double") * (n - 1).cast("double")
    return F.when(n > 1, F.sqrt(spread.cast("double") / pairs) / 100)
