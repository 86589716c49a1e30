"""Time buckets: right-closed bars labelled by their end."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_MINUTE = 60_000_000


def instant_micros(ts: Column) -> Column:
    """Microseconds since the epoch; a zoneless timestamp counts as UTC wall clock.

    The session time zone must be UTC (see ``session.pin_runtime``).
    """
    return F.unix_micros(ts.cast("timestamp"))


def bar_end_micros(micros: Column, minutes: Column | int) -> Column:
    """The next multiple of ``minutes`` at or after an instant."""
    width = F.lit(minutes).cast("bigint") * F.lit(MICROS_PER_MINUTE)
    return micros + F.pmod(-micros, width)


def round_up_minutes(ts: Column, minutes: Column | int) -> Column:
    """Label of the bar ``(end - minutes, end]`` that holds ``ts``."""
    return F.timestamp_micros(bar_end_micros(instant_micros(ts), minutes))


def floor_second(ts: Column) -> Column:
    return F.date_trunc("second", ts)
