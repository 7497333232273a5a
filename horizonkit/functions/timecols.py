"""Time arithmetic on TIMESTAMP_NTZ columns that never consults the session
time zone (``date_trunc`` and large interval additions do, and shift wall-clock
values across daylight-saving transitions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _epoch() -> Column:
    return F.expr("timestamp_ntz'1970-01-01 00:00:00'")

# Grain names accepted wherever a ``step`` is expected.
STEPS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def step_seconds(step) -> int:
    if isinstance(step, str):
        return STEPS[step]
    return int(step)


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_us(ts) -> Column:
    return F.timestamp_diff("MICROSECOND", _epoch(), col(ts))


def epoch_seconds(ts) -> Column:
    """Whole seconds since 1970 (floored)."""
    return F.floor(epoch_us(ts) / F.lit(1_000_000))


def add_seconds(ts, seconds) -> Column:
    """``ts + seconds`` for a (possibly column-valued) number of seconds."""
    s = seconds if isinstance(seconds, Column) else F.lit(seconds)
    return col(ts) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), s.cast("decimal(18,6)"))


def add_steps(ts, n, step) -> Column:
    """``ts + n * step``; ``n`` may be a column."""
    s = step_seconds(step)
    n = n if isinstance(n, Column) else F.lit(n)
    if s % 86400 == 0:
        return F.timestamp_add("DAY", n * F.lit(s // 86400), col(ts))
    if s % 3600 == 0:
        return F.timestamp_add("HOUR", n * F.lit(s // 3600), col(ts))
    if s % 60 == 0:
        return F.timestamp_add("MINUTE", n * F.lit(s // 60), col(ts))
    return F.timestamp_add("SECOND", n * F.lit(s), col(ts))


def floor_ts(ts, step) -> Column:
    """Floor a TIMESTAMP_NTZ to a multiple of ``step`` since the epoch."""
    us = F.lit(step_seconds(step) * 1_000_000)
    rem = F.pmod(epoch_us(ts), us)
    return F.timestamp_add("MICROSECOND", -rem, col(ts))


def steps_between(a, b, step) -> Column:
    """Whole number of steps from ``a`` to ``b`` (b - a) / step."""
    return F.floor(F.timestamp_diff("SECOND", col(a), col(b)) / F.lit(step_seconds(step))).cast("long")


def day_of(ts) -> Column:
    """Midnight of the day, as TIMESTAMP_NTZ."""
    return col(ts).cast("date").cast("timestamp_ntz")


def season(ts) -> Column:
    m = F.month(col(ts))
    return (F.when(m.isin(12, 1, 2), "winter").when(m.isin(3, 4, 5), "spring")
            .when(m.isin(6, 7, 8), "summer").when(m.isin(9, 10, 11), "fall"))
