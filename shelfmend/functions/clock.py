"""Date arithmetic. "Now" is always the ``as_of`` argument, never the wall clock."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col


def ts(moment: datetime) -> Column:
    """Timestamp literal without time zone, like the source system's dates."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def day(as_of: datetime, back: int = 0) -> datetime:
    """Midnight of ``as_of``, ``back`` days earlier."""
    return datetime(as_of.year, as_of.month, as_of.day) - timedelta(days=back)


def month_clock(as_of: datetime) -> datetime:
    """First of the month with the time of day kept: how the log stores its time column."""
    return as_of.replace(day=1, microsecond=0)


def joined_timestamp(date: Column | str, time: Column | str) -> Column:
    """Day of one column and time of day (to the second) of another; no time means midnight."""
    d, t = col(date), col(time)

    def part(unit) -> Column:
        return F.coalesce(unit(t), F.lit(0))

    return F.make_timestamp_ntz(
        F.year(d), F.month(d), F.dayofmonth(d), part(F.hour), part(F.minute), part(F.second)
    )


def elapsed_seconds(later: Column | str, earlier: Column | str) -> Column:
    """Whole seconds between two timestamps, without sign."""
    micros = F.timestamp_diff("MICROSECOND", col(earlier), col(later))
    return F.abs(micros).cast("bigint").__truediv__(F.lit(1_000_000)).cast("bigint")


def hms(seconds: Column) -> Column:
    """``HH:MM:SS`` of the seconds within a day; whole days are dropped."""
    s = seconds % F.lit(86_400)
    spelled = F.format_string(
        "%02d:%02d:%02d",
        F.floor(s / 3600).cast("int"),
        F.floor((s % 3600) / 60).cast("int"),
        (s % 60).cast("int"),
    )
    return F.when(seconds.isNotNull(), spelled)
