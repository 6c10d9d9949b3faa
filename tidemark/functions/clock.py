"""Event-time arithmetic on whole microseconds.

Operators compare times as longs, so results never depend on the session time
zone, and time zone-less columns stay zone-less from scan to result.
"""

from __future__ import annotations

from datetime import timedelta

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Span = str | timedelta

DAY_US = 86_400_000_000
_UTC_ZONES = {"UTC", "Etc/UTC", "Z", "GMT", "Etc/GMT"}


def span_us(span: Span) -> int:
    """Length of ``'15 minutes'`` or a ``timedelta`` in microseconds."""
    us = int(pd.Timedelta(span).value // 1000)
    if us < 0:
        raise ValueError(f"negative duration: {span}")
    return us


def micros(df: DataFrame, ts: str) -> Column:
    """Microseconds since the epoch of timestamp or date column ``ts``.

    A zone-less timestamp is read as UTC under every session zone, a date as its midnight there.
    """
    kind = df.schema[ts].dataType
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(ts)
    if isinstance(kind, T.DateType):
        return F.unix_date(ts).cast("bigint") * DAY_US
    if not isinstance(kind, T.TimestampNTZType):
        raise TypeError(f"{ts} must be a timestamp, not {kind.simpleString()}")
    if df.sparkSession.conf.get("spark.sql.session.timeZone") in _UTC_ZONES:
        return F.unix_micros(F.col(ts).cast("timestamp"))
    return F.expr(f"timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', `{ts}`)")


def from_micros(us: Column, like: T.DataType) -> Column:
    """The timestamp, or date, of type ``like`` that lies ``us`` microseconds after the epoch."""
    if isinstance(like, T.TimestampType):
        return F.timestamp_micros(us)
    if isinstance(like, T.DateType):
        return F.date_from_unix_date(floor_div(us, DAY_US).cast("int"))
    return F.expr("timestamp_ntz'1970-01-01 00:00:00'") + us * F.expr("interval '0.000001' second")


def floor_div(value: Column, width: int) -> Column:
    """Integer division rounding down, also before 1970."""
    width_col = F.lit(width).cast("bigint")
    return F.call_function("div", value - F.pmod(value, width_col), width_col)


def local_day(df: DataFrame, ts: str, utc_offset: Span) -> Column:
    """Calendar date of ``ts`` on a clock running ``utc_offset`` ahead of UTC."""
    days = floor_div(micros(df, ts) + F.lit(span_us(utc_offset)), 86_400_000_000)
    return F.date_from_unix_date(days.cast("int"))
