"""Time conversions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def from_epoch_seconds(col: Column) -> Column:
    """Epoch seconds -> event time (TIMESTAMP_NTZ: wall clock = UTC, no zone shift)."""
    return micros_to_ts(col.cast("bigint") * F.lit(1_000_000))


def from_epoch_millis(col: Column) -> Column:
    return micros_to_ts(col.cast("bigint") * F.lit(1_000))


def to_event_time(col: Column) -> Column:
    """Watermarks need TIMESTAMP (LTZ); with session zone UTC the value is unchanged."""
    return col.cast("timestamp")


def business_day(ts: Column, utc_offset_hours: int = 8) -> Column:
    """Calendar day of ``ts`` (UTC wall clock) in a fixed-offset business zone."""
    return F.to_date(ts + F.make_dt_interval(F.lit(0), F.lit(utc_offset_hours)))


def seconds(n: float) -> Column:
    """A day-time interval literal of ``n`` seconds (fractions allowed)."""
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(n))


def interval_literal(us: int) -> Column:
    """A day-time interval *literal* of ``us`` microseconds (sign allowed).

    Stream-stream joins read state-eviction bounds only from literal
    intervals, so range conditions use this rather than ``seconds``.
    """
    return F.expr(f"INTERVAL '{us / 1_000_000:.6f}' SECOND")


_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def epoch_micros(ts: Column) -> Column:
    """Microseconds since the epoch of a wall-clock timestamp (zone independent)."""
    return F.timestamp_diff(
        "MICROSECOND", F.expr(_EPOCH_NTZ), ts.cast("timestamp_ntz")
    )


def floor_div(x: Column, n: int | Column) -> Column:
    """Integer division rounded down, exact for all longs (no detour through DOUBLE)."""
    n = F.lit(n) if isinstance(n, int) else n
    return F.call_function("div", x - F.pmod(x, n), n)


def micros_to_ts(micros: Column) -> Column:
    """Inverse of ``epoch_micros``: TIMESTAMP_NTZ."""
    return F.timestamp_add("MICROSECOND", micros, F.expr(_EPOCH_NTZ))


def render_window_end(col: Column) -> Column:
    """P5: display form of a window end (``yyyy-MM-dd HH:mm:ss.S``)."""
    return F.date_format(col, "yyyy-MM-dd HH:mm:ss.S")
