"""Epoch-nanosecond time: scaling, conversion, and the time column of a frame."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tslines.model import Precision


def whole_div(c: Column, n: int) -> Column:
    """Integer division that truncates toward zero, also before 1970."""
    return c if n == 1 else F.call_function("div", c, F.lit(n).cast("bigint"))


def scale_time(time_ns: Column, precision: Precision | str) -> Column:
    """Nanoseconds to the target precision.

    `unix_millis` and `unix_seconds` round down instead, which differs before 1970.
    """
    return whole_div(time_ns, Precision.parse(precision).nanos)


def to_nanos(raw: Column, precision: Precision | str) -> Column:
    """Time in `precision` units to nanoseconds; NULL when that overflows."""
    n = Precision.parse(precision).nanos
    return raw if n == 1 else F.try_multiply(raw, F.lit(n).cast("bigint"))


def micros(ts: Column) -> Column:
    """Microseconds since 1970 of TIMESTAMP or TIMESTAMP_NTZ (session zone must be UTC)."""
    return F.unix_micros(ts.cast("timestamp"))


def datetime_nanos(ts: Column) -> Column:
    """Datetime to nanoseconds; NULL outside the range a 64-bit count can hold."""
    return F.try_multiply(micros(ts), F.lit(1000).cast("bigint"))


def nanos_to_timestamp(time_ns: Column) -> Column:
    """Readable TIMESTAMP; drops digits below a microsecond."""
    # floor division, so that the timestamp never lies after the instant it stands for
    return F.timestamp_micros(
        F.call_function("div", time_ns - F.pmod(time_ns, F.lit(1000)), F.lit(1000))
    )


def frame_time(c: Column, kind: T.DataType, precision: Precision | str) -> Column | None:
    """Time column of a frame in output units, chosen from its type when planning.

    Whole numbers are taken to be in the target precision already, datetimes are scaled,
    and every other type means "no time".
    """
    if isinstance(kind, T.LongType | T.IntegerType):
        return c.cast("bigint")
    if isinstance(kind, T.DecimalType) and kind.scale == 0 and kind.precision == 20:
        # unsigned 64-bit: the upper half wraps into negative numbers
        half, full = F.lit(2**63 - 1), F.lit(str(2**64)).cast("decimal(21,0)")
        wrapped = F.when(c <= half.cast("decimal(20,0)"), c).otherwise(c - full)
        return wrapped.cast("bigint")
    if isinstance(kind, T.TimestampType | T.TimestampNTZType):
        return scale_time(datetime_nanos(c), precision)
    return None
