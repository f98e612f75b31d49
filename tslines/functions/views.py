"""Typed views of result cells, chosen from the column type when the plan is built."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tslines.functions import numbers, times
from tslines.functions.text import sql_name
from tslines.model import U64

_TEXT = (T.StringType, T.CharType, T.VarcharType)
_TIMES = (T.TimestampType, T.TimestampNTZType)


def _kind(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def _typed_null(kind: str) -> Column:
    return F.lit(None).cast(kind)


def as_f64(df: DataFrame, name: str) -> Column:
    """Number as DOUBLE: 32 and 64 bit widths only, NULL column for anything else.

    Unsigned 32-bit arrives as BIGINT and unsigned 64-bit as DECIMAL(20,0).
    """
    kind = _kind(df, name)
    wide = isinstance(kind, T.DoubleType | T.FloatType | T.LongType | T.IntegerType)
    return F.col(f"`{name}`").cast("double") if wide or kind == U64 else _typed_null("double")


def as_i64(df: DataFrame, name: str) -> Column:
    """Signed whole number or time as BIGINT; NULL column for unsigned and the rest."""
    kind = _kind(df, name)
    c = F.col(f"`{name}`")
    if isinstance(kind, T.LongType | T.IntegerType | T.ShortType | T.ByteType):
        return c.cast("bigint")
    return times.datetime_nanos(c) if isinstance(kind, _TIMES) else _typed_null("bigint")


def as_str(df: DataFrame, name: str) -> Column:
    text = isinstance(_kind(df, name), _TEXT)
    return F.col(f"`{name}`") if text else _typed_null("string")


def as_bool(df: DataFrame, name: str) -> Column:
    boolean = isinstance(_kind(df, name), T.BooleanType)
    return F.col(f"`{name}`") if boolean else _typed_null("boolean")


def is_null(df: DataFrame, name: str) -> Column:
    return F.col(f"`{name}`").isNull()


def display(df: DataFrame, name: str) -> Column:
    """Text for people: floats without exponent, binary as its length, NULL as `null`."""
    kind = _kind(df, name)
    c = F.col(f"`{name}`")
    if isinstance(kind, T.DoubleType):
        text = F.expr(numbers.float_display(sql_name(name)))
    elif isinstance(kind, T.FloatType):
        text = F.expr(numbers.float_display(sql_name(name), "float"))
    elif isinstance(kind, T.BinaryType):
        text = F.concat(F.octet_length(c).cast("string"), F.lit("b"))
    elif isinstance(kind, _TIMES):
        text = times.datetime_nanos(c).cast("string")
    else:
        text = c.cast("string")
    return F.coalesce(text, F.lit("null"))
