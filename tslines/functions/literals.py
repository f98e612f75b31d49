"""Values as line-protocol text, chosen from the column type when the plan is built.

Like `numbers`, these take and return SQL expression text.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import types as T

from tslines.functions import numbers, text

UNSIGNED = "unsigned"  # column metadata key marking a whole-number column as unsigned

_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_TEXT = (T.StringType, T.CharType, T.VarcharType)
_NESTED = (T.ArrayType, T.MapType, T.StructType)


def is_unsigned(field: T.StructField, unsigned: Collection[str] = ()) -> bool:
    return field.name in unsigned or bool((field.metadata or {}).get(UNSIGNED))


def field_text(
    field: T.StructField, unsigned: Collection[str] = (), wide_int: Collection[str] = ()
) -> str:
    """Frame column as field text; NULL stays NULL.

    `unsigned` names whole-number columns that take the `u` suffix, `wide_int` names
    DECIMAL(p,0) columns that hold 128-bit integers.
    """
    v, kind = text.sql_name(field.name), field.dataType
    whole = isinstance(kind, _INTEGERS) or (isinstance(kind, T.DecimalType) and kind.scale == 0)
    if whole and is_unsigned(field, unsigned):
        return numbers.uint_text(v)
    if isinstance(kind, _INTEGERS) or (whole and field.name in wide_int):
        return numbers.int_text(v)
    if isinstance(kind, T.DoubleType):
        return numbers.f64_text(v)
    if isinstance(kind, T.FloatType):
        return numbers.f32_text(v)
    if isinstance(kind, T.BooleanType):
        return numbers.bool_text(v)
    if isinstance(kind, _TEXT):
        return text.sql_quoted(v)
    physical = _physical_integer(v, kind)
    return text.sql_quoted(_display(v, kind)) if physical is None else numbers.int_text(physical)


def _physical_integer(v: str, kind: T.DataType) -> str | None:
    """Count behind a temporal field: us, days, us and ns of the day."""
    if isinstance(kind, T.TimestampType | T.TimestampNTZType):
        return f"unix_micros(cast({v} as timestamp))"
    if isinstance(kind, T.DateType):
        return f"unix_date({v})"
    if isinstance(kind, T.DayTimeIntervalType):
        return f"unix_micros(timestamp_micros(0) + {v})"
    if isinstance(kind, T.TimeType):
        return f"cast(cast({v} as decimal(20,9)) * 1000000000 as bigint)"
    return None


def _display(v: str, kind: T.DataType) -> str:
    if isinstance(kind, T.BinaryType):
        return f"hex({v})"
    return f"to_json({v})" if isinstance(kind, _NESTED) else f"cast({v} as string)"


def tag_text(field: T.StructField) -> str:
    """Frame column as tag value text; NULL stays NULL and means "no such tag"."""
    shown = _display(text.sql_name(field.name), field.dataType)
    if isinstance(field.dataType, (*_INTEGERS, T.BooleanType, T.DateType)):
        return shown  # cannot hold a character that needs escaping
    return text.sql_escape_key(shown)


def value_text(v: str) -> str:
    """Union field value (struct `f,i,u,s,b`, one member set) as field text."""
    parts = (
        numbers.f64_text(f"{v}.f"),
        numbers.int_text(f"{v}.i"),
        numbers.uint_text(f"{v}.u"),
        text.sql_quoted(f"{v}.s"),
        numbers.bool_text(f"{v}.b"),
    )
    return f"coalesce({', '.join(parts)})"


def value_display(v: str) -> str:
    """Union field value for people: no suffix, no quotes, no escapes."""
    others = (f"cast({v}.{m} as string)" for m in "iusb")
    return f"coalesce({numbers.float_display(f'{v}.f')}, {', '.join(others)})"
