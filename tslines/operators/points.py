"""Building canonical points (long form) from columns or wide frames."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tslines.functions import times
from tslines.functions.literals import is_unsigned
from tslines.model import FIELD, U64, VALUE, VALUE_TYPES

Pairs = Mapping | Iterable[tuple]


def union_value(member: str, c: Column) -> Column:
    """Field value struct with one member set."""
    return F.struct(
        *(
            (c if name == member else F.lit(None)).cast(kind).alias(name)
            for name, kind in VALUE_TYPES.items()
        )
    )


def value_member(field: T.StructField, unsigned=()) -> str:
    """Which union member a column type is stored in."""
    kind = field.dataType
    if isinstance(kind, T.ByteType | T.ShortType | T.IntegerType | T.LongType):
        return "u" if is_unsigned(field, unsigned) else "i"
    if kind == U64 and is_unsigned(field, unsigned):
        return "u"
    if isinstance(kind, T.DoubleType | T.FloatType):
        return "f"  # FLOAT is widened here, unlike on the frame path
    if isinstance(kind, T.BooleanType):
        return "b"
    if isinstance(kind, T.StringType | T.CharType | T.VarcharType):
        return "s"
    raise TypeError(f"no field value type for column {field.name}: {kind.simpleString()}")


def string_map(pairs: Pairs) -> Column:
    """Tag map from constant keys and value columns; a NULL value leaves the tag out.

    A key given twice keeps its first place and its last value.
    """
    tags = dict(pairs.items() if isinstance(pairs, Mapping) else pairs)
    if not tags:
        return F.create_map().cast("map<string,string>")
    entries = [F.lit(part) if i % 2 == 0 else part for kv in tags.items() for i, part in enumerate(kv)]
    return F.map_filter(F.create_map(*entries), lambda _, v: v.isNotNull())


def field_array(pairs: Pairs) -> Column:
    """Field array from constant keys and union values; NULL values are left out.

    A key given twice keeps its first place and its last value.
    """
    fields = dict(pairs.items() if isinstance(pairs, Mapping) else pairs)
    items = [F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in fields.items()]
    present = F.filter(F.array(*items), lambda f: ~_is_empty(f["value"])) if items else F.array()
    return present.cast(T.ArrayType(FIELD))


def _is_empty(value: Column) -> Column:
    return F.coalesce(*(F.when(value[m].isNotNull(), True) for m in VALUE_TYPES)).isNull()


def points_from_frame(
    df: DataFrame,
    measurement: str | Column,
    tags: Pairs | list[str] = (),
    time: Column | None = None,
    fields: list[str] | None = None,
    unsigned=(),
    seq: Column | None = None,
) -> DataFrame:
    """Wide frame to points.

    `tags` is a list of column names or pairs of key and column; `fields` defaults to every
    other column. `time` must be nanoseconds already (see `functions.times`).
    """
    if not isinstance(tags, Mapping):
        tags = [(t, F.col(f"`{t}`")) if isinstance(t, str) else t for t in tags]
    tag_pairs = dict(tags)
    names = fields if fields is not None else [c for c in df.columns if c not in tag_pairs]
    schema = {f.name: f for f in df.schema.fields}
    values = {
        name: union_value(value_member(schema[name], unsigned), F.col(f"`{name}`"))
        for name in names
    }
    null_seq = F.lit(None).cast("struct<batch:bigint,line:bigint>")
    return df.select(
        (F.lit(measurement) if isinstance(measurement, str) else measurement).alias("measurement"),
        string_map({k: c.cast("string") for k, c in tag_pairs.items()}).alias("tags"),
        field_array(values).alias("fields"),
        (F.lit(None) if time is None else time).cast("bigint").alias("time_ns"),
        (null_seq if seq is None else seq).alias("seq"),
    )


def with_tag(points: DataFrame, key: str, value: Column | str) -> DataFrame:
    """Add a tag to every point, or replace it where it stands."""
    v = F.lit(value) if isinstance(value, str) else value
    replaced = F.transform_values("tags", lambda k, old: F.when(k == key, v).otherwise(old))
    added = F.map_concat("tags", F.create_map(F.lit(key), v))
    return points.withColumn(
        "tags", F.when(F.map_contains_key("tags", key), replaced).otherwise(added)
    )


def with_field(points: DataFrame, key: str, value: Column) -> DataFrame:
    """Add a field to every point, or replace its value where it stands."""
    new = F.struct(F.lit(key).alias("key"), value.cast(VALUE).alias("value"))
    replaced = F.transform("fields", lambda f: F.when(f["key"] == key, new).otherwise(f))
    return points.withColumn(
        "fields",
        F.when(F.exists("fields", lambda f: f["key"] == key), replaced).otherwise(
            F.concat("fields", F.array(new))
        ),
    )


def with_time(points: DataFrame, time: Column) -> DataFrame:
    """Set the time from a datetime column or from nanoseconds."""
    kind = points.select(time.alias("t")).schema["t"].dataType
    if isinstance(kind, T.TimestampType | T.TimestampNTZType):
        time = times.datetime_nanos(time)
    return points.withColumn("time_ns", time.cast("bigint"))
