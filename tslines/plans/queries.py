"""Queries over measurement tables: SQL text with named parameters, and the fixed shapes."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from datetime import date
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tslines.session import sql_conf

I64 = range(-(2**63), 2**63)

# Quoted text, quoted names and comments are skipped; `$name` outside them is a parameter.
_TOKEN = re.compile(
    r"""'(?:[^'\\]|\\.|'')*'|"(?:[^"]|"")*"|`(?:[^`]|``)*`|--[^\n]*|/\*.*?\*/|\$([A-Za-z_]\w*)""",
    re.S,
)

# Names in double quotes are part of the documented query style.
_QUOTED_NAMES = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.ansi.doubleQuotedIdentifiers": "true",
}


def register(spark: SparkSession, tables: Mapping[str, DataFrame]) -> None:
    """Make measurement tables known to SQL text by name."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def to_spark_markers(text: str) -> str:
    """`$name` markers as Spark's `:name`."""
    return _TOKEN.sub(lambda m: f":{m[1]}" if m[1] else m[0], text)


def parameter(value) -> object:
    """A parameter value as Spark takes it: scalars, lists and mappings."""
    if value is None or isinstance(value, bool | str | float | Decimal | date | Column):
        return value  # a datetime is a date too
    if isinstance(value, int):
        if value in I64:
            return value
        return Decimal(value)
    if isinstance(value, list | tuple):
        return F.array(*(_literal(v) for v in value))
    if isinstance(value, Mapping):
        return F.create_map(*(_literal(x) for kv in value.items() for x in kv))
    raise TypeError(f"no query parameter for a value of type {type(value).__name__}")


def _literal(value) -> Column:
    value = parameter(value)
    return value if isinstance(value, Column) else F.lit(value)


def sql(
    spark: SparkSession, text: str, params: Mapping | Iterable[tuple] = (), language: str = "sql"
) -> DataFrame:
    """Run SQL text with named parameters `$name`; the last value given for a name counts.

    Parameters travel as values, never as text. Only SQL text is accepted; the other
    documented query shapes are the functions below.
    """
    if language != "sql":
        raise ValueError(
            f"no text interface for {language!r}: use mean_since, show_measurements and latest"
        )
    values = {k: parameter(v) for k, v in dict(params).items()}
    with sql_conf(spark, _QUOTED_NAMES):
        return spark.sql(to_spark_markers(text), args=values)


def since(now_ns: int, **span) -> int:
    """Start of a relative time range: `now` less days, hours, minutes or seconds."""
    # Seconds per unit.
    units = {"days": 86_400, "hours": 3_600, "minutes": 60, "seconds": 1}
    return now_ns - sum(int(n * units[u] * 1_000_000_000) for u, n in span.items())


def in_range(time_ns: Column, start_ns: int | None = None, end_ns: int | None = None) -> Column:
    """start <= time < end on the whole-number time, which file readers can prune by."""
    condition = F.lit(True)
    if start_ns is not None:
        condition = time_ns >= F.lit(start_ns).cast("bigint")
    if end_ns is not None:
        below = time_ns < F.lit(end_ns).cast("bigint")
        condition = below if start_ns is None else condition & below
    return condition


def mean_since(table: DataFrame, field: str, start_ns: int, time: str = "time_ns") -> DataFrame:
    """Mean of a field over rows later than `start_ns`."""
    later = table.where(F.col(time) > F.lit(start_ns).cast("bigint"))
    return later.agg(F.avg(F.col(f"`{field}`")).alias("mean"))


def show_measurements(points: DataFrame) -> DataFrame:
    """Names of all measurements in order."""
    return points.select("measurement").distinct().orderBy("measurement")


def latest(table: DataFrame, n: int, ties: list[str] = (), time: str = "time_ns") -> DataFrame:
    """The n newest rows, newest first; `ties` orders rows of the same time."""
    return table.orderBy(F.col(time).desc(), *(F.col(f"`{t}`") for t in ties)).limit(n)


def by_time(table: DataFrame, ties: list[str] = (), time: str = "time_ns") -> DataFrame:
    """Rows in time order."""
    return table.orderBy(F.col(time), *(F.col(f"`{t}`") for t in ties))


def count_where(table: DataFrame, **equals) -> DataFrame:
    """Number of rows whose columns have the given values."""
    for name, value in equals.items():
        table = table.where(F.col(f"`{name}`") == _literal(value))
    return table.agg(F.count("*").alias("n"))
