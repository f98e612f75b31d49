"""Where the named queries are collected."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tslines.session import prepare

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The tables of one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = prepare(spark)
        self.folder = folder

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))


def named(name: str, oracle: str | None = None):
    """Register a function of `Tables` as a query, with the SQL that must give the same."""

    def register(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        def query(spark: SparkSession, folder: str) -> DataFrame:
            return fn(Tables(spark, folder))

        query.__name__ = name
        query.__doc__ = fn.__doc__
        QUERIES[name] = query
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


# SQL pieces shared by the oracles. `regexp_replace` takes a backslash as `\\` there.
def sql_key(c: str) -> str:
    return rf"regexp_replace({c}, '([,= ])', '\\\1', 'g')"


def sql_measurement(c: str) -> str:
    return rf"regexp_replace({c}, '([, ])', '\\\1', 'g')"


def sql_quoted(c: str) -> str:
    return rf"""'"' || regexp_replace({c}, '(["\\])', '\\\1', 'g') || '"'"""


def sql_ns(c: str) -> str:
    return f"(epoch_us({c}) * 1000)"


# One event as line protocol: every column a field but the two tags and the time.
EVENT_LINE = (
    f"'events,event_type=' || {sql_key('event_type')} || ',user_id=' || user_id"
    f" || ' event_id=' || event_id || 'i,value=' || CAST(value AS VARCHAR)"
    f" || ',props=' || {sql_quoted('props')} || ' ' || {sql_ns('ts')}"
)
EVENT_TAGS = ["event_type", "user_id"]


def event_lines(t: Tables, **kwargs) -> DataFrame:
    from tslines.operators.encode import encode_frame

    return encode_frame(t.events, "events", EVENT_TAGS, "ts", **kwargs)
