"""Small builders shared by the tests."""

from decimal import Decimal

from tslines.model import POINTS


def value(v, kind=None):
    """A union field value from a Python value; `kind` overrides the member."""
    kind = kind or {bool: "b", int: "i", float: "f", str: "s"}[type(v)]
    if kind == "u":
        v = Decimal(v)
    return {m: (v if m == kind else None) for m in "fiusb"}


def point(measurement, tags=None, fields=None, time=None, seq=None):
    """A row of the points table. Fields: name to value, or to (value, member)."""
    cells = [
        {"key": k, "value": value(*v) if isinstance(v, tuple) else value(v)}
        for k, v in (fields or {}).items()
    ]
    return (measurement, tags or {}, cells, time, seq)


def points(spark, *rows):
    return spark.createDataFrame(list(rows), POINTS)


def lines_of(df):
    return [r["lp"] for r in df.collect()]
