import datetime as dt
from decimal import Decimal

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tslines.functions import views
from tslines.operators.encode import encode_frame
from tslines.operators.results import (
    UnsupportedType,
    as_map,
    column_names,
    iter_rows,
    map_batches,
    normalize,
    num_rows,
)
from tslines.sources.files import points_from_rows, read_csv, read_parquet

METRICS = "time timestamp, host string, usage double, count bigint, active boolean"


def metrics(spark):
    def at(s):
        return dt.datetime.fromtimestamp(1_700_000_000 + s, dt.UTC)

    one = spark.createDataFrame([(at(0), "srv1", 42.5, 100, True), (at(1), "srv2", 13.7, 200, False)], METRICS)
    return one.union(one)


def test_rows_over_several_batches(spark):
    df = normalize(metrics(spark))
    assert column_names(df) == ["time", "host", "usage", "count", "active"] and num_rows(df) == 4
    rows = list(iter_rows(df))
    assert rows[0]["time"] == 1_700_000_000_000_000_000 and rows[1][1] == "srv2"
    assert as_map(metrics(spark)).first().row == {
        "time": "1700000000000000000", "host": "srv1", "usage": "42.5", "count": "100", "active": "true",
    }


def test_every_type(spark, tmp_path):
    table = pa.table(
        {
            "b": pa.array([True]), "i8": pa.array([-8], pa.int8()), "i16": pa.array([-16], pa.int16()),
            "i32": pa.array([-32], pa.int32()), "i64": pa.array([-64], pa.int64()),
            "u8": pa.array([8], pa.uint8()), "u16": pa.array([16], pa.uint16()),
            "u32": pa.array([32], pa.uint32()), "u64": pa.array([2**64 - 1], pa.uint64()),
            "f32": pa.array([1.5], pa.float32()), "f64": pa.array([2.5]),
            "s": pa.array(["x"]), "ls": pa.array(["y"], pa.large_string()),
            "raw": pa.array([b"ab"]), "lraw": pa.array([b"abc"], pa.large_binary()),
            "ms": pa.array([1], pa.timestamp("ms")), "us": pa.array([1], pa.timestamp("us")),
            "dec": pa.array([Decimal("123.40")]),
            "dict": pa.array(["alpha"]).dictionary_encode(), "none": pa.array([None], pa.date32()),
        }
    )
    pq.write_table(table, tmp_path / "t.parquet")
    df = read_parquet(spark, str(tmp_path / "t.parquet"))
    row = normalize(df, unsigned=("u64",)).first().asDict()
    assert row == {
        "b": True, "i8": -8, "i16": -16, "i32": -32, "i64": -64, "u8": 8, "u16": 16, "u32": 32,
        "u64": Decimal(2**64 - 1), "f32": 1.5, "f64": 2.5, "s": "x", "ls": "y", "raw": b"ab",
        "lraw": b"abc", "ms": 1_000_000, "us": 1_000, "dec": "123.40", "dict": "alpha", "none": None,
    }
    assert as_map(df.select("raw", "lraw", "none")).first().row == {"raw": "2b", "lraw": "3b", "none": "null"}


@pytest.mark.parametrize("kind, cell", [("date", dt.date(2024, 1, 1)), ("array<int>", [1]), ("map<string,int>", {"a": 1})])
def test_unsupported_types(spark, kind, cell):
    df = spark.createDataFrame([(cell,)], f"v {kind}")
    with pytest.raises(PySparkException, match="unsupported data type"):
        normalize(df).collect()
    with pytest.raises(UnsupportedType, match=kind.split("<")[0]):
        normalize(df, strict=True)
    assert normalize(df.select(F.lit(None).cast(kind).alias("v"))).first().v is None


def test_views(spark):
    df = spark.sql(
        "SELECT 42L AS i64, 42 AS i32, 4Y AS i8, timestamp_micros(123) AS t, 'hi' AS s, "
        "CAST(NULL AS STRING) AS n, CAST(1.5 AS FLOAT) AS f32, 7BD AS u, true AS b"
    ).withColumn("u", F.col("u").cast("decimal(20,0)"))

    def value(view, c):
        return df.select(view(df, c)).first()[0]

    assert [value(views.as_f64, c) for c in ("i64", "i32", "i8", "f32", "u", "s")] == [42.0, 42.0, None, 1.5, 7.0, None]
    assert [value(views.as_i64, c) for c in ("i32", "i8", "t", "u", "f32")] == [42, 4, 123_000, None, None]
    assert value(views.as_str, "s") == "hi" and value(views.as_str, "b") is None
    assert value(views.as_bool, "b") is True and value(views.as_bool, "s") is None
    assert value(views.is_null, "n") is True and value(views.is_null, "s") is False
    assert [value(views.display, c) for c in ("i64", "s", "n", "f32", "t")] == ["42", "hi", "null", "1.5", "123000"]


def test_batches_on_the_executors(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        def count(batch):
            return pa.record_batch([pa.array([batch.num_rows]), pa.array([pc.sum(batch["id"]).as_py()])], ["n", "s"])

        rows = map_batches(spark.range(0, 95, 1, 2), count, "n bigint, s bigint").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert max(r.n for r in rows) <= 10 and sum(r.s for r in rows) == sum(range(95))


def test_sources(spark, tmp_path):
    (tmp_path / "a.csv").write_text("host,v,ts\na,1.5,10\n")
    df = read_csv(spark, str(tmp_path / "a.csv"), "host string, v double, ts bigint")
    assert encode_frame(df, "m", ["host"], "ts").first().lp == "m,host=a v=1.5 10"
    fields = [{"key": "v", "value": {"f": None, "i": 1, "u": None, "s": None, "b": None}}]
    assert points_from_rows(spark, [("m", {}, fields, None, None)]).count() == 1
