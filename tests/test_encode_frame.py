import datetime as dt
from decimal import Decimal

import pytest
from helpers import lines_of
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tslines.operators.encode import encode_frame
from tslines.sources.files import mark_unsigned


def encode(spark, rows, schema, *args, **kwargs):
    return lines_of(encode_frame(spark.createDataFrame(rows, schema), *args, **kwargs))


def test_types_escapes_and_time_pass_through(spark):
    got = encode(
        spark,
        [("dock,7", 'the "old" pier', 0.125, -31, False, 1234567890123)],
        "berth string, note string, draught double, tide bigint, open boolean, ts bigint",
        "port,north", ["berth"], "ts", "ms",
    )
    assert got == [
        r'port\,north,berth=dock\,7 note="the \"old\" pier",draught=0.125,tide=-31i,open=false 1234567890123'
    ]


def test_row_with_only_null_fields_is_dropped(spark):
    assert encode(spark, [(1.0, 100), (None, 200)], "v double, ts bigint", "m", [], "ts") == [
        "m v=1.0 100"
    ]


def test_null_tag_and_null_time(spark):
    got = encode(
        spark,
        [(None, 1, None), ("a", 2, 5)],
        "host string, v bigint, ts bigint", "m", ["host"], "ts",
    )
    assert got == ["m v=1i", "m,host=a v=2i 5"]


def test_empty_frame(spark):
    assert encode(spark, [], "v bigint", "m") == []


def test_narrow_types(spark):
    got = encode(
        spark, [(-32, 32, 2.5, 10)], "i32v int, u32v bigint, f32v float, ts bigint",
        "m", [], "ts", unsigned=["u32v"],
    )
    assert got == ["m i32v=-32i,u32v=32u,f32v=2.5 10"]


def test_unsigned_mark_travels_with_the_schema(spark):
    df = spark.createDataFrame([(Decimal(2**64 - 1),)], "v decimal(20,0)")
    assert lines_of(encode_frame(mark_unsigned(df, ["v"]), "m")) == ["m v=18446744073709551615u"]
    assert lines_of(encode_frame(df, "m")) == ['m v="18446744073709551615"']


def test_union_of_frames(spark):
    schema = "host string, v double, ts bigint"
    a = spark.createDataFrame([("a", 1.5, 10)], schema)
    b = spark.createDataFrame([("b", 2.5, 20)], schema)
    assert lines_of(encode_frame(a.union(b), "m", ["host"], "ts")) == [
        "m,host=a v=1.5 10",
        "m,host=b v=2.5 20",
    ]


def test_tags_in_caller_order_missing_skipped_repeated_repeat(spark):
    got = encode(
        spark, [("1", "2", 3)], "a string, b string, v int", "m", ["b", "gone", "a", "b"]
    )
    assert got == ["m,b=2,a=1,b=2 v=3i"]


def test_missing_time_column_means_no_time(spark):
    assert encode(spark, [(3,)], "v int", "m", [], "nope") == ["m v=3i"]


CELLS = [
    ("tinyint", -8, "-8i"),
    ("smallint", -16, "-16i"),
    ("int", -32, "-32i"),
    ("bigint", -64, "-64i"),
    ("float", 2.0, "2.0"),
    ("float", 2.5, "2.5"),
    ("float", 0.1, "0.1"),
    ("double", 4.0, "4.0"),
    ("double", 4.25, "4.25"),
    ("string", 'say "hi"', r'"say \"hi\""'),
    ("string", "owned", '"owned"'),
    ("boolean", False, "false"),
    ("date", dt.date(1970, 1, 8), "7i"),
    ("timestamp", dt.datetime(1970, 1, 1, 0, 0, 0, 42, tzinfo=dt.UTC), "42i"),
    ("timestamp_ntz", dt.datetime(1970, 1, 1, 0, 0, 0, 42), "42i"),
    ("interval day to second", dt.timedelta(microseconds=9), "9i"),
    ("decimal(10,2)", Decimal("1.50"), '"1.50"'),
    ("binary", b"\x01\xff", '"01FF"'),
    ("array<int>", [1, 2], '"[1,2]"'),
]


@pytest.mark.parametrize("kind, cell, text", CELLS)
def test_cell_text(spark, kind, cell, text):
    schema = T.StructType([T.StructField("v", T._parse_datatype_string(kind))])
    assert encode(spark, [(cell,)], schema, "m") == [f"m v={text}"]


def test_time_of_day_is_nanoseconds(spark):
    spark.conf.set("spark.sql.timeType.enabled", "true")
    df = spark.sql("SELECT TIME '00:00:01.000011' AS v")
    assert lines_of(encode_frame(df, "m")) == ["m v=1000011000i"]


@pytest.mark.parametrize("kind, bits", [("decimal(38,0)", 128)])
def test_wide_integers(spark, kind, bits):
    df = spark.createDataFrame([(Decimal(-128), Decimal(128))], f"a {kind}, b {kind}")
    line = lines_of(encode_frame(df, "m", wide_int=["a"], unsigned=["b"]))
    assert line == ["m a=-128i,b=128u"]


@pytest.mark.parametrize(
    "kind, cell, precision, text",
    [
        ("int", 32, "ns", " 32"),
        ("bigint", 64, "ms", " 64"),
        ("bigint", None, "ns", ""),
        ("decimal(20,0)", Decimal(2**64 - 1), "ns", " -1"),
        ("timestamp_ntz", dt.datetime(1970, 1, 1, 0, 0, 0, 1234), "us", " 1234"),
        ("timestamp_ntz", dt.datetime(1970, 1, 1, 0, 0, 0, 12000), "ns", " 12000000"),
        ("timestamp_ntz", dt.datetime(1970, 1, 1, 0, 0, 1, 234567), "ms", " 1234"),
        ("timestamp_ntz", dt.datetime(1969, 12, 31, 23, 59, 59, 998500), "ms", " -1"),
        ("string", "2024", "ns", ""),
        ("smallint", 3, "ns", ""),
        ("date", dt.date(2024, 1, 1), "ns", ""),
    ],
)
def test_time_column(spark, kind, cell, precision, text):
    got = encode(spark, [(1, cell)], f"v int, ts {kind}", "m", [], "ts", precision)
    assert got == ["m v=1i" + text]


def test_tag_values_of_other_types(spark):
    got = encode(
        spark,
        [(7, True, Decimal("1.5"), 1)],
        "a int, b boolean, c decimal(3,1), v int", "m", ["a", "b", "c"],
    )
    assert got == ["m,a=7,b=true,c=1.5 v=1i"]


def test_zone_less_columns_need_a_utc_session(spark):
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1))], "v int, ts timestamp_ntz")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        with pytest.raises(ValueError, match="no zone"):
            encode_frame(df, "m", [], "ts")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_wide_frames_match_narrow_ones(spark):
    n = 250
    cols = [
        F.when(F.col("id") % 3 != 0, (F.col("id") + i).cast("double") / 4).alias(f"f{i}")
        for i in range(n)
    ]
    wide = spark.range(6).select("id", *cols)
    got = lines_of(encode_frame(wide, "m", [], "id").orderBy("lp"))
    want = sorted(
        "m " + ",".join(f"f{i}={(r + i) / 4}" for i in range(n)) + f" {r}"
        for r in range(6)
        if r % 3
    )
    assert got == want


def test_plan_has_no_shuffle_and_pushes_null_tests(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).selectExpr("cast(id as string) h", "id v", "id t", "id unused").write.parquet(path)
    df = spark.read.parquet(path).drop("unused")
    plan = encode_frame(df, "m", ["h"], "t")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
    assert "IsNotNull(v)" in plan and "unused" not in plan
