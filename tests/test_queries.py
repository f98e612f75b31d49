import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tslines.plans.queries import (
    by_time,
    count_where,
    in_range,
    latest,
    mean_since,
    parameter,
    register,
    show_measurements,
    since,
    sql,
    to_spark_markers,
)

TABLE = "time timestamp, time_ns bigint, basin string, level double, salt bigint, run bigint"


@pytest.fixture()
def water(spark):
    rows = [(dt.datetime.fromtimestamp(1_700_000_000 + i, dt.UTC), (1_700_000_000 + i) * 10**9, f"l{i % 3}", i / 2, i, i)
            for i in range(10)]
    df = spark.createDataFrame(rows, TABLE)
    register(spark, {"water": df})
    return df


def test_markers_outside_quotes_and_comments_only():
    text = """SELECT '$a' "$b" `$c` $d -- $e\n /* $f */ + $g_1, 'it''s $h', '\\'$i'"""
    assert to_spark_markers(text) == """SELECT '$a' "$b" `$c` :d -- $e\n /* $f */ + :g_1, 'it''s $h', '\\'$i'"""


def test_range_and_equality_by_parameters(spark, water):
    text = """
        SELECT * FROM "water"
        WHERE time >= $at - interval '25 minute' AND "basin" = $basin AND "run" = $nr
        ORDER BY time"""
    now = dt.datetime.fromtimestamp(1_700_000_060, dt.UTC)
    rows = sql(spark, text, {"basin": "l1", "nr": 4, "at": now, "extra": 1}).collect()
    assert [r.run for r in rows] == [4]


def test_quoted_names_setting_is_put_back(spark, water):
    spark.conf.set("spark.sql.ansi.doubleQuotedIdentifiers", "false")
    sql(spark, 'SELECT "level" FROM water')
    assert spark.conf.get("spark.sql.ansi.doubleQuotedIdentifiers") == "false"
    assert spark.sql('SELECT "text" AS t').first().t == "text"


def test_count_with_parameter_last_value_counts(spark, water):
    text = "SELECT COUNT(*) AS n FROM water WHERE basin = $l"
    assert sql(spark, text, [("l", "zz"), ("l", "l0")]).first().n == 4
    with pytest.raises(PySparkException, match="UNBOUND_SQL_PARAMETER"):
        sql(spark, text)


def test_parameter_text_is_never_sql(spark, water):
    text = "SELECT COUNT(*) AS n FROM water WHERE basin = $l"
    assert sql(spark, text, {"l": "l0' OR '1'='1"}).first().n == 0


def test_parameter_types(spark):
    row = sql(
        spark, "SELECT $a AS a, $b AS b, $c AS c, $d AS d, $e AS e, $f AS f, $g AS g",
        {"a": None, "b": True, "c": 2**63, "d": [1, 2], "e": {"k": "v"}, "f": 1.5, "g": "x"},
    ).first()
    assert (row.a, row.b, row.c, row.d, row.e, row.f, row.g) == (None, True, Decimal(2**63), [1, 2], {"k": "v"}, 1.5, "x")
    with pytest.raises(TypeError):
        parameter(object())


def test_only_sql_text(spark):
    with pytest.raises(ValueError, match="other"):
        sql(spark, "SHOW MEASUREMENTS", language="other")


def test_fixed_shapes(spark, water):
    now = 1_700_000_009 * 10**9
    assert since(now, hours=1, seconds=1) == now - 3601 * 10**9
    assert mean_since(water, "level", since(now, seconds=2)).first().mean == 4.25
    assert [r.run for r in latest(water, 5, ["run"]).collect()] == [9, 8, 7, 6, 5]
    assert [r.run for r in by_time(water).limit(2).collect()] == [0, 1]
    assert count_where(water, basin="l1", run=4).first().n == 1
    inside = water.where(in_range(F.col("time_ns"), now - 3 * 10**9, now))
    assert sorted(r.run for r in inside.collect()) == [6, 7, 8]
    assert water.where(in_range(F.col("time_ns"))).count() == 10
    names = spark.createDataFrame([("b",), ("a",), ("b",)], "measurement string")
    assert [r.measurement for r in show_measurements(names).collect()] == ["a", "b"]


def test_plans(spark, water, tmp_path):
    water.write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    assert "TakeOrderedAndProject" in plan(latest(stored, 3))
    scan = plan(mean_since(stored, "level", 5))
    assert "GreaterThan(time_ns,5)" in scan and "ReadSchema: struct<time_ns:bigint,level:double>" in scan
