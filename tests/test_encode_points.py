import pytest
from helpers import lines_of, point, points
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tslines.functions.literals import value_display
from tslines.model import Precision, RetryPolicy, WriteOptions
from tslines.operators.encode import check_newlines, encode_points
from tslines.operators.points import (
    points_from_frame,
    string_map,
    union_value,
    with_field,
    with_tag,
    with_time,
)

NS = 1_700_000_000_987_654_321


def one_line(spark, row, **options):
    return lines_of(encode_points(points(spark, row), WriteOptions(**options)))[0]


def test_every_value_type_in_field_order_with_sorted_tags(spark):
    row = point(
        "loom",
        {"shed": "east", "row": "9"},
        {"pull": 3.5, "picks": -12, "knots": (77, "u"), "idle": False, "yarn": "wool"},
        1_234_567_890_000_000_001,
    )
    assert one_line(spark, row) == (
        'loom,row=9,shed=east pull=3.5,picks=-12i,knots=77u,idle=false,yarn="wool"'
        " 1234567890000000001"
    )


def test_point_without_tags_and_time(spark):
    assert one_line(spark, point("m", fields={"v": 1})) == "m v=1i"


def test_point_without_fields_is_an_error(spark):
    with pytest.raises(PySparkException, match="no fields"):
        one_line(spark, point("x", {"k": "v"}))


def test_point_without_fields_can_be_rejected(spark):
    df = points(spark, point("x", {"k": "v"}), point("y", fields={"v": 1}))
    rows = encode_points(df, on_empty="reject").collect()
    assert [(r.lp, r.reject) for r in rows] == [(None, "no fields"), ("y v=1i", None)]


def test_escapes(spark):
    row = point("a b,c", {"x y=z": "1, 2"}, {"t": 'q "r" \\s'})
    assert one_line(spark, row) == (
        r"a\ b\,c,x\ y\=z=1\,\ 2 " + r't="q \"r\" \\s"'
    )


@pytest.mark.parametrize(
    "precision, text",
    [
        ("ns", "1700000000987654321"),
        ("us", "1700000000987654"),
        ("ms", "1700000000987"),
        ("s", "1700000000"),
    ],
)
def test_precision_on_the_line(spark, precision, text):
    assert one_line(spark, point("m", fields={"v": 1}, time=NS), precision=precision).endswith(
        " " + text
    )


def test_time_before_1970_truncates_toward_zero(spark):
    assert one_line(spark, point("m", fields={"v": 1}, time=-1500), precision="us") == "m v=1i -1"


def test_default_tags_and_tag_order(spark):
    row = point("m", {"host": "override", "z": "1", "a": "2"}, {"v": 1})
    line = one_line(
        spark, row, default_tags={"env": "prod", "host": "default"}, tag_order=("host", "z")
    )
    assert line == "m,host=override,z=1,a=2,env=prod v=1i"


def test_default_tags_on_a_point_without_tags(spark):
    row = ("m", None, point("m", fields={"v": 1})[2], None, None)
    assert one_line(spark, row, default_tags={"env": "prod"}) == "m,env=prod v=1i"


def test_tag_order_lists_absent_and_repeated_keys(spark):
    row = point("m", {"b": "1", "a": "2"}, {"v": 1})
    assert one_line(spark, row, tag_order=("zz", "b")) == "m,b=1,a=2 v=1i"


def test_tags_sort_by_bytes(spark):
    row = point("m", {"é": "1", "z": "2", "Z": "3", "\U0001f600": "4", "￮": "5"}, {"v": 1})
    assert one_line(spark, row) == "m,Z=3,z=2,é=1,￮=5,\U0001f600=4 v=1i"


def test_last_value_of_a_repeated_key_wins_in_first_place(spark):
    df = points(spark, point("m", {"host": "first", "a": "1"}, {"v": 1, "w": 5}))
    df = with_tag(df, "host", "second")
    df = with_field(df, "v", union_value("i", F.lit(2)))
    df = with_field(df, "new", union_value("b", F.lit(True)))
    row = encode_points(df, keep=["tags"]).first()
    assert row.lp == "m,a=1,host=second v=2i,w=5i,new=true"
    assert list(row.tags) == ["host", "a"]


def test_repeated_constant_keys(spark):
    df = spark.range(1).select(
        string_map([("h", F.lit("1")), ("a", F.lit("x")), ("h", F.lit("2"))]).alias("t")
    )
    assert list(df.first().t.items()) == [("h", "2"), ("a", "x")]


def test_points_from_frame_widens_and_skips_nulls(spark):
    df = spark.createDataFrame(
        [("a", 0.1, 7, None, True, 5), (None, 0.5, 8, "x", None, 6)],
        "host string, f float, u int, s string, b boolean, t bigint",
    )
    pts = points_from_frame(
        df, "m", ["host"], F.col("t") * 10, fields=["f", "u", "s", "b"], unsigned=["u"]
    )
    assert lines_of(encode_points(pts)) == [
        "m,host=a f=0.10000000149011612,u=7u,b=true 50",
        'm f=0.5,u=8u,s="x" 60',
    ]


def test_with_time_from_datetime_out_of_range_has_no_time(spark):
    df = points(spark, point("m", fields={"v": 1}))
    near = with_time(df, F.lit("2024-01-01 00:00:00").cast("timestamp"))
    far = with_time(df, F.lit("2300-01-01 00:00:00").cast("timestamp"))
    assert near.first().time_ns == 1_704_067_200_000_000_000
    assert far.first().time_ns is None


def test_value_display(spark):
    df = points(
        spark,
        point("m", fields={"a": 1.0, "b": 0.1, "c": 1e21, "d": 2, "e": (3, "u"), "f": "x", "g": True}),
    )
    shown = df.select(F.expr(f"transform(fields, f -> {value_display('f.value')})").alias("d")).first()
    assert shown.d == ["1", "0.1", "1" + "0" * 21, "2", "3", "x", "true"]


def test_empty_input(spark):
    assert encode_points(points(spark)).count() == 0


def test_line_breaks_are_kept_or_refused(spark):
    lines = encode_points(points(spark, point("m", fields={"v": "a\nb"})))
    assert lines_of(check_newlines(lines)) == ['m v="a\nb"']
    with pytest.raises(PySparkException, match="line break"):
        check_newlines(lines, "error").collect()


def test_line_breaks_in_tags_and_comment_names_are_refused(spark):
    for bad in (point("m", {"h": "a\nb"}, {"v": 1}), point("#m", fields={"v": 1}), point("a\nb", fields={"v": 1})):
        with pytest.raises(PySparkException, match="line break inside a name|starts with #"):
            check_newlines(encode_points(points(spark, bad))).collect()
        assert lines_of(check_newlines(encode_points(points(spark, bad)), "keep"))
    with pytest.raises(ValueError):
        check_newlines(encode_points(points(spark)), "sometimes")


def test_precision_names():
    for name in ("nanosecond", "ns"):
        assert Precision.parse(name) is Precision.NS
    for name in ("microsecond", "us", "µs"):
        assert Precision.parse(name) is Precision.US
    for name in ("millisecond", "ms"):
        assert Precision.parse(name) is Precision.MS
    for name in ("second", "s"):
        assert Precision.parse(name) is Precision.S
    for p in Precision:
        assert Precision.parse(p.wire_name) is p
    with pytest.raises(ValueError, match="unknown precision: minute"):
        Precision.parse("minute")


def test_option_defaults_and_checks():
    o = WriteOptions()
    assert (o.batch_size, o.max_inflight, o.gzip_threshold, o.precision) == (5000, 4, 1024, Precision.NS)
    assert o.accept_partial and o.default_tags == {} and o.tag_order == ()
    assert WriteOptions(batch_size=0, max_inflight=0).batch_size == 1
    assert o.default_tag("a", "1").default_tag("b", "2").default_tags == {"a": "1", "b": "2"}
    assert o.with_(precision="ms").precision is Precision.MS
    with pytest.raises(ValueError):
        WriteOptions(batch_size=-1)
    with pytest.raises(ValueError):
        WriteOptions(precision="hour")


def test_retry_policy_defaults():
    p = RetryPolicy()
    assert (p.max_retries, p.base_delay_ms, p.max_delay_ms, p.multiplier) == (3, 250, 30000, 2.0)
    assert p.honor_retry_after and p.max_elapsed_ms is None
    assert RetryPolicy.disabled().max_retries == 0
