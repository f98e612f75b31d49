import gzip

from helpers import lines_of, point, points
from pyspark.sql import functions as F

from tslines.model import WriteOptions
from tslines.operators.batches import (
    assign_batches,
    compresses,
    frame_bodies,
    join_bodies,
    local_bodies,
)
from tslines.operators.encode import encode_points
from tslines.sources.sinks import pack_bodies, write_frame, write_lines, write_measurement, write_points


def test_five_points_in_batches_of_two(spark):
    df = points(spark, *(point("cpu", {"h": f"s{i}"}, {"v": float(i)}, seq=(0, i)) for i in range(5)))
    lines = encode_points(df, keep=["seq"]).select("seq.line", "lp")
    bodies = join_bodies(assign_batches(lines, ["line"], 2)).orderBy("batch_id").collect()
    assert [(b.n_points, b.body) for b in bodies] == [
        (2, "cpu,h=s0 v=0.0\ncpu,h=s1 v=1.0"),
        (2, "cpu,h=s2 v=2.0\ncpu,h=s3 v=3.0"),
        (1, "cpu,h=s4 v=4.0"),
    ]


def test_frame_batches_count_rows_before_dropping_empty_ones(spark):
    df = spark.createDataFrame([("a", 1, 10), ("b", None, 20), ("c", 3, 30)], "host string, v bigint, ts bigint")
    for size, want in ((0, ["m,host=a v=1i 10", "m,host=c v=3i 30"]), (2, ["m,host=a v=1i 10", "m,host=c v=3i 30"]),
                       (3, ["m,host=a v=1i 10\nm,host=c v=3i 30"])):
        bodies = frame_bodies(df, ["ts"], "m", ["host"], "ts", size).orderBy("batch_id")
        assert [b.body for b in bodies.collect()] == want


def test_numbering_is_dense_and_ordered_on_a_skewed_key(spark):
    df = spark.range(20_000).select((F.col("id") % 3).alias("k"), F.hash("id").alias("h"), "id")
    df = df.withColumn("k", F.when(F.col("k") < 2, F.lit(0)).otherwise(F.col("k")))
    rows = assign_batches(df, ["k", "h", "id"], 3000).orderBy("pos").collect()
    assert [r.pos for r in rows] == list(range(20_000))
    assert [(r.k, r.h, r.id) for r in rows] == sorted((r.k, r.h, r.id) for r in rows)
    assert all(r.batch_id == r.pos // 3000 for r in rows)


def test_numbering_has_no_single_partition_window(spark):
    df = assign_batches(spark.range(100), ["id"], 7)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SinglePartition" not in plan


def test_local_bodies_have_the_exact_size_and_need_no_shuffle(spark):
    lines = spark.range(0, 10_500, 1, 3).select(F.concat(F.lit("m v="), "id", F.lit("i")).alias("lp"))
    bodies = local_bodies(lines, 1000)
    plan = bodies._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    rows = bodies.collect()
    assert sorted(r.n_points for r in rows) == [500] * 3 + [1000] * 9
    assert len({r.batch_id for r in rows}) == 12
    assert sorted(x for r in rows for x in r.body.split("\n")) == sorted(lines_of(lines))


def test_local_bodies_of_nothing(spark):
    assert local_bodies(spark.createDataFrame([], "lp string")).count() == 0


def test_gzip_threshold(spark):
    df = spark.createDataFrame([("a" * 1024,), ("a" * 1025,), ("é" * 513,), ("",)], "body string")
    def decide(threshold):
        return [r[0] for r in df.select(compresses(F.col("body"), threshold)).collect()]
    assert decide(1024) == [False, True, True, False]
    assert decide(0) == [True, True, True, False]
    assert decide(None) == [False] * 4


def test_packed_bodies_read_back(spark):
    df = spark.createDataFrame([(0, "x" * 2000), (1, "short é")], "batch_id bigint, body string")
    long, short = pack_bodies(df).orderBy("batch_id").collect()
    assert long.gzipped and gzip.decompress(long.payload).decode() == long.body
    assert not short.gzipped and bytes(short.payload).decode() == short.body
    assert not any(r.gzipped for r in pack_bodies(df, None).collect())


def test_write_layouts(spark, tmp_path):
    df = points(spark, *(point("m", fields={"v": i}) for i in range(100))).coalesce(1)
    options = WriteOptions(batch_size=30)
    write_points(df, str(tmp_path / "bodies"), options)
    write_points(df, str(tmp_path / "files"), options, layout="files")
    stored = spark.read.parquet(str(tmp_path / "bodies")).collect()
    assert sorted(r.n_points for r in stored) == [10, 30, 30, 30]
    assert len(list((tmp_path / "files").glob("part-*"))) == 4
    frame = spark.range(10).toDF("v")
    write_frame(frame, str(tmp_path / "frame"), "m", options=options)
    assert spark.read.parquet(str(tmp_path / "frame")).agg(F.sum("n_points")).first()[0] == 10
    write_lines(spark.createDataFrame([("m v=1i",)], "lp string"), str(tmp_path / "gz"), gzip_files=True)
    assert list((tmp_path / "gz").glob("*.gz"))
    assert spark.read.text(str(tmp_path / "gz")).first().value == "m v=1i"


def test_a_failing_point_leaves_nothing_written(spark, tmp_path):
    df = points(spark, point("m", fields={"v": 1}), point("m"))
    try:
        write_points(df, str(tmp_path / "out"))
    except Exception as e:
        assert "no fields" in str(e)
    assert not list(tmp_path.glob("out/_SUCCESS"))


def test_layout_prunes_row_groups_and_splits_a_hot_tag(spark, tmp_path):
    table = spark.range(40_000).select(
        F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("h"), F.col("id") % 50)).alias("host"),
        F.col("id").alias("time_ns"), (F.col("id") * 2).alias("v"),
    )
    write_measurement(table, str(tmp_path / "m"), ["host"], partitions=8)
    stored = spark.read.parquet(str(tmp_path / "m"))
    files = stored.where("host = 'hot'").select("_metadata.file_path").distinct().count()
    assert files >= 3
    plan = stored.where("host = 'h7' and time_ns >= 100")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(host,h7)" in plan and "GreaterThanOrEqual(time_ns,100)" in plan


def test_payloads_follow_the_threshold_of_the_options(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("a" * 50, 2)], "t string, ts bigint").coalesce(1)
    for threshold, zipped in ((None, [False, False]), (20, [False, True]), (0, [True, True])):
        out = str(tmp_path / str(threshold))
        write_frame(df, out, "m", [], "ts", WriteOptions(batch_size=1, gzip_threshold=threshold), layout="payloads")
        rows = spark.read.parquet(out).orderBy("batch_id").collect()
        assert [r.gzipped for r in rows] == zipped
        texts = [gzip.decompress(r.payload) if r.gzipped else bytes(r.payload) for r in rows]
        assert texts == [b'm t="a" 1', b'm t="' + b"a" * 50 + b'" 2']
