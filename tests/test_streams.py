import datetime as dt

from helpers import lines_of
from pyspark.sql import functions as F

from tslines import session
from tslines.operators.decode import explode_lines
from tslines.operators.encode import encode_frame
from tslines.session import sql_conf
from tslines.streaming import streams

FRAME = "host string, v bigint, ts bigint"


def test_stream_of_rows_to_lines(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1, 10), ("b", None, 20)], FRAME)
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(FRAME).parquet(str(tmp_path / "in"))
    lines = encode_frame(stream, "m", ["host"], "ts")
    for _ in range(2):  # the second run finds nothing new
        streams.run_available(streams.write_lines_stream(lines, str(tmp_path / "out"), str(tmp_path / "cp")))
    assert [r.value for r in spark.read.text(str(tmp_path / "out")).collect()] == ["m,host=a v=1i 10"]


def types(spark):
    return spark.createDataFrame([("m", "v", "i")], "measurement string, key string, type string")


def test_ingest_over_several_epochs(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    paths = [str(tmp_path / n) for n in ("points", "rejects", "cp")]
    bodies = streams.read_bodies_stream(spark, str(source), files_per_trigger=1)
    (source / "a.lp").write_text("m v=1i 1\nm v=2.5 2\n")
    streams.run_available(streams.ingest_stream(bodies, types(spark), *paths))
    (source / "b.lp").write_text("bad\nm v=3i 3")
    (source / "c.lp").write_text("m v=4i 4")
    streams.run_available(streams.ingest_stream(bodies, types(spark), *paths))
    points = spark.read.parquet(paths[0])
    assert sorted((r.epoch, r.time_ns) for r in points.collect())[0] == (0, 1)
    assert sorted(r.time_ns for r in points.collect()) == [1, 3, 4]
    assert points.select("epoch").distinct().count() == 3
    rejects = spark.read.parquet(paths[1]).collect()
    assert sorted((r.line, r.message) for r in rejects) == [(1, "cannot be parsed"), (2, "type conflict on v")]


def test_replayed_epoch_leaves_one_result(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.lp").write_text("m v=1i 1")
    paths = [str(tmp_path / n) for n in ("points", "rejects")]
    for checkpoint in ("cp1", "cp2"):  # a lost checkpoint runs epoch 0 again
        bodies = streams.read_bodies_stream(spark, str(source))
        writer = streams.ingest_stream(bodies, types(spark), *paths, str(tmp_path / checkpoint))
        streams.run_available(writer)
    assert spark.read.parquet(paths[0]).count() == 1


def test_files_in_blocks_give_what_whole_files_give(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    settings = {"spark.sql.files.maxPartitionBytes": "400", "spark.sql.files.openCostInBytes": "0"}
    breaks = "".join(f'm s="{i}\n, \\"x\\" m v=1i\n",v={i}i {i}\n# no\n\n' for i in range(20))
    texts = {"a b.lp": "m v=1i 1\r\nm v=2.5 2\nbad\n", "c.lp": breaks, "empty.lp": "", "d.lp": "m v=3i 3"}
    for name, text in texts.items():
        (source / name).write_bytes(text.encode())
    known = spark.createDataFrame([("m", "v", "i"), ("m", "s", "s")], "measurement string, key string, type string")
    seen = {}
    for kind in ("whole", "blocks"):
        paths = [str(tmp_path / f"{kind}-{n}") for n in ("points", "rejects", "cp")]
        with sql_conf(spark, settings):
            if kind == "whole":
                writer = streams.ingest_stream(streams.read_bodies_stream(spark, str(source)), known, *paths, multiline=True)
            else:
                names = streams.read_names_stream(spark, str(source), bytes_per_trigger=1)
                writer = streams.ingest_names_stream(names, known, *paths, multiline=True)
            streams.run_available(writer)
        points = spark.read.parquet(paths[0]).select("time_ns", "fields", F.substring_index("seq.source", "/", -1), "seq.line", "epoch").collect()
        rejects = spark.read.parquet(paths[1]).collect()
        epochs = {r.epoch for r in points}
        seen[kind] = (sorted(map(str, (r[:4] for r in points))), sorted((r.source.split("/")[-1], r.line, r.message, r.original_line) for r in rejects))
        assert len(epochs) == (1 if kind == "whole" else 3)  # the empty file's epoch has no points
    assert seen["whole"] == seen["blocks"]
    assert len(seen["blocks"][0]) == 22 and [r[1] for r in seen["blocks"][1]] == [2, 3]


def test_names_of_files_are_read_without_their_content(spark, tmp_path):
    names = streams.read_names_stream(spark, str(tmp_path))
    assert names.isStreaming and names.columns == ["path", "length"]


def test_an_epoch_of_blocks_leaves_nothing_staged_and_replays(spark, tmp_path, monkeypatch):
    (tmp_path / "in").mkdir()
    (tmp_path / "scratch").mkdir()
    (tmp_path / "in" / "a.lp").write_text("m v=1i 1\nm v=x 2\n")
    # Spark's source expands such a name and lists other files of the epoch twice
    (tmp_path / "in" / "c[1]{x}*.lp").write_text("m v=3i 3")
    monkeypatch.setattr(session, "scratch_root", lambda _: str(tmp_path / "scratch"))
    paths = [str(tmp_path / n) for n in ("points", "rejects")]
    for checkpoint in ("cp1", "cp2"):
        names = streams.read_names_stream(spark, str(tmp_path / "in"))
        streams.run_available(streams.ingest_names_stream(names, types(spark), *paths, str(tmp_path / checkpoint)))
    assert sorted(r.time_ns for r in spark.read.parquet(paths[0]).collect()) == [1, 3]
    assert [r.line for r in spark.read.parquet(paths[1]).collect()] == [2]
    assert list((tmp_path / "scratch").iterdir()) == []


def test_an_epoch_of_bodies_is_not_kept_in_memory(spark, tmp_path, monkeypatch):
    (tmp_path / "scratch").mkdir()
    monkeypatch.setattr(session, "scratch_root", lambda _: str(tmp_path / "scratch"))
    kept, write = [], streams._write_epoch
    monkeypatch.setattr(streams, "_write_epoch", lambda judged, *a: kept.append(judged.storageLevel.useMemory) or write(judged, *a))
    paths = [str(tmp_path / n) for n in ("points", "rejects")]
    bodies = spark.createDataFrame([("a", "m v=1i 1\nm v=x 2"), ("b", "m v=3i 3")], "source string, body string")
    streams.epoch_writer(types(spark), *paths)(bodies, 0)
    assert kept == [False]
    assert sorted((r.seq.source, r.time_ns) for r in spark.read.parquet(paths[0]).collect()) == [("a", 1), ("b", 3)]
    assert [(r.source, r.line) for r in spark.read.parquet(paths[1]).collect()] == [("a", 2)]
    assert list((tmp_path / "scratch").iterdir()) == []


def test_exact_replays_are_dropped_and_changes_pass(spark, tmp_path):
    schema = "host string, time timestamp, v bigint"
    at = dt.datetime(2024, 1, 1, tzinfo=dt.UTC)
    rows = spark.createDataFrame([("a", at, 1), ("a", at, 1), ("a", at, 2), ("b", at, None), ("b", at, None)], schema)
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    once = streams.drop_replays(stream, ["host"], ["v"])
    writer = once.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "cp"))
    streams.run_available(writer.option("path", str(tmp_path / "out")))
    got = spark.read.parquet(str(tmp_path / "out")).select("host", "v").collect()
    assert sorted(map(tuple, got), key=str) == [("a", 1), ("a", 2), ("b", None)]


def test_compaction_keeps_the_current_state(spark, tmp_path):
    table = str(tmp_path / "t")
    schema = "host string, time_ns bigint, seq bigint, a double"
    spark.createDataFrame([("x", 1, 1, 1.0)], schema).write.parquet(table)
    spark.createDataFrame([("x", 1, 2, 2.0), ("y", 1, 3, 3.0)], schema).write.mode("append").parquet(table)
    done = streams.compact(spark, table, str(tmp_path / "c"), ["host"], ["a"])
    want = {("x", 1, 2.0), ("y", 1, 3.0)}
    assert {tuple(r) for r in done.collect()} == want
    assert {tuple(r) for r in streams.read_current(spark, table, ["host"], ["a"]).collect()} == want


def test_numbering_lines_of_a_stream_matches_batch(spark):
    df = spark.createDataFrame([("f", "a\n\nb")], "source string, body string")
    assert lines_of(explode_lines(df, key="source").orderBy(F.col("line"))) == ["a", "b"]


def test_upserts_read_files_of_bounded_size(spark, sf_dir, monkeypatch):
    from tslines.plans.registered import QUERIES, streaming

    written, write = [], streaming.write_lines
    monkeypatch.setattr(streaming, "_LINES_PER_FILE", 20, raising=False)
    monkeypatch.setattr(streaming, "write_lines", lambda df, path, *a: written.append(path) or write(df, path, *a))
    got = QUERIES["stream_upsert"](spark, sf_dir)
    for path in written:
        files = spark.read.text(path).groupBy("_metadata.file_path").count()
        assert files.agg(F.max("count")).first()[0] == 20 and files.count() > 20
    want = QUERIES["ing_lww"](spark, sf_dir).select("user_id", "time_ns", "value", "props")
    got = got.select(*want.columns)
    assert got.count() == want.count() and want.exceptAll(got).isEmpty()


def test_compactions_get_as_many_tasks_as_their_rows_need(spark, tmp_path, monkeypatch):
    from tslines.model import POINTS

    rows = [("m", {"h": str(i % 30)}, [("v", (None, i, None, None, None))], 0, (0, i)) for i in range(300)]
    spark.createDataFrame(rows, POINTS).withColumn("epoch", F.lit(0)).write.parquet(str(tmp_path / "points"))
    seen, current = [], streams.current_points
    monkeypatch.setattr(streams, "_TASK_ROWS", 10, raising=False)
    monkeypatch.setattr(streams, "current_points", lambda *a: seen.append(spark.conf.get("spark.sql.shuffle.partitions")) or current(*a))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    state = streams.compact_points(spark, str(tmp_path / "points"), str(tmp_path / "state"))
    assert seen == ["30"] and spark.conf.get("spark.sql.shuffle.partitions") == before
    assert sorted(r.fields[0].value.i for r in state.collect()) == list(range(270, 300))
