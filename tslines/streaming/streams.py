"""Sustained ingest on Structured Streaming.

Encoding is a projection, so `operators.encode` takes a streaming frame as it is. Decoded
points are appended by epoch; "last write wins" is applied when reading, and by a
compaction job from time to time.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tslines.model import Precision
from tslines.operators.decode import explode_lines, has_point, parse_lines
from tslines.operators.ingest import judge, last_write_wins, last_write_wins_points, rejects
from tslines.session import scratch_path, scratch_run, sql_conf, staged
from tslines.sources.files import read_named_lines
from tslines.sources.sinks import write_measurement


def write_lines_stream(lines: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Append a stream of lines to text files."""
    return (
        lines.select("lp")
        .writeStream.format("text")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )


def read_bodies_stream(
    spark: SparkSession, path: str, files_per_trigger: int = 1000
) -> DataFrame:
    """New files as bodies `(source, body)`."""
    return (
        spark.readStream.option("maxFilesPerTrigger", files_per_trigger)
        .text(path, wholetext=True)
        .select(F.col("_metadata.file_path").alias("source"), F.col("value").alias("body"))
    )


def read_bodies(spark: SparkSession, path: str) -> DataFrame:
    """Files present now, in the same columns."""
    whole = spark.read.text(path, wholetext=True)
    return whole.select(F.col("_metadata.file_path").alias("source"), F.col("value").alias("body"))


def read_names_stream(
    spark: SparkSession, path: str, files_per_trigger: int = 1000, bytes_per_trigger: int | None = None
) -> DataFrame:
    """New files by name and size `(path, length)`, for files of any size; no content is read.

    An epoch takes up to `files_per_trigger` files or, if given, as many as hold
    `bytes_per_trigger`, one at least.
    """
    reader = spark.readStream.format("binaryFile").schema(_NAMES)
    if bytes_per_trigger is None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    else:
        reader = reader.option("maxBytesPerTrigger", bytes_per_trigger)
    return reader.load(path).select("path", "length")


# What Spark's reader of whole files gives; the content column is pruned.
_NAMES = "path string, modificationTime timestamp, length bigint, content binary"


def epoch_writer(
    types: DataFrame,
    points_path: str,
    rejects_path: str,
    precision: Precision | str = Precision.NS,
    multiline: bool = False,
) -> Callable[[DataFrame, int], None]:
    """What `ingest_stream` does with the bodies of one epoch.

    Judged lines are written to the shared folder once, for both outputs, and deleted with
    the epoch. Kept in the executors' memory they would fill it, whatever its size.
    """

    def write(epoch: DataFrame, epoch_id: int) -> None:
        number = F.lit(epoch_id).cast("bigint")
        with scratch_run(epoch.sparkSession):
            lines = explode_lines(epoch, multiline, "source").withColumn("batch_id", number)
            judged = staged(_judge_epoch(lines, number, types, precision), "judged")
            _write_epoch(judged, epoch_id, points_path, rejects_path)

    return write


def names_writer(
    types: DataFrame,
    points_path: str,
    rejects_path: str,
    precision: Precision | str = Precision.NS,
    multiline: bool = False,
) -> Callable[[DataFrame, int], None]:
    """What `ingest_names_stream` does with the files of one epoch.

    Their names, bounded by what an epoch takes, go through the driver to a reader that cuts
    files into blocks. Judged lines are written to the shared folder once, for both
    outputs, and deleted with all else the epoch staged.
    """

    def write(epoch: DataFrame, epoch_id: int) -> None:
        spark = epoch.sparkSession
        number = F.lit(epoch_id).cast("bigint")
        paths = [r["path"] for r in epoch.select("path").distinct().collect()]
        with scratch_run(spark):
            named = read_named_lines(spark, paths, multiline).withColumnRenamed("file", "source")
            lines = named.where(has_point(F.col("lp"))).withColumn("batch_id", number)
            judged = staged(_judge_epoch(lines, number, types, precision), "judged")
            _write_epoch(judged, epoch_id, points_path, rejects_path)

    return write


def _judge_epoch(lines: DataFrame, number: Column, types: DataFrame, precision: Precision | str) -> DataFrame:
    order = F.struct(number.alias("epoch"), "source", "line")
    return judge(parse_lines(lines, precision), types).withColumn("seq", order)


def _write_epoch(judged: DataFrame, epoch_id: int, points_path: str, rejects_path: str) -> None:
    good = judged.where(F.col("reject").isNull())
    good = good.select("measurement", "tags", "fields", "time_ns", "seq")
    good.write.mode("overwrite").parquet(f"{points_path}/epoch={epoch_id}")
    bad = rejects(judged, ["source"])
    bad.write.mode("overwrite").parquet(f"{rejects_path}/epoch={epoch_id}")


def ingest_stream(
    bodies: DataFrame,
    types: DataFrame,
    points_path: str,
    rejects_path: str,
    checkpoint: str,
    precision: Precision | str = Precision.NS,
    multiline: bool = False,
) -> DataStreamWriter:
    """Stream of bodies to accepted points and rejected lines.

    `types` gives the stored type of every (measurement, key): "first seen" has no meaning
    on an unbounded input. Every epoch writes its own folder and overwrites it on replay,
    so an epoch that runs twice leaves one result. The write order is (epoch, source,
    line); in the table of rejects the epoch is the batch, next to the source.
    """
    write = epoch_writer(types, points_path, rejects_path, precision, multiline)
    return bodies.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)


def ingest_names_stream(
    names: DataFrame,
    types: DataFrame,
    points_path: str,
    rejects_path: str,
    checkpoint: str,
    precision: Precision | str = Precision.NS,
    multiline: bool = False,
) -> DataStreamWriter:
    """`ingest_stream` for files of any size, given by `read_names_stream`.

    A file is read in blocks by many tasks, and no row holds more than one line. Rows,
    write order and replays are those of `ingest_stream`; a file belongs to one epoch.
    """
    write = names_writer(types, points_path, rejects_path, precision, multiline)
    return names.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)


def drop_replays(
    rows: DataFrame, keys: list[str], payload: list[str], time: str = "time", delay: str = "1 hour"
) -> DataFrame:
    """Drop exact repeats of a row that arrive within `delay` of event time.

    The first copy stays, so this is right for identical copies only. It never stands in
    for "last write wins": rows that differ in the payload all pass.
    """
    content = F.sha2(F.to_json(F.struct(*payload), {"ignoreNullFields": "false"}), 256)
    marked = rows.withWatermark(time, delay).withColumn("__content", content)
    return marked.dropDuplicatesWithinWatermark([*keys, time, "__content"]).drop("__content")


def read_current(
    spark: SparkSession, path: str, series: list[str], fields: list[str], seq: str = "seq"
) -> DataFrame:
    """Current state of a measurement table that is appended to by epoch."""
    return last_write_wins(spark.read.parquet(path), series, fields, seq)


def compact(
    spark: SparkSession, path: str, out: str, series: list[str], fields: list[str], seq: str = "seq"
) -> DataFrame:
    """Write the current state to `out`, laid out for filters on the series columns."""
    write_measurement(read_current(spark, path, series, fields, seq), out, series)
    return spark.read.parquet(out)


def current_points(points: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """Current state in long form of points that `ingest_stream` wrote.

    `state` is an earlier result over all epochs before these: every write in it is older
    than any of theirs, so one merge of both is the state over all of them.
    """
    columns = ["measurement", "tags", "fields", "time_ns", "seq"]
    rows = points.select(*columns)
    return last_write_wins_points(rows if state is None else rows.unionByName(state.select(*columns)))


# Rows, and bytes before they are unpacked and sorted, that a task of a compaction takes.
_TASK_ROWS, _TASK_BYTES = 100_000, 4 << 20


def compact_points(
    spark: SparkSession, points_path: str, out: str, before: str | None = None
) -> DataFrame:
    """Write the current state to `out`, reading only epochs that `before` does not hold.

    `before` is the `out` of the previous call. Epochs are folders, so older ones are pruned
    from the scan. Returns the new state; it may be read while points keep arriving. Points
    are many times larger in memory than in files or shuffles, so the number of tasks follows
    the rows.
    """
    points = spark.read.parquet(points_path)
    state = None
    if before is not None:
        state = spark.read.parquet(before)
        done = state.agg(F.max("seq.epoch").alias("epoch")).first()["epoch"]
        if done is not None:
            points = points.where(F.col("epoch") > done)
    rows = points.count() + (0 if state is None else state.count())
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // _TASK_ROWS))
    small = {
        "spark.sql.shuffle.partitions": str(tasks),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(_TASK_BYTES),
        "spark.sql.files.maxPartitionBytes": str(_TASK_BYTES),
    }
    with sql_conf(spark, small):
        current_points(points, state).write.parquet(out)
    return spark.read.parquet(out)


def run_available(writer: DataStreamWriter) -> None:
    """Run a stream over everything present, then stop."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()


def stream_paths(spark: SparkSession, *names: str) -> list[str]:
    """Fresh scratch paths for the tables and checkpoints of one stream."""
    return [scratch_path(spark, name) for name in names]
