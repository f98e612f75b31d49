"""Streams over file sources, run until everything present is read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tslines.operators.decode import to_measurement
from tslines.operators.encode import encode_frame
from tslines.plans.registered.ingesting import _CURRENT, _WRITES, writes
from tslines.plans.registered.reading import _EVENT_COLUMNS, _EVENT_FIELDS
from tslines.plans.registered.registry import (
    EVENT_LINE,
    EVENT_TAGS,
    Tables,
    event_lines,
    named,
    sql_quoted,
)
from tslines.sources.sinks import write_lines
from tslines.streaming import streams

# Files that are read whole hold about half the bytes of a large request body, as a task has
# several copies of one in memory. Spark numbers those of a task with three digits, which are
# in order up to 1,000 files.
_LINES_PER_FILE = 50_000
# All files present make one epoch.
_ALL_FILES = 1_000_000


def _event_stream(t: Tables) -> DataFrame:
    events = t.events
    return t.spark.readStream.schema(events.schema).parquet(t.path("event[s]"))


@named("stream_encode", f"SELECT {EVENT_LINE} AS lp FROM events")
def stream_encode(t: Tables) -> DataFrame:
    out, checkpoint = streams.stream_paths(t.spark, "lp", "checkpoint")
    lines = encode_frame(_event_stream(t), "events", EVENT_TAGS, "ts")
    streams.run_available(streams.write_lines_stream(lines, out, checkpoint))
    return t.spark.read.text(out).withColumnRenamed("value", "lp")


def _event_types(t: Tables) -> DataFrame:
    rows = [("events", k, "tag") for k in EVENT_TAGS]
    rows += [("events", k, m) for k, m in _EVENT_FIELDS.items()]
    return t.spark.createDataFrame(rows, "measurement string, key string, type string")


@named("stream_ingest", f"SELECT {_EVENT_COLUMNS} FROM events")
def stream_ingest(t: Tables) -> DataFrame:
    """Files of lines to stored points, several files to an epoch."""
    source, points, rejects, checkpoint = streams.stream_paths(
        t.spark, "lp", "points", "rejects", "checkpoint"
    )
    write_lines(event_lines(t), source, lines_per_file=100_000)
    bodies = streams.read_bodies_stream(t.spark, source, files_per_trigger=4)
    streams.run_available(
        streams.ingest_stream(bodies, _event_types(t), points, rejects, checkpoint)
    )
    stored = t.spark.read.parquet(points)
    return to_measurement(stored, "events", EVENT_TAGS, _EVENT_FIELDS).drop("time")


@named("stream_blocks", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def stream_blocks(t: Tables) -> DataFrame:
    """Files of whole texts with line breaks, read in blocks; one file to an epoch, and the
    last epoch runs twice."""
    source, points, rejects, checkpoint = streams.stream_paths(
        t.spark, "lp", "points", "rejects", "checkpoint"
    )
    write_lines(encode_frame(t.documents, "documents", ["lang", "source"]).repartition(2), source)
    kinds = {"lang": "tag", "source": "tag", "doc_id": "i", "text": "s", "n_chars": "i"}
    types = t.spark.createDataFrame(
        [("documents", k, kind) for k, kind in kinds.items()], "measurement string, key string, type string"
    )
    names = streams.read_names_stream(t.spark, source, bytes_per_trigger=1)
    streams.run_available(
        streams.ingest_names_stream(names, types, points, rejects, checkpoint, multiline=True)
    )
    stored = t.spark.read.parquet(points)
    last = stored.where("epoch = 1").select(F.col("seq.source").alias("path")).distinct()
    streams.names_writer(types, points, rejects, multiline=True)(last, 1)
    wide = to_measurement(t.spark.read.parquet(points), "documents", ["lang", "source"], {"doc_id": "i", "text": "s", "n_chars": "i"})
    return wide.select("doc_id", "text", "lang", "source", "n_chars")


@named(
    "stream_rejects",
    f"""SELECT 'type conflict on value' AS message, 'events,event_type=' || event_type
        || ' value=' || {sql_quoted('CAST(value AS VARCHAR)')} || ' ' || event_id AS original_line
        FROM events WHERE event_type = 'error'""",
)
def stream_rejects(t: Tables) -> DataFrame:
    """Lines that do not fit the stored types end up in the table of rejects."""
    source, points, rejects, checkpoint = streams.stream_paths(
        t.spark, "lp", "points", "rejects", "checkpoint"
    )
    value = F.col("value").cast("string")
    text = F.when(F.col("event_type") == "error", F.concat(F.lit('"'), value, F.lit('"')))
    lines = t.events.select(
        F.concat(
            F.lit("events,event_type="), "event_type", F.lit(" value="), F.coalesce(text, value),
            F.lit(" "), "event_id",
        ).alias("lp")
    )
    write_lines(lines, source)
    bodies = streams.read_bodies_stream(t.spark, source)
    streams.run_available(
        streams.ingest_stream(bodies, _event_types(t), points, rejects, checkpoint)
    )
    return t.spark.read.parquet(rejects).select("message", "original_line")


@named("stream_replays", "SELECT event_id, user_id, value, props FROM events")
def stream_replays(t: Tables) -> DataFrame:
    """Every event delivered twice leaves once."""
    source, out, checkpoint = streams.stream_paths(t.spark, "twice", "once", "checkpoint")
    events = t.events.withColumn("time", F.col("ts").cast("timestamp"))
    events.write.parquet(source)
    events.write.mode("append").parquet(source)
    stream = t.spark.readStream.schema(events.schema).parquet(source)
    once = streams.drop_replays(
        stream, ["event_type", "user_id"], ["event_id", "value", "props"], delay="3650 days"
    )
    writer = once.writeStream.format("parquet").option("checkpointLocation", checkpoint)
    streams.run_available(writer.option("path", out))
    return t.spark.read.parquet(out).select("event_id", "user_id", "value", "props")


@named("stream_upsert", f"{_CURRENT} FROM ({_WRITES}) GROUP BY ALL")
def stream_upsert(t: Tables) -> DataFrame:
    """Lines by stream to points and to the current state, in two compactions, the second of
    which reads the new epoch alone; that epoch runs twice."""
    source, points, rejects, first, second, checkpoint = streams.stream_paths(
        t.spark, "lp", "points", "rejects", "state", "state", "checkpoint"
    )
    kinds = {"user_id": "tag", "seq": "i", "value": "f", "props": "s"}
    types = t.spark.createDataFrame(
        [("w", k, kind) for k, kind in kinds.items()], "measurement string, key string, type string"
    )
    lines = encode_frame(writes(t), "w", ["user_id"], "time_ns", keep=["user_id", "seq"])

    def arrive(part: DataFrame, name: str) -> None:
        # all writes of a series in the files of one task, in the order of their names
        ordered = part.repartition("user_id").sortWithinPartitions("seq")
        write_lines(ordered, f"{source}/{name}", _LINES_PER_FILE)
        bodies = streams.read_bodies_stream(t.spark, f"{source}/*", files_per_trigger=_ALL_FILES)
        streams.run_available(streams.ingest_stream(bodies, types, points, rejects, checkpoint))

    arrive(lines.where("seq < 1000000000"), "a")
    streams.compact_points(t.spark, points, first)
    arrive(lines.where("seq >= 1000000000"), "b")
    again = streams.read_bodies(t.spark, f"{source}/b")
    streams.epoch_writer(types, points, rejects)(again, 1)
    state = streams.compact_points(t.spark, points, second, first)
    wide = to_measurement(state, "w", ["user_id"], {"value": "f", "props": "s"}).drop("time")
    return wide.withColumn("user_id", F.col("user_id").cast("bigint"))
