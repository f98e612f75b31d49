"""Batches, bodies, compression, and the files they are stored in."""

from __future__ import annotations

import gzip

import pandas as pd
from pyspark.errors import AnalysisException, SparkRuntimeException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from tslines.model import WriteOptions
from tslines.operators.batches import (
    assign_batches,
    compresses,
    frame_bodies,
    join_bodies,
    local_bodies,
)
from tslines.operators.decode import split_body
from tslines.operators.points import points_from_frame
from tslines.plans.registered.encoding import _BLANKED, _BLANKED_LINE, _blanked
from tslines.plans.registered.registry import (
    EVENT_LINE,
    EVENT_TAGS,
    Tables,
    event_lines,
    named,
)
from tslines.session import scratch_path
from tslines.sources.sinks import (
    pack_bodies,
    read_measurement,
    write_frame,
    write_lines,
    write_measurement,
    write_points,
)

_NUMBERED = "(row_number() OVER (ORDER BY event_id) - 1) // {size} AS batch_id"


@named(
    "batch_sizes",
    f"""SELECT batch_id, CAST(count(*) AS BIGINT) AS n FROM
        (SELECT {_NUMBERED.format(size=3000)} FROM events) GROUP BY 1""",
)
def batch_sizes(t: Tables) -> DataFrame:
    batches = assign_batches(t.events.select("event_id"), ["event_id"], 3000)
    return batches.groupBy("batch_id").agg(F.count("*").alias("n"))


@named(
    "batch_skewed_order",
    """SELECT (row_number() OVER (ORDER BY o_orderstatus, o_orderkey) - 1) // 1000 AS batch_id,
       o_orderkey FROM orders""",
)
def batch_skewed_order(t: Tables) -> DataFrame:
    """A leading order column with three values: the rows still spread over all tasks."""
    keys = ["o_orderstatus", "o_orderkey"]
    return assign_batches(t.orders.select(*keys), keys, 1000).select("batch_id", "o_orderkey")


@named(
    "batch_bodies_md5",
    f"""SELECT batch_id, CAST(count(*) AS INTEGER) AS n_points,
        md5(string_agg(lp, chr(10) ORDER BY event_id)) AS body FROM
        (SELECT event_id, {_NUMBERED.format(size=3000)}, {EVENT_LINE} AS lp FROM events)
        GROUP BY 1""",
)
def batch_bodies_md5(t: Tables) -> DataFrame:
    lines = event_lines(t, keep=["event_id"])
    bodies = join_bodies(assign_batches(lines, ["event_id"], 3000))
    return bodies.select("batch_id", "n_points", F.md5("body").alias("body"))


@named(
    "batch_frame_with_empty_rows",
    f"""SELECT batch_id, CAST(count(*) AS INTEGER) AS n_points,
        string_agg(lp, chr(10) ORDER BY event_id) AS body FROM
        (SELECT *, {_BLANKED_LINE} AS lp FROM
            (SELECT *, {_NUMBERED.format(size=7)} FROM ({_BLANKED})))
        WHERE value IS NOT NULL OR props IS NOT NULL GROUP BY 1""",
)
def batch_frame_with_empty_rows(t: Tables) -> DataFrame:
    """Rows without fields count for the batch limits but are not in the bodies."""
    return frame_bodies(_blanked(t), ["event_id"], "ev", ["event_id", "kind"], "moment", 7)


@named("batch_local", f"SELECT {EVENT_LINE} AS lp, true AS within FROM events")
def batch_local(t: Tables) -> DataFrame:
    """Bodies made inside each partition hold every line once, 500 lines at most each."""
    bodies = local_bodies(event_lines(t), 500)
    return bodies.select(
        F.explode(split_body(F.col("body"))).alias("lp"),
        F.col("n_points").between(1, 500).alias("within"),
    )


@named(
    "gzip_decision",
    f"""SELECT batch_id, CAST(octet_length(encode(body)) AS BIGINT) AS bytes,
        octet_length(encode(body)) > 1024 AS compressed FROM
        (SELECT batch_id, string_agg(lp, chr(10) ORDER BY event_id) AS body FROM
            (SELECT event_id, {_NUMBERED.format(size=10)}, {EVENT_LINE} AS lp FROM events)
            GROUP BY 1)""",
)
def gzip_decision(t: Tables) -> DataFrame:
    lines = event_lines(t, keep=["event_id"])
    bodies = join_bodies(assign_batches(lines, ["event_id"], 10))
    return bodies.select(
        "batch_id",
        F.octet_length("body").cast("bigint").alias("bytes"),
        compresses(F.col("body")).alias("compressed"),
    )


@F.pandas_udf(BinaryType())
def _unzip(payloads: pd.Series) -> pd.Series:
    return payloads.map(gzip.decompress)


@named(
    "gzip_payload",
    """SELECT doc_id, octet_length(encode(text)) > 1024 AS gzipped, md5(text) AS body
       FROM documents""",
)
def gzip_payload(t: Tables) -> DataFrame:
    """Bytes as sent, a gzip stream above the threshold, give the text back."""
    bodies = t.documents.select("doc_id", F.col("text").alias("body"))
    packed = pack_bodies(bodies)
    zipped = packed.where("gzipped").select("doc_id", "gzipped", F.md5(_unzip("payload")).alias("body"))
    plain = packed.where("not gzipped").select("doc_id", "gzipped", F.md5("payload").alias("body"))
    return zipped.unionAll(plain)


@named("sink_bodies", f"SELECT {EVENT_LINE} AS lp FROM events")
def sink_bodies(t: Tables) -> DataFrame:
    """A frame written as a table of bodies and read back line by line."""
    path = scratch_path(t.spark, "bodies")
    write_frame(t.events, path, "events", EVENT_TAGS, "ts")
    stored = t.spark.read.parquet(path)
    return stored.select(F.explode(split_body(F.col("body"))).alias("lp"))


@named(
    "sink_payloads",
    f"SELECT lp, octet_length(encode(lp)) > 100 AS gzipped FROM (SELECT {EVENT_LINE} AS lp FROM events)",
)
def sink_payloads(t: Tables) -> DataFrame:
    """A frame written as the bytes to send, one line to a body, compressed over 100 bytes."""
    path = scratch_path(t.spark, "payloads")
    options = WriteOptions(batch_size=1, gzip_threshold=100)
    write_frame(t.events, path, "events", EVENT_TAGS, "ts", options, layout="payloads")
    stored = t.spark.read.parquet(path)
    zipped = stored.where("gzipped").select(F.decode(_unzip("payload"), "UTF-8").alias("lp"), "gzipped")
    plain = stored.where("not gzipped").select(F.decode("payload", "UTF-8").alias("lp"), "gzipped")
    return zipped.unionAll(plain)


@named(
    "sink_files",
    "SELECT CAST(count(*) AS BIGINT) AS lines, true AS bounded FROM events",
)
def sink_files(t: Tables) -> DataFrame:
    """Text files with one batch each: all lines are there, no file is over the limit."""
    path = scratch_path(t.spark, "files")
    write_lines(event_lines(t), path, lines_per_file=700)
    files = t.spark.read.text(path).groupBy("_metadata.file_path").agg(F.count("*").alias("n"))
    return files.agg(F.sum("n").alias("lines"), (F.max("n") <= 700).alias("bounded"))


@named(
    "layout_tag_order",
    f"""SELECT event_id, value, epoch_us(ts) * 1000 AS time_ns FROM events
        WHERE event_type = 'click' AND user_id = 46""",
)
def layout_tag_order(t: Tables) -> DataFrame:
    """A measurement table laid out by tags, then filtered on them."""
    path = scratch_path(t.spark, "layout")
    time = (F.unix_micros(F.col("ts").cast("timestamp")) * 1000).alias("time_ns")
    table = t.events.select("event_type", "user_id", time, "event_id", "value")
    write_measurement(table, path, EVENT_TAGS)
    stored = read_measurement(t.spark, path)
    return stored.where("event_type = 'click' and user_id = 46").select(
        "event_id", "value", "time_ns"
    )


@named(
    "batch_default",
    """SELECT CAST(count(*) AS BIGINT) AS n_lines, CAST(ceil(count(*) / 5000.0) AS BIGINT) AS n_batches,
       least(count(*), 5000)::BIGINT AS fullest FROM lineitem""",
)
def batch_default(t: Tables) -> DataFrame:
    """Without a size, batches hold 5,000 rows."""
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    sizes = assign_batches(t.lineitem.select(*keys), keys).groupBy("batch_id").agg(F.count("*").alias("n"))
    return sizes.agg(F.sum("n").alias("n_lines"), F.count("*").alias("n_batches"), F.max("n").alias("fullest"))


@named(
    "batch_failure",
    """SELECT CAST(count(*) AS BIGINT) AS n, 'point ''e'' has no fields; it needs at least one' AS reason,
       false AS stored FROM events""",
)
def batch_failure(t: Tables) -> DataFrame:
    """One point that cannot be encoded fails the write, and no table is left behind."""
    value = F.when(F.col("value") < (F.lit(50)), F.col("value")).alias("value")
    points = points_from_frame(t.events.select(value), "e", {}, fields=["value"])
    path = scratch_path(t.spark, "bodies")
    try:
        write_points(points, path)
        reason = None
    except SparkRuntimeException as failure:
        reason = failure.getMessageParameters().get("errorMessage")
    marks = t.spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    try:
        stored = not marks.load(f"{path}/_SUCCESS").isEmpty()
    except AnalysisException:
        stored = False
    return t.events.agg(F.count("*").alias("n"), F.lit(reason).alias("reason"), F.lit(stored).alias("stored"))


@named(
    "sink_smallest",
    """SELECT CAST(count(*) AS BIGINT) AS n_bodies, 1 AS fullest, 4 AS inflight, 1024 AS threshold,
       'batch_size must be a whole number of at least 0, not -1' AS refused FROM events""",
)
def sink_smallest(t: Tables) -> DataFrame:
    """Defaults of the options, 0 as the smallest batch size, and a size that is refused."""
    try:
        WriteOptions(batch_size=-1)
        refused = None
    except ValueError as refusal:
        refused = str(refusal)
    path = scratch_path(t.spark, "bodies")
    write_frame(t.events, path, "events", EVENT_TAGS, "ts", WriteOptions(batch_size=0))
    return t.spark.read.parquet(path).agg(
        F.count("*").alias("n_bodies"),
        F.max("n_points").alias("fullest"),
        F.lit(WriteOptions().max_inflight).alias("inflight"),
        F.lit(WriteOptions().gzip_threshold).alias("threshold"),
        F.lit(refused).alias("refused"),
    )
