"""Writing lines, bodies and measurement tables."""

from __future__ import annotations

import gzip

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from tslines.model import DEFAULT_GZIP_THRESHOLD, WriteOptions
from tslines.operators.batches import compresses, local_bodies
from tslines.operators.encode import check_newlines, encode_frame, encode_points
from tslines.operators.ingest import accepted, judge, rejects
from tslines.session import staged


def write_lines(
    lines: DataFrame, path: str, lines_per_file: int = 0, gzip_files: bool = False
) -> None:
    """Column `lp` as text files. `lines_per_file` of 0 writes one file per partition;
    the batch size writes one file per batch, which suits small tables only."""
    writer = lines.select("lp").write.option("maxRecordsPerFile", lines_per_file)
    writer.text(path, compression="gzip" if gzip_files else "none")


def write_points(
    points: DataFrame,
    path: str,
    options: WriteOptions = WriteOptions(),
    layout: str = "bodies",
    on_newline: str = "names",
) -> None:
    """Encode points and store them; `on_newline` is explained at `encode.line_fault`.

    `layout='bodies'` writes a Parquet table of bodies, many to a file, each with at most
    `batch_size` lines; `layout='payloads'` writes the bytes to send instead, compressed when
    a body is over `gzip_threshold`; `layout='files'` writes text with one file per batch.
    """
    _store(check_newlines(encode_points(points, options), on_newline), path, options, layout)


def write_frame(
    df: DataFrame,
    path: str,
    measurement: str,
    tags: list[str] = (),
    timestamp_column: str | None = None,
    options: WriteOptions = WriteOptions(),
    layout: str = "bodies",
    on_newline: str = "names",
    **encode,
) -> None:
    """Encode a frame and store it; default tags and tag order do not apply."""
    lines = encode_frame(df, measurement, tags, timestamp_column, options.precision, **encode)
    _store(check_newlines(lines, on_newline), path, options, layout)


def _store(lines: DataFrame, path: str, options: WriteOptions, layout: str) -> None:
    if layout == "bodies":
        local_bodies(lines, options.batch_size).write.parquet(path)
    elif layout == "payloads":
        packed = pack_bodies(local_bodies(lines, options.batch_size), options.gzip_threshold)
        packed.drop("body").write.parquet(path)
    elif layout == "files":
        write_lines(lines, path, options.batch_size)
    else:
        raise ValueError(f"layout must be 'bodies', 'payloads' or 'files', not {layout!r}")


@F.pandas_udf(BinaryType())
def gzip_body(bodies: pd.Series) -> pd.Series:
    """Bodies as gzip streams; NULL stays NULL."""
    return bodies.map(zip_bytes, na_action="ignore")


def zip_bytes(body: str) -> bytes:
    """One gzip stream, without a time stamp so that equal bodies stay equal."""
    return gzip.compress(body.encode(), mtime=0)


def pack_bodies(
    bodies: DataFrame, threshold: int | None = DEFAULT_GZIP_THRESHOLD
) -> DataFrame:
    """Add `payload`, the bytes to send, and `gzipped`, whether they are compressed."""
    marked = bodies.withColumn("gzipped", compresses(F.col("body"), threshold))
    plain = F.encode("body", "UTF-8")
    if threshold is None:
        return marked.withColumn("payload", plain)
    # A Python function sees every row, so short bodies are sent to it as NULL.
    zipped = gzip_body(F.when(F.col("gzipped"), F.col("body")))
    return marked.withColumn("payload", F.coalesce(zipped, plain))


def write_measurement(
    table: DataFrame, path: str, tag_order: list[str], partitions: int | None = None,
    time: str = "time_ns",
) -> None:
    """Measurement table as Parquet laid out for filters on tags, the first tag foremost.

    Rows are range-partitioned and sorted on tags and then time, so that row groups cover
    narrow ranges and a filter skips most of them. Time comes last in the range key, which
    lets one frequent tag value spread over many files.
    """
    keys = [F.col(f"`{c}`") for c in [*tag_order, time]]
    ranged = (
        table.repartitionByRange(partitions, *keys)
        if partitions
        else table.repartitionByRange(*keys)
    )
    ranged.sortWithinPartitions(*keys).write.parquet(path)


def write_judged(judged: DataFrame, points_path: str, rejects_path: str) -> None:
    """Accepted points and rejected lines to two tables, parsing once."""
    stored = staged(judged, "judged")
    accepted(stored).drop("lp").write.parquet(points_path)
    rejects(stored).write.parquet(rejects_path)


def write_parsed(
    parsed: DataFrame,
    points_path: str,
    rejects_path: str,
    options: WriteOptions = WriteOptions(),
    types: DataFrame | None = None,
) -> None:
    """Parsed lines to accepted points and rejected lines in one call.

    Without `types` the first type written counts. `accept_partial=False` in the options
    turns a whole batch down for one bad line; no other option acts on text.
    """
    write_judged(judge(parsed, types, options.accept_partial), points_path, rejects_path)


def read_measurement(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
