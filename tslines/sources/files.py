"""Reading points, frames and line-protocol text."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tslines.functions.literals import UNSIGNED
from tslines.model import POINTS, Precision
from tslines.operators.batches import number_rows
from tslines.operators.decode import end_of_line, explode_lines, has_point, parse_lines
from tslines.session import is_small, staged
from tslines.sources.logical import read_logical_lines

# Files up to this size can be read whole, one file being one body. Request bodies are
# 10 MB by default, so larger files are concatenations, to be read line by line.
MAX_WHOLE_FILE = 64 * 1024 * 1024
MAX_BROADCAST_FILES = 200_000


def points_from_rows(spark: SparkSession, rows: Iterable) -> DataFrame:
    """Points held by the caller, in the canonical schema."""
    return spark.createDataFrame(list(rows), POINTS)


def read_parquet(spark: SparkSession, path: str, unsigned: Iterable[str] = ()) -> DataFrame:
    """Parquet frame; `unsigned` marks columns that were unsigned in the file."""
    return mark_unsigned(spark.read.parquet(path), unsigned)


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | str, header: bool = True, **options
) -> DataFrame:
    """CSV frame. The schema is required: untyped columns would land as string fields."""
    return spark.read.schema(schema).options(header=header, **options).csv(path)


def mark_unsigned(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Mark whole-number columns as unsigned; the mark travels with the schema."""
    for name in columns:
        df = df.withMetadata(name, {**(df.schema[name].metadata or {}), UNSIGNED: True})
    return df


def bodies_from_text(spark: SparkSession, bodies: Iterable[str]) -> DataFrame:
    """Raw line-protocol texts held by the caller, one batch each; empty text is no batch."""
    rows = [(i, b) for i, b in enumerate(bodies) if b]
    return spark.createDataFrame(rows, "batch_id bigint, body string")


def _numbered_files(spark: SparkSession, path: str) -> DataFrame:
    """Files below a path with a dense number in name order.

    The listing reads no file content, as that column is pruned.
    """
    listed = spark.read.format("binaryFile").load(path)
    names = listed.select(F.col("_metadata.file_path").alias("__file"))
    return number_rows(names, ["__file"]).withColumnRenamed("pos", "batch_id")


def _with_file_number(df: DataFrame, files: DataFrame) -> DataFrame:
    """Add `batch_id` by file; a file that came after the listing fails the job."""
    side = files
    if is_small(files, MAX_BROADCAST_FILES):
        side = F.broadcast(side)
    unlisted = F.raise_error(F.concat(F.lit("file added while reading: "), "__file"))
    number = F.coalesce("batch_id", unlisted.cast("bigint"))
    return df.join(side, "__file", "left").withColumn("batch_id", number).drop("__file")


def read_bodies(spark: SparkSession, path: str) -> DataFrame:
    """Files as bodies `(batch_id, body)`, numbered in name order."""
    files = _numbered_files(spark, path)
    whole = spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("__file"), F.col("value").alias("body")
    )
    return _with_file_number(whole, files).select("batch_id", "body")


def read_numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of files of any size as `(batch_id, line, lp)`, numbered from 1 in each file."""
    files = _numbered_files(spark, path)
    lines = _lines_of_blocks(spark, path).withColumnRenamed("file", "__file")
    return _numbered(_with_file_number(lines, files), "batch_id")


def read_named_lines(spark: SparkSession, paths: list[str], multiline: bool = False) -> DataFrame:
    """Lines of the files of that name, of any size, as `(file, line, lp)`.

    Names are taken as they are, without patterns; a file may be missing from the result
    only when it holds no line.
    """
    exact = [re.sub(r"([\\{}\[\]*?])", r"\\\1", p) for p in sorted(set(paths))]
    if multiline:
        return read_logical_lines(spark, exact)
    return _numbered(_lines_of_blocks(spark, exact), "file")


def _lines_of_blocks(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines with their file, their block of it and their place in the task."""
    return spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("__block"),
        F.monotonically_increasing_id().alias("__id"),
        end_of_line(F.col("value")).alias("lp"),
    )


def _numbered(lines: DataFrame, file: str) -> DataFrame:
    """`(file, line, lp)`, numbered from 1 in each file.

    Spark reads a file in blocks, each by one task in order. The lines are written once
    with their place in the task; the count per block, one row per block, then gives the
    number of the first line of every block. No sort and no shuffle of the lines.
    """
    stored = staged(lines, "lines")
    blocks = stored.groupBy(file, "__block").agg(
        F.count("*").alias("n"), F.min("__id").alias("__first")
    )
    before = Window.partitionBy(file).orderBy("__block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = staged(
        blocks.select(
            file,
            "__block",
            "__first",
            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__start"),
        ),
        "blocks",
    )
    if is_small(starts, MAX_BROADCAST_FILES):
        starts = F.broadcast(starts)
    return stored.join(starts, [file, "__block"]).select(
        file, (F.col("__start") + F.col("__id") - F.col("__first") + 1).alias("line"), "lp"
    )


def read_lp(
    spark: SparkSession,
    path: str,
    precision: Precision | str = Precision.NS,
    multiline: bool = False,
    layout: str = "bodies",
    max_whole_file: int = MAX_WHOLE_FILE,
) -> DataFrame:
    """Parsed lines of line-protocol files; columns as `decode.parse_bodies` gives.

    One file is one batch. `layout='bodies'` reads files whole and fails on one larger than
    `max_whole_file`; `layout='lines'` reads files of any size in blocks; `layout='auto'`
    reads them whole if none is larger, else in blocks. All cut, number and judge lines
    alike, with `multiline` also those with breaks inside of strings.
    """
    if layout not in ("bodies", "lines", "auto"):
        raise ValueError(f"layout must be 'bodies', 'lines' or 'auto', not {layout!r}")
    if layout != "lines":
        sizes = spark.read.format("binaryFile").load(path).agg(F.max("length").alias("n"))
        largest = sizes.first()["n"] or 0
        if layout == "bodies" and largest > max_whole_file:
            raise ValueError(f"a file of {largest} bytes is too large to be read whole; use layout='lines'")
        layout = "bodies" if largest <= max_whole_file else "lines"
    if layout == "bodies":
        lines = explode_lines(read_bodies(spark, path), multiline)
    elif multiline:
        named = read_logical_lines(spark, path).withColumnRenamed("file", "__file")
        lines = _with_file_number(named, _numbered_files(spark, path)).where(has_point(F.col("lp")))
        lines = lines.select("batch_id", "line", "lp")
    else:
        lines = read_numbered_lines(spark, path).where(has_point(F.col("lp")))
    order = F.struct(F.col("batch_id").alias("batch"), F.col("line").alias("line"))
    return parse_lines(lines, precision).withColumn("seq", order)
