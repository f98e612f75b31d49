"""Cutting lines into bounded batches and joining each into one body."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tslines.model import BATCHES, DEFAULT_BATCH_SIZE, DEFAULT_GZIP_THRESHOLD
from tslines.operators.encode import frame_line, frame_roles, has_field
from tslines.session import staged

# monotonically_increasing_id puts the partition above bit 33, the row below it.
_ROW_BITS = 33


def number_rows(df: DataFrame, order_by: list[str], partitions: int | None = None) -> DataFrame:
    """Add `pos`, the 0-based place of each row in the total order of `order_by`.

    The order key must be unique. Rows are range-partitioned on the whole key and sorted
    inside each partition, so no task sees more than its range even when one leading value
    holds much of the data. Range bounds come from a sample that Spark may draw again for
    every job; the sorted rows are therefore written once and both the count per partition
    and the numbering read that table. The count table has one row per partition.
    """
    if not order_by:
        raise ValueError("numbering rows needs an order key")
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(f"`{c}`") for c in order_by]
    ranged = (
        df.repartitionByRange(n, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("__id", F.monotonically_increasing_id())
    )
    stored = staged(ranged, "numbered")
    part = F.shiftright("__id", _ROW_BITS)
    counts = stored.groupBy(part.alias("__part")).agg(F.count("*").alias("n")).collect()
    start, offsets = 0, []
    for row in sorted(counts):
        offsets.append((row["__part"], start))
        start += row["n"]
    table = spark.createDataFrame(offsets, "__part bigint, __start bigint")
    index = F.col("__id").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        stored.withColumn("__part", part)
        .join(F.broadcast(table), "__part")
        .withColumn("pos", F.col("__start") + index)
        .drop("__part", "__start", "__id")
    )


def batch_of(pos: Column, batch_size: int) -> Column:
    return F.call_function("div", pos, F.lit(max(1, batch_size))).cast("bigint")


def assign_batches(
    df: DataFrame,
    order_by: list[str],
    batch_size: int = DEFAULT_BATCH_SIZE,
    partitions: int | None = None,
) -> DataFrame:
    """Add `pos` and `batch_id`: runs of `batch_size` rows in the order of `order_by`."""
    numbered = number_rows(df, order_by, partitions)
    return numbered.withColumn("batch_id", batch_of(F.col("pos"), batch_size))


def join_bodies(lines: DataFrame) -> DataFrame:
    """Lines with `batch_id` and `pos` to one body per batch, lines in `pos` order.

    A group holds at most the batch size, and lines of a batch that sit in one task are
    joined before the shuffle.
    """
    return lines.groupBy("batch_id").agg(
        F.count("lp").cast("int").alias("n_points"),
        F.expr("listagg(lp, '\n') within group (order by pos)").alias("body"),
    )


def frame_bodies(
    df: DataFrame,
    order_by: list[str],
    measurement: str,
    tags: list[str] = (),
    timestamp_column: str | None = None,
    batch_size: int = DEFAULT_BATCH_SIZE,
    **encode,
) -> DataFrame:
    """Bodies of a frame: rows are counted into batches first, empty rows dropped after.

    A batch whose rows all lack fields yields no body.
    """
    line = frame_line(df, measurement, tags, timestamp_column, **encode)
    some = has_field(df, frame_roles(df, list(tags), timestamp_column)[1])
    lp = line if some is None else F.when(some, line)
    # Rows are encoded before the range shuffle; only the key and the line move.
    keyed = df.select(*(F.col(f"`{c}`") for c in order_by), lp.alias("lp"))
    batched = assign_batches(keyed, order_by, batch_size)
    return join_bodies(batched.where(F.col("lp").isNotNull()))


def _cut(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.Array]:
    """Re-cut a stream of Arrow string arrays into runs of exactly `size`."""
    held, count = [], 0
    for batch in batches:
        lines = batch.column(0)
        while len(lines):
            taken = lines.slice(0, size - count)
            held.append(taken)
            count += len(taken)
            lines = lines.slice(len(taken))
            if count == size:
                yield pa.concat_arrays(held)
                held, count = [], 0
    if held:
        yield pa.concat_arrays(held)


def local_bodies(lines: DataFrame, batch_size: int = DEFAULT_BATCH_SIZE) -> DataFrame:
    """Lines (column `lp`) to bodies inside each partition, without a shuffle.

    Where batch limits fall carries no meaning for stored data, so this is the form to use
    on large tables. `batch_id` is unique: partition number above bit 33, run below.
    """
    from pyspark import TaskContext

    size = max(1, batch_size)
    schema = pa.schema(
        [("batch_id", pa.int64()), ("n_points", pa.int32()), ("body", pa.string())]
    )

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << _ROW_BITS
        for run, lp in enumerate(_cut(batches, size)):
            lp = lp.cast(pa.string())  # Spark may send the large kind
            # one list of all the lines, joined in native code
            whole = pa.ListArray.from_arrays(pa.array([0, len(lp)], pa.int32()), lp)
            body = pc.binary_join(whole, "\n")
            yield pa.record_batch(
                [pa.array([base + run]), pa.array([len(lp)], pa.int32()), body], schema
            )

    return lines.select("lp").where(F.col("lp").isNotNull()).mapInArrow(join, BATCHES)


def compresses(body: Column, threshold: int | None = DEFAULT_GZIP_THRESHOLD) -> Column:
    """Whether a body is sent compressed: longer than the threshold in bytes.

    0 compresses every body that is not empty, None compresses nothing.
    """
    if threshold is None:
        return F.lit(False)
    return F.octet_length(body) > threshold
