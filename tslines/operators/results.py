"""Query results in the value model: ns times, decimal text, typed cells."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tslines.functions import times, views
from tslines.model import U64


class UnsupportedType(TypeError):
    """A result column has a type outside the value model."""

    def __init__(self, kind: T.DataType):
        super().__init__(_unsupported_text(kind))


def _unsupported_text(kind: T.DataType) -> str:
    return f"unsupported data type in query result: {kind.simpleString()}"


_KEPT = (
    T.BooleanType,
    T.ByteType,
    T.ShortType,
    T.IntegerType,
    T.LongType,
    T.FloatType,
    T.DoubleType,
    T.StringType,
    T.CharType,
    T.VarcharType,
    T.BinaryType,
    T.NullType,
)


def _normal(c: Column, field: T.StructField, unsigned: tuple[str, ...], strict: bool) -> Column:
    kind = field.dataType
    if isinstance(kind, _KEPT) or (kind == U64 and field.name in unsigned):
        return c
    if isinstance(kind, T.TimestampType | T.TimestampNTZType):
        return times.datetime_nanos(c)
    if isinstance(kind, T.DecimalType):
        return c.cast("string")
    if strict:
        raise UnsupportedType(kind)
    # A column of NULLs passes, the first real value fails.
    return F.when(c.isNotNull(), F.raise_error(F.lit(_unsupported_text(kind)))).cast("string")


def normalize(df: DataFrame, unsigned: tuple[str, ...] = (), strict: bool = False) -> DataFrame:
    """Columns in the value model: times as epoch ns, decimals as exact text.

    Other types fail, on the first value or with `strict=True` when planning. Columns in
    `unsigned` hold unsigned 64-bit numbers and stay DECIMAL(20,0).
    """
    return df.select(
        *(
            _normal(F.col(f"`{f.name}`"), f, tuple(unsigned), strict).alias(f.name)
            for f in df.schema.fields
        )
    )


def as_map(df: DataFrame) -> DataFrame:
    """Each row as a map from column name to display text, in column `row`."""
    names = F.array(*(F.lit(c) for c in df.columns))
    cells = F.array(*(views.display(df, c) for c in df.columns))
    return df.select(F.map_from_arrays(names, cells).alias("row"))


def column_names(df: DataFrame) -> list[str]:
    return df.columns


def num_rows(df: DataFrame) -> int:
    return df.count()


def iter_rows(df: DataFrame) -> Iterator[Row]:
    """Rows on the driver, one partition in memory at a time; for small results."""
    return df.toLocalIterator()


def map_batches(
    df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: T.StructType | str
) -> DataFrame:
    """Run `fn` over the Arrow batches of a result, on the executors.

    Batch size is `spark.sql.execution.arrow.maxRecordsPerBatch`.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return (fn(b) for b in batches)

    return df.mapInArrow(run, schema)
