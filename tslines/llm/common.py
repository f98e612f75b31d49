"""What the operators share: session settings, the meaning of a word, bounded broadcasts."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tslines.session import prepare

#: White space of the contracts, inside a character class.
SPACES = r"\x20\x09-\x0D"
WORD = rf"[^{SPACES}]+"
#: The same white space as plain characters.
SPACE_CHARS = " \t\n\x0b\f\r"

#: Rows and bytes handed to a Python worker at once; texts may be long.
BATCH_CONF = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "400",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}


def ready(spark: SparkSession) -> SparkSession:
    """Settings for the operators: those of the library, and small Arrow batches."""
    prepare(spark)
    for key, value in BATCH_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{folder}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    """Where a public tokenizer's file lies; it must lie there on every node."""
    import public_tokenizers

    return public_tokenizers.path(name)


def whole_text(text: str = "text") -> Column:
    """A text, empty where it is null."""
    return F.coalesce(F.col(text), F.lit(""))


def words(text: Column) -> Column:
    """The words of a text as an array, by DataFrame functions."""
    trimmed = F.btrim(text, F.lit(SPACE_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, f"[{SPACES}]+", -1))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """Compute `value` once and use it several times, also inside the functions of arrays."""
    return F.element_at(F.transform(F.array(value), use), 1)


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


class Memo(dict):
    """A dictionary that computes what it lacks, and starts anew past `limit` entries."""

    def __init__(self, compute: Callable, limit: int):
        super().__init__()
        self.compute, self.limit = compute, limit

    def __missing__(self, key):
        value = self.compute(key)
        if len(self) >= self.limit:
            self.clear()
        self[key] = value
        return value


def text_batches(batches: Iterator, column: str = "text") -> Iterator[tuple]:
    """Record batches with one column's values as Python strings."""
    for batch in batches:
        if batch.num_rows:
            yield batch, batch.column(column).to_pylist()


def broadcast_if_small(df: DataFrame, rows: int) -> DataFrame:
    """A written table, marked for broadcast if it has at most `rows` rows."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def file_system(uri: str):
    """The Arrow file system of a URI and the path in it."""
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        uri = os.path.abspath(uri)
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri)


def runs(batches: Iterator, keys: list[str]) -> Iterator:
    """Arrow tables of rows with equal whole-number keys, from batches sorted by them."""
    import numpy as np
    import pyarrow as pa

    held, last = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        at = np.stack([batch.column(k).to_numpy() for k in keys], 1)
        cuts = [0, *(np.flatnonzero((at[1:] != at[:-1]).any(axis=1)) + 1).tolist(), len(at)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            key = at[a].tolist()
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield pa.Table.from_batches(held)
