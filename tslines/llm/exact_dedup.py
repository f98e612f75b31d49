"""Exact duplicates with a heavy-hitter split.

Texts are compared by SHA-256. One pass of Misra-Gries counters per task finds digests that
may be frequent; their exact counts and winners come from one aggregation over the rows of
these candidates. Winners are at most `counters` rows, so they are broadcast and decide
their copies where these lie. All other digests are too rare to load one task, and are
shuffled by digest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tslines.llm.common import whole_text
from tslines.session import staged

#: Misra-Gries counters of a task, and the most winners that are broadcast (60 bytes each).
COUNTERS = 1 << 14
#: A digest of fewer rows loads no task and is not looked at as frequent.
LEAST_ROWS = 64


def digest(text: str = "text") -> Column:
    """SHA-256 of a text as it is, 32 bytes; null counts as empty."""
    return F.unhex(F.sha2(whole_text(text), 256))


def merge_counters(counts: pd.Series, more: pd.Series, counters: int) -> pd.Series:
    """Two Misra-Gries summaries as one: add, take off what the first beyond the last counter
    has, and drop what is used up."""
    both = counts.add(more, fill_value=0).astype(np.int64)
    if len(both) > counters:
        least = np.partition(both.to_numpy(), len(both) - counters - 1)[len(both) - counters - 1]
        both = both[both > least] - least
    return both


def frequent_digests(digests: DataFrame, rows: int, counters: int = COUNTERS, least_rows: int = LEAST_ROWS) -> DataFrame:
    """Candidates among `digests.digest`: every digest with over 2 * rows / counters rows is
    there, and at most `counters` are. Each task counts what it reads with bounded memory."""

    def summarise(batches: Iterator) -> Iterator:
        counts = pd.Series(dtype=np.int64)
        for batch in batches:
            more = batch.column(0).value_counts()
            more = pd.Series(more.field("counts").to_numpy(), index=more.field("values").to_pylist())
            counts = merge_counters(counts, more, counters)
        if len(counts):
            yield pa.RecordBatch.from_arrays([pa.array(counts.index, pa.binary()), pa.array(counts.to_numpy(), pa.int64())], ["digest", "n"])

    found = digests.select("digest").mapInArrow(summarise, "digest binary, n long")
    least = max(rows // counters, least_rows)
    return found.groupBy("digest").agg(F.sum("n").alias("n")).where(F.col("n") > least).select("digest")


def winners(rows: DataFrame, candidates: DataFrame) -> DataFrame:
    """Exact group size and the row that stays, for the candidates; merged before the shuffle."""
    held = rows.join(F.broadcast(candidates), "digest")
    return held.groupBy("digest").agg(F.count("*").alias("size"), F.max(F.struct("id", "at")).alias("best"))


def numbered(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, at, digest) of every row, written once: `at` tells rows of one id apart."""
    rows = df.select(F.col(id_col).alias("id"), digest(text).alias("digest"))
    return staged(rows.withColumn("at", F.monotonically_increasing_id()), "digests")


def copies(df: DataFrame, id_col: str = "doc_id", text: str = "text", counters: int = COUNTERS, least_rows: int = LEAST_ROWS) -> DataFrame:
    """One row per row of `df`: its id, `keep_id` (largest id of equal texts), `group_size`,
    `kept`, `text_sha256`.

    Null and empty texts are equal. A null id is smaller than any other; of rows with equal
    text and equal largest id exactly one is kept. An empty table gives no rows. Other
    columns are not read.
    """
    rows = numbered(df, id_col, text)
    candidates = staged(frequent_digests(rows, rows.count(), counters, least_rows), "frequent")
    won = F.broadcast(staged(winners(rows, candidates), "winners"))
    heavy = rows.join(won, "digest")
    same = Window.partitionBy("digest")
    rest = rows.join(F.broadcast(candidates), "digest", "left_anti")
    light = rest.withColumns({"size": F.count("*").over(same), "best": F.max(F.struct("id", "at")).over(same)})
    both = heavy.select("id", "at", "digest", "size", "best").unionByName(light)
    return both.select(
        F.col("id").alias(id_col),
        F.col("best.id").alias("keep_id"),
        F.col("size").alias("group_size"),
        (F.col("best.at") == F.col("at")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_copies(df: DataFrame, id_col: str = "doc_id", text: str = "text", counters: int = COUNTERS, least_rows: int = LEAST_ROWS) -> DataFrame:
    """The rows of `df` with one row of each text, the one with the largest id; columns as
    they are, whatever their names. Ties are broken by the other columns' content.

    Rows of frequent digests are merged where they lie, at most one row of each leaves a
    task; the rest is shuffled once, and adaptive joins are not needed.
    """
    others = F.to_json(F.struct(F.lit(0), *[c for c in df.columns if c not in (id_col, text)]))
    order = F.struct(F.col(id_col).alias("id"), others.alias("others"))
    rows = df.select(F.struct("*").alias("row"), digest(text).alias("digest"), order.alias("order"))
    digests = staged(rows.select("digest"), "digests")
    candidates = F.broadcast(staged(frequent_digests(digests, digests.count(), counters, least_rows), "frequent"))
    heavy = rows.join(candidates, "digest").groupBy("digest").agg(F.max_by("row", "order").alias("row"))
    light = rows.join(candidates, "digest", "left_anti")
    first = F.row_number().over(Window.partitionBy("digest").orderBy(F.desc("order")))
    light = light.withColumn("nth", first).where("nth = 1")
    return heavy.select("row.*").unionByName(light.select("row.*"))
