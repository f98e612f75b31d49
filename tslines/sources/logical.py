"""Lines of files of any size where a quoted string may run over line breaks.

Whether a line break ends a line depends on all text before it. Spark reads a file in blocks
and cuts at every break; each piece then maps the state before it, outside or inside of a
string, to the state after it. These maps compose: a task follows its block under both
states, the blocks' maps are composed in order, one row per block, and that gives every
piece its state. Pieces that begin outside are the starts of lines. Only lines of several
pieces are put together by a shuffle; all others stay where they were read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tslines.functions.grammar import STRING
from tslines.session import is_small, staged

# A piece of a body from its start, or from inside a string, with the field set that follows.
_FLAT_NAME = r"[^,= \\]*+(?:\\.[^,= \\]*+)*+"
_VALUE = rf'(?:{STRING}|[^,= "]++)'
_PAIR = rf"{_FLAT_NAME}={_VALUE}"
_HEAD = r"[^ \\]*+(?:\\.[^ \\]*+)*+"
# string text that no quote ends; a backslash at the very end takes the line break
_OPEN = r'[^"\\]*+(?:\\.[^"\\]*+)*+\\?\z'
#: A piece that begins outside and ends inside of a string.
OPENS = rf'(?s)^{_HEAD} (?:{_PAIR},)*+{_FLAT_NAME}="{_OPEN}'
#: The same for one that begins inside: no quote ends the string, or another string opens.
STAYS = rf"(?s)^{_OPEN}"
REOPENS = rf'(?s)^[^"\\]*+(?:\\.[^"\\]*+)*+",(?:{_PAIR},)*+{_FLAT_NAME}="{_OPEN}'


def exits(piece: Column) -> tuple[Column, Column, Column]:
    """Whether a piece ends inside of a string when it begins outside, and when it begins inside,
    and whether no quote in it could end a string."""
    quoted = F.contains(piece, F.lit('"'))
    stays = ~quoted | piece.rlike(STAYS)
    return quoted & piece.rlike(OPENS), stays | piece.rlike(REOPENS), stays


_FOLLOWED = "file string, block bigint, place bigint, piece string, stays boolean, begin0 boolean, begin1 boolean, end0 boolean, end1 boolean, line0 bigint, line1 bigint"


def _states(block: np.ndarray, out: np.ndarray, ins: np.ndarray, carry: dict) -> list[np.ndarray]:
    """States before and after each piece and lines begun so far, under both states of its block.
    `carry` goes from batch to batch."""
    n = len(block)
    at = np.arange(n)
    fresh = np.ones(n, bool)
    fresh[1:] = block[1:] != block[:-1]
    fresh[0] = block[0] != carry["block"]
    first = np.maximum.accumulate(np.where(fresh, at, -1))
    # a piece with one exit for both states forgets what came before; one with crossed exits swaps
    fixed = out == ins
    swaps = np.cumsum(~fixed & out)
    last = np.maximum.accumulate(np.where(fixed, at, -1))
    known = last >= np.maximum(first, 0)
    begun = []
    after = []
    place = at - np.maximum(first, 0) + np.where(first < 0, carry["place"], 0)
    for h in (0, 1):
        start = np.where(first < 0, carry["state"][h], bool(h))
        swapped = swaps - np.where(known, swaps[np.maximum(last, 0)], np.where(first > 0, swaps[np.maximum(first, 1) - 1], 0))
        end = np.where(known, out[np.maximum(last, 0)], start) ^ (swapped % 2 == 1)
        begin = np.empty(n, bool)
        begin[1:] = end[:-1]
        begin[fresh] = bool(h)
        if not fresh[0]:
            begin[0] = carry["state"][h]
        lines = np.cumsum(~begin)
        lines -= np.where(first > 0, lines[np.maximum(first, 1) - 1], 0)
        lines += np.where(first < 0, carry["lines"][h], 0)
        begun.append((begin, lines))
        after.append(end)
    carry.update(block=block[-1], place=place[-1] + 1, state=[after[0][-1], after[1][-1]], lines=[begun[0][1][-1], begun[1][1][-1]])
    return [place, begun[0][0], begun[1][0], after[0], after[1], begun[0][1], begun[1][1]]


def follow(pieces: DataFrame) -> DataFrame:
    """Pieces in the order of their block, as the scan gives them, with both histories."""

    def run(batches: Iterator) -> Iterator:
        carry = {"block": None, "place": 0, "state": [False, True], "lines": [0, 0]}
        names: dict = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            # blocks by number, as a task may read several of several files
            keys = list(zip(batch.column("file").to_pylist(), batch.column("block").to_pylist(), strict=True))
            number = np.fromiter((names.setdefault(k, len(names)) for k in keys), np.int64, len(keys))
            out, ins = (np.asarray(batch.column(c)) for c in ("out", "ins"))
            cells = _states(number, out, ins, carry)
            arrays = [batch.column("file"), batch.column("block"), pa.array(cells[0]), batch.column("piece"), batch.column("stays"), *map(pa.array, cells[1:])]
            yield pa.RecordBatch.from_arrays(arrays, [f.split()[0] for f in _FOLLOWED.split(", ")])

    return pieces.mapInArrow(run, _FOLLOWED)


def _of(state: Column, name: str) -> Column:
    """The history that belongs to the block's state."""
    return F.when(state, F.col(f"{name}1")).otherwise(F.col(f"{name}0"))


def block_starts(followed: DataFrame) -> DataFrame:
    """State, lines and pieces before every block, and where its file's last string is left open."""
    last = [F.max_by(f"end{h}", "place").alias(f"end{h}") for h in (0, 1)]
    counts = [F.max(f"line{h}").alias(f"lines{h}") for h in (0, 1)]
    quoted = F.max(F.when(~F.col("stays"), F.col("place"))).alias("quoted")
    blocks = followed.groupBy("file", "block").agg(F.count("*").alias("n"), *last, *counts, quoted)
    order = Window.partitionBy("file").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    fixed = F.col("end0") == F.col("end1")
    blocks = blocks.withColumn("swaps", F.sum((~fixed & F.col("end0")).cast("long")).over(order))
    at = F.last(F.when(fixed, F.struct("end0", "swaps")), ignorenulls=True).over(before)
    swapped = F.coalesce(F.max("swaps").over(before), F.lit(0)) - F.coalesce(at["swaps"], F.lit(0))
    state = F.coalesce(at["end0"], F.lit(False)) != (swapped % 2 == 1)
    known = blocks.withColumn("state", state)
    known = known.withColumns({n: _of(F.col("state"), n) for n in ("lines", "end")})
    sums = {to: F.coalesce(F.sum(c).over(before), F.lit(0)) for to, c in (("lines_before", "lines"), ("pieces_before", "n"))}
    placed = known.withColumns(sums).withColumn("quoted", F.col("pieces_before") + F.col("quoted"))
    # a file's last string that is never closed opens where its last quote is; each later piece
    # is a line of its own
    whole = Window.partitionBy("file")
    open_end = F.max_by("end", "block").over(whole)
    open_at = F.when(open_end, F.max("quoted").over(whole))
    return placed.select("file", "block", "state", "lines_before", "pieces_before", open_at.alias("open_at"))


def read_logical_lines(spark: SparkSession, path: str | list[str], max_broadcast: int = 200_000) -> DataFrame:
    """(file, line, lp) of all lines below a path, numbered from 1 in each file, breaks inside of
    strings kept. A string that its file never closes ends with its own line, as do names and
    tag values with a break. Equal to `decode.split_body(multiline=True)` over whole files."""
    piece = F.col("value")
    out, ins, stays = exits(piece)
    scanned = spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        piece.alias("piece"),
        out.alias("out"),
        ins.alias("ins"),
        stays.alias("stays"),
    )
    stored = staged(follow(scanned), "pieces")
    starts = staged(block_starts(stored), "blocks")
    if is_small(starts, max_broadcast):
        starts = F.broadcast(starts)
    state = F.col("state")
    placed = stored.join(starts, ["file", "block"]).select(
        "file",
        (F.col("pieces_before") + F.col("place")).alias("nth"),
        (F.col("lines_before") + _of(state, "line")).alias("line"),
        "piece",
        _of(state, "begin").alias("inside"),
        _of(state, "end").alias("open"),
        "open_at",
    )
    loose = F.coalesce(F.col("nth") > F.col("open_at"), F.lit(False))
    last = F.coalesce(F.col("nth") == F.col("open_at"), F.lit(False)) & ~F.col("inside")
    own = loose | last | ~(F.col("inside") | F.col("open"))
    line = F.when(loose, F.col("line") + F.col("nth") - F.col("open_at")).otherwise(F.col("line"))
    single = placed.where(own).select("file", line.alias("line"), F.col("piece").alias("lp"))
    parts = F.sort_array(F.collect_list(F.struct("nth", "piece")))
    joined = placed.where(~own).groupBy("file", "line").agg(F.array_join(F.transform(parts, lambda p: p["piece"]), "\n").alias("lp"))
    ended = F.regexp_replace("lp", r"\r\z", "")
    return single.unionByName(joined).select("file", "line", ended.alias("lp"))
