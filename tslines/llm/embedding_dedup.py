"""Near duplicates among embeddings by spherical k-means cells.

Equal directions are one class first, so a vector repeated any number of times is compared
once. Centroids come from spherical k-means over a bounded sample; they steer the work and
never the result. Every class goes to its nearest centroid's cell, its home, and classes of
one cell or of a few lie together in blocks of bounded size. How far two vectors of different
homes lie from the plane between the centroids adds up to their distance at most, so of two
cells only classes near their plane meet, and no pair is lost.

Blocks are written once, and each pair of them is compared where they are read: vectors are
neither copied nor shuffled for the comparison, so it takes no disk. A pair of blocks gives
the number of partners of each member and a spanning forest of its links, not the links.
Vectors travel as they came, in 4 bytes a component where that is exact.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tslines.llm.common import runs, shuffle_partitions
from tslines.llm.simhash import components
from tslines.session import sql_conf, staged

THRESHOLD = 0.95
#: Classes and bytes of a block at most; so many classes are one block also in small tables.
TILE, TILE_BYTES, LEAST = 8192, 2 << 20, 256
#: Classes of a block that meet those of another at once.
STRIPE = 256
#: Parts that the blocks are read in, and the bytes of one at most.
PARTS, PART_BYTES = 24, 64 << 20
#: Blocks that a task keeps unpacked.
HELD = 8
#: Shuffle files go when the query that wrote them has ended, not when the driver collects garbage.
CLEANED = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
#: Cells at most, which bounds the broadcast centroids; sampled classes for each cell (expected),
#: and passes of k-means over them.
MAX_CELLS, SAMPLED, PASSES = 4096, 32, 5
#: Kept clear of rounding when a class decides which cells to visit.
SLACK = 1e-6


def matrix_of(column: pa.Array, dims: int) -> np.ndarray:
    """A list column as rows of doubles, shorter vectors padded with zeros; a null component
    is NaN, and so is all of a null vector."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.array(column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), np.int64)
    flat = column.flatten().cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), dims))
    starts = np.cumsum(lengths) - lengths
    out[np.repeat(np.arange(len(column)), lengths), np.arange(len(flat)) - np.repeat(starts, lengths)] = flat
    out[np.asarray(column.is_null())] = np.nan
    return out


def dimensions(df: DataFrame, vector: str) -> int:
    """Length of the longest vector, 1 at least."""
    return max(1, df.agg(F.max(F.size(vector)).alias("n")).first()["n"] or 0)


def directions(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors of rows, and which rows have one: finite, and not zero."""
    with np.errstate(invalid="ignore"):
        largest = np.abs(x).max(axis=1)
        good = np.isfinite(largest) & (largest > 0)
        x = np.where(good[:, None], x, 0) / np.where(good, largest, 1)[:, None]
    norm = np.sqrt((x * x).sum(axis=1))
    return x / np.where(good, norm, 1)[:, None] + 0.0, good


def component_type(df: DataFrame, vector: str) -> str:
    """What holds every component exactly: 4 bytes if 4 bytes came, 8 otherwise."""
    element = df.select(vector).schema[0].dataType.elementType.typeName()
    return "<f4" if element in ("float", "byte", "short") else "<f8"


def _unpacked(column: pa.Array, kind: str, dims: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), dims)


def _units(column: pa.Array, kind: str, dims: int) -> np.ndarray:
    return directions(_unpacked(column, kind, dims).astype(np.float64))[0]


def unit_rows(df: DataFrame, id_col: str, vector: str, dims: int) -> DataFrame:
    """(id, key, raw) of every row: the digest of its direction and the bytes of its
    components, null without a direction."""
    held = component_type(df, vector)

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            x = matrix_of(batch.column("vector"), dims)
            unit, good = directions(x)
            raw = np.where(good[:, None], x, 0).astype(held)
            keys = [hashlib.sha256(u.tobytes()).digest() if g else None for u, g in zip(unit, good, strict=True)]
            packed = [r.tobytes() if g else None for r, g in zip(raw, good, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(keys, pa.binary()), pa.array(packed, pa.binary())], ["id", "key", "raw"])

    rows = df.select(F.col(id_col).alias("id"), F.col(vector).alias("vector"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, key binary, raw binary")


def centroids(classes: DataFrame, count: int, cells: int, kind: str, dims: int, passes: int = PASSES) -> np.ndarray:
    """Spherical k-means over about `SAMPLED` classes for each cell, drawn by the hash of their key;
    the sums of a pass are made on the executors and only centroids come to the driver."""
    draw = F.pmod(F.xxhash64("key", F.lit("sample")), F.lit(1 << 30))
    share = min(1.0, SAMPLED * cells / count)
    sample = classes if share == 1.0 else staged(classes.where(draw < math.ceil(share * (1 << 30))), "sample")
    first = sample.select("key", "raw").orderBy("key").limit(cells).collect()
    means = _units(pa.array([bytes(r["raw"]) for r in first], pa.binary()), kind, dims)
    for _ in range(passes):
        held = classes.sparkSession.sparkContext.broadcast(means)

        def run(batches: Iterator, held=held) -> Iterator:
            middle = held.value
            sums, seen = np.zeros_like(middle), np.zeros(len(middle), bool)
            for batch in batches:
                unit = _units(batch.column("raw"), kind, dims)
                home = (unit @ middle.T).argmax(axis=1)
                np.add.at(sums, home, unit)
                seen[home] = True
            at = np.flatnonzero(seen)
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(list(sums[at]), pa.list_(pa.float64()))], ["cell", "sums"])

        sums = sample.select("raw").mapInArrow(run, "cell int, sums array<double>")
        found = sums.select("cell", F.posexplode("sums").alias("at", "x")).groupBy("cell", "at").agg(F.sum("x").alias("x")).toPandas()
        moved = np.zeros_like(means)
        moved[found["cell"], found["at"]] = found["x"]
        norm = np.linalg.norm(moved, axis=1)
        means = np.where(norm[:, None] > 0, moved / np.where(norm > 0, norm, 1)[:, None], means)
        held.unpersist()
    return means


def reach(threshold: float) -> float:
    """The largest distance of two unit vectors whose cosine is at least `threshold`."""
    return math.sqrt(max(0.0, 2 - 2 * threshold))


def cells_of(unit: np.ndarray, means: np.ndarray, apart: np.ndarray, threshold: float) -> tuple[np.ndarray, list[np.ndarray]]:
    """Home cell of each row, and the cells it visits: those behind a plane that is at most
    half the reach away. Centroids at one place have no plane between them, so both count."""
    near = unit @ means.T
    home = near.argmax(axis=1)
    gap = near[np.arange(len(unit)), home][:, None] - near
    visits = gap <= apart[home] * reach(threshold) / 2 + SLACK
    visits[np.arange(len(unit)), home] = False
    return home, [np.flatnonzero(v).astype(np.int32) for v in visits]


def homes(classes: DataFrame, means: np.ndarray, kind: str, dims: int) -> DataFrame:
    """The nearest cell of each class."""
    held = classes.sparkSession.sparkContext.broadcast(means)

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            home = (_units(batch.column("raw"), kind, dims) @ held.value.T).argmax(axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(home.astype(np.int32))], ["home"])

    return classes.select("raw").mapInArrow(run, "home int")


def laid_out(sizes: np.ndarray, tile: int) -> tuple[np.ndarray, np.ndarray, int]:
    """The first block of each cell, the number of blocks it is parted into, and the number of
    all blocks. Small cells share a block."""
    first, parts, blocks, room = np.zeros(len(sizes), np.int64), np.ones(len(sizes), np.int64), 0, 0
    for cell, size in enumerate(sizes.tolist()):
        if size > tile:
            first[cell], parts[cell], room = blocks, -(-size // tile), 0
            blocks += int(parts[cell])
            continue
        if size > room or not blocks:
            blocks, room = blocks + 1, tile
        first[cell], room = blocks - 1, room - size
    return first, parts, blocks


def blocks_of(classes: DataFrame, means: np.ndarray, threshold: float, kind: str, dims: int, tile: int) -> DataFrame:
    """One row for each block: its cells, those in which partners of its members may be at
    home, and its members' cells, nodes, numbers of rows and components, packed."""
    sizes = np.zeros(len(means), np.int64)
    for r in homes(classes, means, kind, dims).groupBy("home").count().collect():  # one row for each of at most MAX_CELLS cells
        sizes[r["home"]] = r["count"]
    first, parts, blocks = laid_out(sizes, tile)
    held = classes.sparkSession.sparkContext.broadcast(means)

    def deal(batches: Iterator) -> Iterator:
        for batch in batches:
            home = (_units(batch.column("raw"), kind, dims) @ held.value.T).argmax(axis=1)
            # consecutive numbers spread out over the parts
            mixed = (batch.column("node").to_numpy().astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
            block = first[home] + mixed.astype(np.int64) % parts[home]
            yield pa.RecordBatch.from_arrays([pa.array(block.astype(np.int32)), *batch.columns], ["block", *batch.schema.names])

    def run(batches: Iterator) -> Iterator:
        middle = held.value
        apart = np.sqrt(np.maximum(2 - 2 * middle @ middle.T, 0))
        for table in runs(batches, ["block"]):
            unit = _units(table.column("raw"), kind, dims)
            home, near = np.zeros(len(unit), np.int32), set()
            for at in range(0, len(unit), STRIPE):
                home[at : at + STRIPE], visits = cells_of(unit[at : at + STRIPE], middle, apart, threshold)
                near.update(np.unique(np.concatenate(visits)).tolist())
            cells = np.unique(home).tolist()
            order = np.argsort(home, kind="stable")
            packed = [home.astype("<i4"), *(table.column(c).to_numpy().astype("<i8") for c in ("node", "n")), _unpacked(table.column("raw"), kind, dims)]
            arrays = [pa.array([table.column("block")[0].as_py()], pa.int32()), pa.array([cells], pa.list_(pa.int32())), pa.array([sorted(near | {*cells})], pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays([*arrays, *(pa.array([x[order].tobytes()], pa.binary()) for x in packed)], ["block", "cells", "near", "home", "node", "n", "raw"])

    dealt = classes.select("node", "n", "raw").mapInArrow(deal, "block int, node long, n long, raw binary")
    ordered = dealt.repartition(blocks, "block").sortWithinPartitions("block")
    return ordered.mapInArrow(run, "block int, cells array<int>, near array<int>, home binary, node binary, n binary, raw binary")


class _Block:
    """A block's members, sorted by their cell."""

    def __init__(self, batch: pa.RecordBatch, at: int, side: str, kind: str, dims: int):
        home, node, n, raw = (batch.column(side + c)[at].as_buffer() for c in ("home", "node", "n", "raw"))
        self.node, self.n = np.frombuffer(node, "<i8").copy(), np.frombuffer(n, "<i8").copy()
        self.raw = np.frombuffer(raw, kind).reshape(-1, dims).copy()
        self.unit = np.empty(self.raw.shape, np.float32)
        for i in range(0, len(self.raw), STRIPE):
            self.unit[i : i + STRIPE] = self.exact(slice(i, i + STRIPE))
        self.cells, starts = np.unique(np.frombuffer(home, "<i4"), return_index=True)
        self.edges = [*starts.tolist(), len(self.node)]

    def exact(self, rows) -> np.ndarray:
        return directions(self.raw[rows].astype(np.float64))[0]


def _joined(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """`root`, the smallest member each member is known to reach, after the links (a, b)."""
    while True:
        one, other = root[a], root[b]
        open_ = one != other
        if not open_.any():
            return root
        a, b = a[open_], b[open_]
        np.minimum.at(root, np.maximum(one, other)[open_], np.minimum(one, other)[open_])
        while (root[root] != root).any():
            root = root[root]


def _stripes(one: _Block, other: _Block, i: int, j: int, means: np.ndarray, threshold: float, slack: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Members of the i-th cell of one block and of the j-th of another that may be partners, in
    stripes; pairs within a block's cell come twice."""
    x, y = np.arange(*one.edges[i : i + 2]), np.arange(*other.edges[j : j + 2])
    if one.cells[i] == other.cells[j]:
        for at in range(0, len(x), STRIPE):
            yield x[at : at + STRIPE], y[at:] if one is other else y
        return
    across = means[one.cells[i]] - means[other.cells[j]]
    most = np.linalg.norm(across) * reach(threshold) + slack
    across = across.astype(np.float32)
    # what lies between two vectors across the plane is their distance at most
    gap_x, gap_y = one.unit[x] @ across, -(other.unit[y] @ across)
    x, y = (v[g <= most - h.min()] for v, g, h in ((x, gap_x, gap_y), (y, gap_y, gap_x)))
    gap_x, gap_y = gap_x[gap_x <= most - gap_y.min()], gap_y[gap_y <= most - gap_x.min()]
    by_x, by_y = np.argsort(gap_x), np.argsort(gap_y)
    x, y, gap_x, gap_y = x[by_x], y[by_y], gap_x[by_x], gap_y[by_y]
    for at in range(0, len(x), STRIPE):
        end = int(np.searchsorted(gap_y, most - gap_x[at], "right"))
        if not end:
            return
        yield x[at : at + STRIPE], y[:end]


def _compare(one: _Block, other: _Block, means: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links of a pair of blocks as (node, root of its group in them), and (node, partners)."""
    same, shift = one is other, 0 if one is other else len(one.node)
    node = one.node if same else np.concatenate([one.node, other.node])
    root, partners = np.arange(len(node)), np.zeros(len(node), np.int64)
    dims = one.unit.shape[1]
    # what a product of units in 4 bytes may be off; pairs so near to the threshold are decided in 8
    slack = (dims + 8) * 2.0**-23
    for i, j in ((i, j) for i in range(len(one.cells)) for j in range(i if same else 0, len(other.cells))):
        for x, y in _stripes(one, other, i, j, means, threshold, 4 * slack):
            near = one.unit[x] @ other.unit[y].T
            if near.max(initial=-2) < threshold - slack:
                continue
            a, b = np.nonzero(near >= threshold - slack)
            if same and i == j:
                a, b = a[x[a] < y[b]], b[x[a] < y[b]]
            doubt = np.flatnonzero(near[a, b] < threshold + slack)
            if len(doubt):
                out, step = np.zeros(len(doubt), bool), max(1, (1 << 20) // dims)
                for at in range(0, len(doubt), step):
                    d = doubt[at : at + step]
                    out[at : at + step] = (one.exact(x[a[d]]) * other.exact(y[b[d]])).sum(axis=1) < threshold
                a, b = np.delete(a, doubt[out]), np.delete(b, doubt[out])
            a, b = x[a], y[b]
            np.add.at(partners, a, other.n[b])
            np.add.at(partners, b + shift, one.n[a])
            root = _joined(root, a, b + shift)
    met = np.flatnonzero(partners)
    joined = np.flatnonzero(root != np.arange(len(node)))
    return np.stack([node[joined], node[root[joined]]], 1), node[met], partners[met]


def compared(blocks: DataFrame, means: np.ndarray, threshold: float, kind: str, dims: int) -> DataFrame:
    """(a, b, n): links (a, b), and the number n of partners of a where b is null. Each pair
    of blocks is one row of a product that reads the written blocks; nothing is shuffled."""
    held = blocks.sparkSession.sparkContext.broadcast(means)

    def run(batches: Iterator) -> Iterator:
        kept: dict[int, _Block] = {}

        def block(batch: pa.RecordBatch, at: int, side: str) -> _Block:
            number = batch.column(side + "block")[at].as_py()
            found = kept.pop(number, None) or _Block(batch, at, side, kind, dims)
            if len(kept) >= HELD:
                kept.pop(next(iter(kept)))  # what was used longest ago
            kept[number] = found
            return found

        for batch in batches:
            for at in range(batch.num_rows):
                links, node, partners = _compare(block(batch, at, "a_"), block(batch, at, "b_"), held.value, threshold)
                if len(node):
                    a = pa.array(np.concatenate([links[:, 0], node]))
                    b = pa.array(np.concatenate([links[:, 1], node]), mask=np.arange(len(links) + len(node)) >= len(links))
                    yield pa.RecordBatch.from_arrays([a, b, pa.array(np.concatenate([np.zeros(len(links), np.int64), partners]))], ["a", "b", "n"])

    one, other = (blocks.select(*(F.col(c).alias(side + c) for c in blocks.columns)) for side in ("a_", "b_"))
    # of (a, b) and (b, a) one, so that half of every task's pairs are left
    in_order = F.when((F.col("a_block") + F.col("b_block")) % 2 == 0, F.col("a_block") <= F.col("b_block")).otherwise(F.col("a_block") > F.col("b_block"))
    may_meet = F.arrays_overlap("a_cells", "b_near") | F.arrays_overlap("b_cells", "a_near")
    return one.join(other.hint("shuffle_replicate_nl"), in_order & may_meet).mapInArrow(run, "a long, b long, n long")


def near_vectors(df: DataFrame, id_col: str = "vec_id", vector: str = "embedding", threshold: float = THRESHOLD, cells: int | None = None, tile: int | None = None) -> DataFrame:
    """The id of every row, `n_links`, `component_id` and `kept`: the number of other rows whose
    cosine with it is at least `threshold`, the smallest id reachable over such links, its own
    included, and whether that is its own.

    Vectors that are null, empty or zero, or hold a null or non-finite component, link with
    nothing. Shorter vectors count as padded with zeros. Repeated rows are rows of their own,
    which link with each other. Null ids are passed over for a component's id unless it has
    no other. Empty tables give no rows; other columns are not read. `threshold` must lie in
    (0, 1]. `cells` and `tile`, the classes of a block, only change how the work is dealt.
    """
    if not 0 < threshold <= 1:
        raise ValueError(f"threshold must lie above 0 and not above 1, not {threshold}")
    with sql_conf(df.sparkSession, CLEANED):
        return _near_vectors(df, id_col, vector, threshold, cells, tile)


def _near_vectors(df: DataFrame, id_col: str, vector: str, threshold: float, cells: int | None, tile: int | None) -> DataFrame:
    spark, dims, kind = df.sparkSession, dimensions(df, vector), component_type(df, vector)
    rows = staged(unit_rows(df, id_col, vector, dims), "units")
    # any row of a direction has the same unit vector, to the bit
    found = rows.where("key is not null").groupBy("key").agg(F.any_value("raw").alias("raw"), F.count("*").alias("n"), F.min("id").alias("best"))
    # numbers of the written rows, so that every later pass has the same
    classes = staged(found.withColumn("node", F.monotonically_increasing_id()), "directions")
    count = classes.count()
    lone = rows.where("key is null").select(F.col("id"), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    if not count:
        return _result(lone, id_col)
    k = cells or min(MAX_CELLS, math.ceil(math.sqrt(count) / 3))
    width = dims * np.dtype(kind).itemsize
    tile = tile or max(1, min(TILE, TILE_BYTES // width, max(LEAST, -(-count // (2 * shuffle_partitions(spark))))))
    means = centroids(classes, count, min(k, count), kind, dims)
    blocks = staged(blocks_of(classes, means, threshold, kind, dims, tile), "blocks")
    part = min(PART_BYTES, max(1 << 20, count * width // PARTS))
    with sql_conf(spark, {"spark.sql.files.maxPartitionBytes": str(part), "spark.sql.files.openCostInBytes": "65536"}):
        met = staged(compared(blocks, means, threshold, kind, dims), "met")

    partners = met.where("b is null").groupBy("a").agg(F.sum("n").alias("partners"))
    roots = staged(components(met.where("b is not null").select("a", "b")), "roots")
    known = classes.select("key", "node", "n", "best").join(partners, F.col("node") == F.col("a"), "left").drop("a")
    known = known.join(roots.withColumnRenamed("node", "a"), F.col("node") == F.col("a"), "left").withColumn("root", F.coalesce("root", "node"))
    least = known.groupBy("root").agg(F.min("best").alias("component_id"))
    known = known.join(least, "root").select("key", (F.coalesce("partners", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id")
    linked = rows.where("key is not null").select("id", "key").join(staged(known, "known"), "key")
    return _result(linked.select("id", "n_links", "component_id").unionByName(lone), id_col)


def _result(rows: DataFrame, id_col: str) -> DataFrame:
    return rows.select(F.col("id").alias(id_col), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
