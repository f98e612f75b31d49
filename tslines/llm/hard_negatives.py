"""Hard negatives by exact integer products in residue numbers.

Components are whole numbers, so a score is one too. Its residue modulo a small prime comes
from a matrix product of centred residues in float32, which is exact as long as sums stay
below 2^24; several primes give the score back by Chinese remaindering, signs included.

The anchors are the stated query set and meet all rows in blocks: rows are packed where
they lie, anchors into groups of bounded size, and every block of rows is paired with
every group. A task keeps the best candidates of each anchor and merges its own before
anything is shuffled. Positives are found first; the second pass looks for negatives below
each of them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tslines.llm.common import broadcast_if_small
from tslines.llm.embedding_dedup import dimensions, matrix_of
from tslines.session import staged

#: Primes below 1024: 64 products of centred residues stay below 2^24.
PRIMES, DEPTH = (1021, 1019, 1013, 1009, 997, 991), 64
#: Scores must lie below this, so that their multiples by 19 fit in 64 bits.
MAX_SCORE = 1 << 58
#: Rows of a block, anchors of a group (expected), groups up to which they are broadcast,
#: and candidates that a task holds.
BLOCK, GROUP, MAX_GROUPS, HELD = 4096, 1024, 64, 500_000


def residues(x: np.ndarray, prime: int) -> np.ndarray:
    """Whole numbers modulo a prime, centred on zero, as float32."""
    half = prime // 2
    return ((x + half) % prime - half).astype(np.float32)


def exact_products(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of the rows of `a` with the rows of `x`, exact."""
    bound = a.shape[1] * int(np.abs(a).max(initial=0)) * int(np.abs(x).max(initial=0))
    if bound >= MAX_SCORE:
        raise ValueError(f"scores may reach {bound}; components are too large for exact 64-bit scores")
    # mixed radix: digits of the score in the number system of the primes
    scores = np.zeros((len(a), len(x)), np.int64)
    weight = 1
    for prime in PRIMES:
        p, q = residues(a, prime), residues(x, prime)
        found = np.zeros(scores.shape, np.int64)
        for at in range(0, a.shape[1], DEPTH):
            found += (p[:, at : at + DEPTH] @ q[:, at : at + DEPTH].T).astype(np.int64)
        half = prime // 2
        digit = ((found - scores) % prime * pow(weight, -1, prime) + half) % prime - half
        scores += digit * weight
        weight *= prime
        if weight > 2 * bound + 1:
            break
    return scores


def vectors(df: DataFrame, id_col: str, vector: str, label: str, dims: int, shift: tuple[int, int] | None) -> DataFrame:
    """(uid, id, label, ints) of the rows that take part, written once: whole-number components as packed
    64-bit numbers."""

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            x = np.floor(256 * matrix_of(batch.column("vector"), dims))
            good = np.isfinite(x).all(axis=1)
            if (np.abs(x[good]) >= MAX_SCORE).any():
                raise ValueError("components are too large for exact 64-bit scores")
            whole = np.where(good[:, None], x, 0).astype(np.int64)
            packed = [w.tobytes() if g else None for w, g in zip(whole, good, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.array(packed, pa.binary())], ["id", "label", "ints"])

    given = F.col(label).cast("long")
    if shift:
        every, labels = shift
        given = F.when(F.col(id_col) % every == 0, F.pmod(given + 1, F.lit(labels))).otherwise(given)
    rows = df.where(F.col(label).isNotNull() & F.col(vector).isNotNull())
    rows = rows.select(F.col(id_col).cast("long").alias("id"), given.alias("label"), F.col(vector).alias("vector"))
    read = rows.mapInArrow(run, "id long, label long, ints binary").where("ints is not null")
    return staged(read.withColumn("uid", F.monotonically_increasing_id()), "vectors")


_PACKED = "uids array<long>, ids array<long>, labels array<long>, ints binary"


def _pack(table: pa.Table) -> list:
    """Columns of one block, rows by id with null ids last."""
    table = table.sort_by([("id", "ascending"), ("uid", "ascending")])
    lists = [pa.array([table.column(c).to_pylist()], pa.list_(pa.int64())) for c in ("uid", "id", "label")]
    return [*lists, pa.array([b"".join(table.column("ints").to_pylist())], pa.binary())]


def row_blocks(rows: DataFrame, size: int = BLOCK) -> DataFrame:
    """Rows packed into blocks inside their partition."""

    def run(batches: Iterator) -> Iterator:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            while n >= size:
                whole = pa.Table.from_batches(held)
                yield pa.RecordBatch.from_arrays(_pack(whole.slice(0, size)), ["uids", "ids", "labels", "ints"])
                held, n = whole.slice(size).to_batches(), n - size
        if n:
            yield pa.RecordBatch.from_arrays(_pack(pa.Table.from_batches(held)), ["uids", "ids", "labels", "ints"])

    return rows.select("uid", "id", "label", "ints").mapInArrow(run, _PACKED)


def anchor_groups(anchors: DataFrame) -> DataFrame:
    """Anchors (grp, uid, ...) as one packed row for each group, with lists of the positives' places,
    ids and scores where there are any."""
    cells = F.sort_array(F.collect_list(F.struct("uid", "id", "label", "ints", "positives")))
    packed = anchors.groupBy("grp").agg(cells.alias("cells"))

    def part(name: str) -> Column:
        return F.transform("cells", lambda c: c[name])

    return packed.select(
        "grp", part("uid").alias("a_uids"), part("id").alias("a_ids"), part("label").alias("a_labels"), part("ints").alias("a_ints"), part("positives").alias("positives")
    )


def paired(blocks: DataFrame, groups: DataFrame, count: int) -> DataFrame:
    """Every block of rows with every group of anchors."""
    each = blocks.withColumn("grp", F.explode(F.sequence(F.lit(0), F.lit(count - 1))))
    return each.join(broadcast_if_small(groups, MAX_GROUPS), "grp")


def _longs(column: pa.Array, at: int) -> tuple[np.ndarray, np.ndarray]:
    """One list of numbers, and which are null."""
    values = column[at].values
    return values.fill_null(0).to_numpy(zero_copy_only=False), np.asarray(values.is_null())


def _block(batch: pa.RecordBatch, at: int, a: str = "") -> tuple:
    ints = batch.column(f"{a}ints")[at].as_py()
    ints = b"".join(ints) if isinstance(ints, list) else ints
    uids, labels = (_longs(batch.column(f"{a}{c}"), at)[0] for c in ("uids", "labels"))
    ids, none = _longs(batch.column(f"{a}ids"), at)
    return uids, ids, none, labels, np.frombuffer(ints, np.int64).reshape(len(uids), -1)


_LOWEST = np.iinfo(np.int64).min


def best_of(scores: np.ndarray, allowed: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the best `count` allowed scores of each row; of equal ones the first."""
    left = np.where(allowed, scores, _LOWEST)
    at, found = np.arange(len(left)), []
    for _ in range(min(count, left.shape[1])):
        col = left.argmax(axis=1)
        some = left[at, col] != _LOWEST
        found.append(np.stack([at[some], col[some]]))
        left[at, col] = _LOWEST
    pairs = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
    return pairs[0], pairs[1]


class _Best:
    """Candidates (key, id, none, uid, score) of a task, cut to the best of each key when many."""

    def __init__(self, count: int):
        self.count, self.parts, self.held = count, [], 0

    def add(self, *columns: np.ndarray) -> None:
        self.parts.append(columns)
        self.held += len(columns[0])

    def cut(self) -> list[np.ndarray]:
        columns = [np.concatenate(c) for c in zip(*self.parts, strict=True)]
        *key, cid, none, uid, score = columns
        order = np.lexsort((uid, cid, none, -score, *key[::-1]))
        columns = [c[order] for c in columns]
        starts = np.r_[True, np.any([k[order][1:] != k[order][:-1] for k in key], axis=0)]
        place = np.arange(len(order)) - np.maximum.accumulate(np.where(starts, np.arange(len(order)), 0))
        columns = [c[place < self.count] for c in columns]
        self.parts, self.held = [tuple(columns)], int((place < self.count).sum())
        return columns


def _emit(columns: list[np.ndarray], names: list[str]) -> pa.RecordBatch:
    *key, cid, none, uid, score = columns
    arrays = [*(pa.array(k) for k in key), pa.array(cid, mask=none.astype(bool)), pa.array(uid), pa.array(score)]
    return pa.RecordBatch.from_arrays(arrays, names)


def _searched(pairs: DataFrame, names: list[str], count: int, held: int, candidates) -> DataFrame:
    """Best candidates of each key over all pairs of blocks; `candidates` gives those of one pair."""

    def run(batches: Iterator) -> Iterator:
        best = _Best(count)
        for batch in batches:
            for at in range(batch.num_rows):
                for columns in candidates(batch, at):
                    best.add(*columns)
                if best.held > held:
                    best.cut()
                    if best.held > held / 2:
                        yield _emit(best.cut(), names)
                        best = _Best(count)
        if best.held:
            yield _emit(best.cut(), names)

    found = pairs.mapInArrow(run, ", ".join(f"{n} long" for n in names))
    order = Window.partitionBy(*names[:-3]).orderBy(F.desc("score"), F.asc_nulls_last(names[-3]), names[-2])
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)


def mine(
    df: DataFrame,
    id_col: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    every: int = 50,
    positives: int = 5,
    negatives: int = 3,
    shift: tuple[int, int] | None = None,
    block: int = BLOCK,
    group: int = GROUP,
    held: int = HELD,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of each anchor
    and each of its first `positives` other rows of the same label: the first `negatives` rows of
    other labels whose score lies between a half and 95 % of the positive's.

    Anchors are rows whose id is divisible by `every`. `shift` = (m, labels) moves the label of ids
    divisible by m on by one, modulo `labels`. Rows with a null label, a null vector or a
    null or non-finite component take no part; shorter vectors count as padded with zeros.
    Rows with a null id are no anchors and come last in ties. Repeated rows are rows of
    their own: others for each other, and each an anchor. Scores are exact; vectors whose scores
    could reach 2^58 raise an error. Empty tables give no rows. Other columns are not read.
    """
    rows = vectors(df, id_col, vector, label, dimensions(df, vector), shift)
    anchors = rows.where(F.col("id") % every == 0)
    groups = max(1, math.ceil(anchors.count() / group))
    anchors = anchors.withColumn("grp", F.pmod(F.xxhash64("uid"), F.lit(groups)).cast("int"))
    blocks = staged(row_blocks(rows, block), "blocks")
    score_kind = "array<struct<rank:int,id:long,score:long>>"

    def same(batch: pa.RecordBatch, at: int) -> Iterator[tuple]:
        a_uid, _, _, a_label, a = _block(batch, at, "a_")
        uid, ids, none, labels, x = _block(batch, at)
        scores = exact_products(a, x)
        i, j = best_of(scores, (a_label[:, None] == labels) & (a_uid[:, None] != uid), positives)
        yield a_uid[i], ids[j], none[j], uid[j], scores[i, j]

    plain = staged(anchor_groups(anchors.withColumn("positives", F.lit(None).cast(score_kind))), "anchors")
    near = _searched(paired(blocks, plain, groups), ["anchor", "id", "uid", "score"], positives, held, same)
    near = near.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("rank", "id", "score"))).alias("positives"))
    known = staged(near, "positives")

    def different(batch: pa.RecordBatch, at: int) -> Iterator[tuple]:
        a_uid, _, _, a_label, a = _block(batch, at, "a_")
        uid, ids, none, labels, x = _block(batch, at)
        scores = exact_products(a, x)
        unlike = a_label[:, None] != labels
        given = batch.column("positives")[at].as_py()
        for rank in range(1, positives + 1):
            has = np.array([len(p or ()) >= rank for p in given], bool)
            if not has.any():
                continue
            top = np.array([p[rank - 1]["score"] for p, h in zip(given, has, strict=True) if h], np.int64)
            # whole scores between a half and 19/20 of the positive's
            inside = (scores[has] >= -(-top // 2)[:, None]) & (scores[has] <= (19 * top // 20)[:, None])
            i, j = best_of(scores[has], inside & unlike[has], negatives)
            who = a_uid[has][i]
            yield who, np.full(len(who), rank, np.int64), ids[j], none[j], uid[j], scores[has][i, j]

    full = staged(anchor_groups(anchors.join(known, F.col("uid") == F.col("anchor")).drop("anchor")), "anchors")
    far = _searched(paired(blocks, full, groups), ["anchor", "nth", "id", "uid", "score"], negatives, held, different)
    named = anchors.select(F.col("uid").alias("anchor"), F.col("id").alias("anchor_id")).join(known, "anchor")
    named = named.select("anchor", "anchor_id", F.inline("positives")).withColumnsRenamed({"rank": "nth", "id": "positive_id", "score": "positive_score"})
    return far.join(named, ["anchor", "nth"]).select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
