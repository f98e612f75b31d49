"""Near copies by SimHash, verified by the Jaccard similarity of their word shingles.

A text has `PRINTS` independently seeded SimHashes of its five-word shingles, cut into blocks of
`BLOCK` bits. At similarity 0.8 two texts differ in about 15 % of their bits, so they share none
of the 80 blocks with probability (1 - 0.85^12)^80, 6e-6, and less above. Texts that share a
block and differ in at most `RADIUS` bits of their first `CHECKED` prints are linked, and the
components of these links are the candidate classes. In each class whole shingle sets meet,
and similarity is counted on them. Sets meet in tiles of bounded size, which give the links
of a spanning forest and not all pairs, so the result is the closure of all similar pairs met.
Groups larger than a tile are parted; only texts that are not joined then meet those of other parts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tslines.llm import simhash
from tslines.llm.common import runs, text_batches, whole_text
from tslines.session import staged

#: Words of a shingle, and the least similarity of near copies as a fraction.
WIDTH, LEAST = 5, (4, 5)
#: SimHashes of a text and bits of a block; 4,096 values of each of 80 blocks.
PRINTS, BLOCK = 16, 12
#: Differing bits of the first `CHECKED` prints, and of the first alone, up to which texts are
#: candidates. At similarity 0.8 these are 29 and 9.7 of 192 and 64, deviations 5.0 and 2.9;
#: unrelated texts differ in 96 and 32.
CHECKED, RADIUS, FIRST_RADIUS = 3, 54, 24
#: Members of one block compared in one tile.
MEMBERS = 1 << 12
#: Shingles compared in one tile, about; two parts of a large group make a tile.
TILE = 1 << 18


def shingle_set(text: str, width: int = WIDTH) -> np.ndarray:
    """The distinct shingle hashes of a text, sorted."""
    return np.unique(np.frombuffer(simhash.shingle_hashes(text, width), np.uint64))


def _close(one: np.ndarray, others: np.ndarray) -> np.ndarray:
    return np.bitwise_count(one ^ others).sum(axis=-1, dtype=np.int64) <= RADIUS


def _any_close(prints: np.ndarray) -> np.ndarray:
    """The members that are close to another one."""
    first = np.ascontiguousarray(prints[:, 0])
    found = np.zeros(len(prints), bool)
    for at in range(0, len(prints), 256):
        i, j = np.nonzero(np.bitwise_count(first[at : at + 256, None] ^ first[None, at:]) <= FIRST_RADIUS)
        i, j = i[j > i] + at, j[j > i] + at
        near = np.zeros(len(i), bool)
        for low in range(0, len(i), 1 << 16):
            some = slice(low, low + (1 << 16))
            near[some] = _close(prints[i[some]], prints[j[some]])
        found[i[near]] = found[j[near]] = True
    return found


def close_links(fps: np.ndarray, prints: np.ndarray) -> list[tuple[int, int]]:
    """Links that join the members of one block that are reachable in close steps. Members may
    have the same `fps`: those of one text or of texts that are joined already."""
    some = np.flatnonzero(_any_close(prints))
    links = []
    while len(some):
        front, some = [some[0]], some[1:]
        reached = list(front)
        while front and len(some):
            near = _close(prints[front.pop()], prints[some])
            if near.any():
                front += some[near].tolist()
                reached += some[near].tolist()
                some = some[~near]
        links += simhash.star(fps[reached])
    return links


def spanning_links(prints: list[int], sets: list[np.ndarray], least: tuple[int, int] = LEAST) -> list[tuple[int, int]]:
    """Links that join all members reachable from each other in steps of similarity `least`
    or more: each member is reached once, so a group of n gives less than n links."""
    if len(sets) < 2:
        return []
    part, whole = least
    sizes = np.array([len(s) for s in sets])
    places = np.concatenate([[0], np.cumsum(sizes)])
    names, ids = np.unique(np.concatenate(sets), return_inverse=True)
    left, links = np.ones(len(sets), bool), []
    open_ids, owners = ids, np.repeat(np.arange(len(sets)), sizes)
    own = np.zeros(len(names), bool)
    for first in range(len(sets)):
        if not left[first]:
            continue
        left[first], front = False, [first]
        reached = [first]
        while front and left.any():
            at = front.pop()
            mine = ids[places[at] : places[at + 1]]
            own[mine] = True
            shared = np.bincount(owners[own[open_ids]], minlength=len(sets))
            own[mine] = False
            # shared / (a + b - shared) >= part / whole, in whole numbers
            near = np.flatnonzero(left & (shared * (part + whole) >= part * (sizes + sizes[at])))
            if len(near):
                front += near.tolist()
                reached += near.tolist()
                left[near] = False
                still = left[owners]
                open_ids, owners = open_ids[still], owners[still]
        links += simhash.star([prints[i] for i in reached])
    return links


def signatures(df: DataFrame, id_col: str, text: str) -> DataFrame:
    """(sha, id, fp, size, prints) of every row; fp stands for the set of shingles."""

    def run(batches: Iterator) -> Iterator:
        for batch, texts in text_batches(batches):
            sets = [shingle_set(t) for t in texts]
            prints = np.array([xxhash.xxh3_64_intdigest(s.tobytes()) for s in sets], np.uint64).view(np.int64)
            sizes = pa.array([len(s) for s in sets], pa.int64())
            seeded = pa.array([simhash.seeded_prints(s, PRINTS).view(np.int64) for s in sets], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(prints), sizes, seeded], ["sha", "id", "fp", "size", "prints"])

    rows = df.select(simhash.text_sha(text).alias("sha"), F.col(id_col).alias("id"), whole_text(text).alias("text"))
    return rows.mapInArrow(run, f"sha binary, id {rows.schema['id'].dataType.simpleString()}, fp long, size long, prints array<long>")


def _own(key: str, parts: Column, seed: int = 0) -> Column:
    """The one tile of a text among those of its group."""
    return F.xxhash64(key, F.pmod(F.xxhash64("fp", F.lit(seed)), parts))


def candidates(prints: DataFrame, members: int = MEMBERS) -> DataFrame:
    """Links (a, b) over `prints.fp`: their components hold all close texts with a common block.

    The texts of a block beyond `members` are dealt to several tiles, one each, and those that
    no block has joined meet in a second pass.
    """
    blocks = simhash.BITS // BLOCK
    cut = [
        F.shiftrightunsigned(F.col("prints")[i], b * BLOCK).bitwiseAND(F.lit((1 << BLOCK) - 1)) + F.lit((i * blocks + b) << BLOCK)
        for i in range(PRINTS)
        for b in range(blocks)
    ]
    checked = [F.col("prints")[i].alias(f"p{i}") for i in range(CHECKED)]
    keyed = prints.select("fp", *checked, F.explode(F.array(*cut)).alias("key"))
    # at most one row per block and value, whatever the number of texts
    large = staged(keyed.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > members), "large")
    parts = F.coalesce(F.ceil(F.col("n") / members), F.lit(1))
    names = [f"p{i}" for i in range(CHECKED)]

    def run(batches: Iterator) -> Iterator:
        for group in runs(batches, ["tile"]):
            if group.num_rows > 1:
                seeds = np.stack([group.column(n).to_numpy() for n in names], 1).view(np.uint64)
                found = close_links(group.column("fp").to_numpy(), seeds)
                if found:
                    yield _batch(found)

    def met(tiled: DataFrame) -> DataFrame:
        dealt = tiled.repartition("tile").sortWithinPartitions("tile")
        return simhash.hung(dealt.select("tile", "fp", *names).mapInArrow(run, "a long, b long"))

    found = met(keyed.join(F.broadcast(large), "key", "left").select("fp", *names, _own("key", parts).alias("tile")))
    if large.isEmpty():
        return found
    found = staged(found, "close")
    among = keyed.join(F.broadcast(large.select("key")), "key").withColumn("weight", F.lit(1))
    rest = simhash.apart(among, staged(simhash.components(found), "joined"), members)
    return found.unionByName(met(rest.select(F.col("root").alias("fp"), *names, "tile")))


def grouped(prints: DataFrame, tile: int = TILE) -> DataFrame:
    """(key, fp, weight, parts) of the texts in candidate classes: the class, the number of
    shingles, and the tiles that the class is dealt to."""
    roots = staged(simhash.components(candidates(prints)), "candidates")
    rooted = prints.select("fp", F.col("size").alias("weight")).join(roots.select(F.col("node").alias("fp"), F.col("root").alias("key")), "fp")
    groups = rooted.groupBy("key").agg(F.count("*").alias("n"), F.sum("weight").alias("all"))
    parts = F.greatest(F.lit(1), F.least(F.ceil(F.col("all") / tile), F.col("n"))).cast("int")
    return rooted.join(groups.select("key", parts.alias("parts")), "key")


def shingle_sets(df: DataFrame, wanted: DataFrame, id_col: str, text: str) -> DataFrame:
    """(fp, shingles) of the texts whose (fp, best) are `wanted`."""

    def run(batches: Iterator) -> Iterator:
        for batch, texts in text_batches(batches):
            sets = [shingle_set(t).view(np.int64) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column("fp"), pa.array(sets, pa.list_(pa.int64()))], ["fp", "shingles"])

    key = F.struct(F.col(id_col).alias("id"), simhash.text_sha(text).alias("sha"))
    texts = df.select(key.alias("key"), whole_text(text).alias("text"))
    some = texts.join(wanted.select("fp", F.struct("best.id", "best.sha").alias("key")), "key")
    # rows with the same id and text give one set
    return some.select("fp", "text").mapInArrow(run, "fp long, shingles array<long>").dropDuplicates(["fp"])


def links(df: DataFrame, prints: DataFrame, id_col: str, text: str, tile: int = TILE) -> DataFrame:
    """Links (a, b) over `prints.fp`; their closure is that of all similar pairs of a
    candidate class.

    A class beyond `tile` is dealt to several tiles, a text to one, then dealt anew, which
    joins what the first tiles found; texts that are still apart meet in a third pass.
    """
    members = staged(grouped(prints, tile), "members")
    sets = shingle_sets(df, prints.join(members.select("fp"), "fp", "left_semi"), id_col, text)

    def run(batches: Iterator) -> Iterator:
        now, prints, sets = None, [], []
        for batch in batches:
            found = []
            numbers, values = batch.column("shingles").value_lengths().to_numpy(), batch.column("shingles").flatten().to_numpy()
            cuts = np.split(values, np.cumsum(numbers)[:-1]) if len(numbers) else []
            for at, root, shingles in zip(batch.column("tile").to_pylist(), batch.column("root").to_pylist(), cuts, strict=True):
                if at != now:
                    found += spanning_links(prints, sets)
                    now, prints, sets = at, [], []
                prints.append(root)
                # a copy, so that the batch can go
                sets.append(shingles.copy())
            yield _batch(found)
        yield _batch(spanning_links(prints, sets))

    def met(tiled: DataFrame) -> DataFrame:
        dealt = tiled.join(sets, "fp").repartition("tile").sortWithinPartitions("tile", "fp")
        return dealt.select("tile", "root", "shingles").mapInArrow(run, "a long, b long").distinct()

    def once(some: DataFrame, seed: int) -> DataFrame:
        return met(some.select("fp", F.col("fp").alias("root"), _own("key", F.col("parts"), seed).alias("tile")))

    large = members.where("parts > 1")
    if large.isEmpty():
        return once(members, 0)
    sets = staged(sets, "sets")
    found = staged(once(members, 0).unionByName(once(large, 1)), "similar")
    rest = simhash.apart(large.drop("parts"), staged(simhash.components(found), "joined"), tile)
    return found.unionByName(met(rest.select("fp", "root", "tile")))


def _batch(found: list[tuple[int, int]]) -> pa.RecordBatch:
    both = np.array(found, np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["a", "b"])


def drop_similar(df: DataFrame, id_col: str = "doc_id", text: str = "text", tile: int = TILE) -> DataFrame:
    """One row of each group of near copies, the one with the smallest id; columns as they are.

    A group is the closure of pairs with similarity `LEAST` or more. Null counts as empty;
    texts without words are alike. Of rows with the smallest id the one whose text has the
    smallest SHA-256 stays, and one of them if texts are equal too.
    """
    rows = staged(signatures(df, id_col, text), "signatures")
    more = [F.any_value("size").alias("size"), F.any_value("prints").alias("prints")]
    found = simhash.classes(rows, simhash.by_id(), lambda prints: links(df, prints, id_col, text, tile), *more)
    return simhash.keep_best(df, found, id_col, text)
