"""Near duplicates by SimHash and pigeonhole blocks.

A fingerprint's 64 bits are parted into blocks. Two fingerprints that differ in at most
`radius` bits agree in all blocks but `radius` at most, so every choice of
`blocks - radius` blocks is a key, and close pairs share one. More blocks give longer keys
and fewer chance meetings; their number follows the number of distinct fingerprints, and
no choice loses a pair. Only keys met twice are joined. Within a key, members are compared
in tiles of bounded size; a tile gives the links of a spanning forest, not all its pairs,
which leaves the components as they are. Components are found by star contraction.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tslines.llm.common import text_batches, whole_text
from tslines.session import staged

BITS, RADIUS, WIDTH, SEED = 64, 3, 3, 42
#: Members of one key compared in one tile.
TILE = 1 << 12

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def shingle_hashes(text: str, width: int = WIDTH, seed: int = SEED) -> bytes:
    """The hashes of a text's word shingles, eight bytes each; a text of fewer words is one
    shingle, one without words has none."""
    # bytes.split without arguments parts at exactly the white space of the contract
    words = text.encode().translate(_LOWER).split()
    if not words:
        return b""
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate([[0], ends[:-1]])
    n = max(1, len(words) - width + 1)
    digest = xxhash.xxh64_digest
    last = (ends[min(width, len(words)) - 1 :] - 1).tolist()
    return b"".join([digest(joined[a:b], seed) for a, b in zip(starts[:n].tolist(), last, strict=True)])


def fingerprint(text: str, width: int = WIDTH, seed: int = SEED) -> int:
    """The SimHash of a text's word shingles, unsigned; 0 without words."""
    table = np.frombuffer(shingle_hashes(text, width, seed), np.uint8).reshape(-1, 8)
    total, n = np.zeros(BITS, np.int64), len(table)
    for at in range(0, n, 1 << 16):
        total += np.unpackbits(table[at : at + (1 << 16)], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > n).tobytes(), "big")


def seeded_prints(hashes: np.ndarray, count: int) -> np.ndarray:
    """`count` independent SimHashes of the same shingles: a bit is set if it is in over half of
    the hashes, which are mixed anew with each seed."""
    seeds = np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    total = np.zeros(BITS * count, np.int64)
    for at in range(0, len(hashes), 1 << 10):
        # the finish of splitmix64, so that every bit hangs on all bits of the hash
        h = np.add.outer(hashes[at : at + (1 << 10)], seeds)
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        h ^= h >> np.uint64(31)
        total += np.unpackbits(h.view(np.uint8), axis=1).sum(axis=0, dtype=np.uint16)
    return np.packbits(2 * total > len(hashes)).view(np.uint64)


def fingerprints(df: DataFrame, id_col: str = "doc_id", text: str = "text", width: int = WIDTH, keep: list[Column] | None = None) -> DataFrame:
    """(id, fp) of every row, fp a signed long, after the columns `keep`."""

    def run(batches: Iterator) -> Iterator:
        for batch, texts in text_batches(batches):
            prints = np.array([fingerprint(t, width) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(prints)], [*batch.schema.names[:-1], "fp"])

    rows = df.select(*(keep or []), F.col(id_col).alias("id"), whole_text(text).alias("text"))
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name != "text")
    return rows.mapInArrow(run, f"{fields}, fp long")


def block_masks(count: int, radius: int = RADIUS, blocks: int = 6) -> list[int]:
    """Masks of all keys for `count` fingerprints. More blocks are taken where a fingerprint
    would else meet a chance partner more often than one in sixteen times."""
    blocks = max(radius + 1, blocks)
    while blocks < radius + 6 and math.comb(blocks, radius) * count > 2 ** (BITS * (blocks - radius) // blocks - 4):
        blocks += 1
    edges = [round(BITS * i / blocks) for i in range(blocks + 1)]
    part = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in itertools.pairwise(edges)]
    return [sum(part[i] for i in chosen) for chosen in itertools.combinations(range(blocks), blocks - radius)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _close(one: np.ndarray, others: np.ndarray, radius: int) -> np.ndarray:
    # counted as unsigned: of a negative number numpy counts the bits of its absolute value
    return np.bitwise_count((one ^ others).view(np.uint64)) <= radius


def spanning_links(members: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links that join all members reachable from each other in steps of `radius` bits: each
    member is reached once, so a group of n gives less than n links."""
    left, links = members, []
    while len(left):
        front, left = [left[0]], left[1:]
        reached = list(front)
        while front and len(left):
            near = _close(front.pop(), left, radius)
            if near.any():
                front += list(left[near])
                reached += list(left[near])
                left = left[~near]
        links += star(reached)
    return links


def star(nodes: list[int]) -> list[tuple[int, int]]:
    """Links from the smallest of `nodes` to all others, so that tiles that share most of
    their members give the same links."""
    least, *others = np.unique(np.array(nodes, np.int64)).tolist()
    return [(least, x) for x in others]


def hung(links: DataFrame) -> DataFrame:
    """Links (a, b) with the closure of `links`: the smaller neighbours of a node hang on the
    smallest of them, the node too, so that about one link is left for each node.

    A node's smaller neighbours make one row. Of links by `star` they are no more than the
    tiles that the node is in.
    """
    pairs = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    met = pairs.groupBy("a").agg(F.min("b").alias("least"), F.collect_set("b").alias("all"))
    nodes = F.concat(F.array("a"), F.array_remove("all", F.col("least")))
    return met.select(F.explode(nodes).alias("a"), F.col("least").alias("b")).distinct()


def apart(members: DataFrame, roots: DataFrame, bound: int) -> DataFrame:
    """`members` (key, fp, weight, others) with `root` and `tile`: any two of one key that do
    not have the same root in `roots` (node, root) share a tile.

    Of each key the root of most weight is dealt once to the members of other roots, which
    also meet each other. So a group that is joined already gives no rows, and one with a
    few others as many as it has members; tiles hold about two times `bound`.
    """
    rooted = members.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    sums = rooted.groupBy("key", "root").agg(F.struct(F.sum("weight").alias("weight"), F.count("*").alias("n"), "root").alias("sum"))
    both = sums.groupBy("key").agg(F.max("sum").alias("top"), F.sum("sum.weight").alias("weight"), F.sum("sum.n").alias("n"))

    def parts(weight: Column, n: Column) -> Column:
        return F.greatest(F.lit(1), F.least(F.ceil(weight / bound), n)).cast("int")

    dealt = both.where("n > top.n").select(
        "key",
        F.col("top.root").alias("top"),
        parts(F.col("top.weight"), F.col("top.n")).alias("tops"),
        parts(F.col("weight") - F.col("top.weight"), F.col("n") - F.col("top.n")).alias("rests"),
    )
    joined = rooted.join(staged(dealt, "apart"), "key")
    is_top, number = F.col("root") == F.col("top"), F.xxhash64("fp")
    own = F.when(is_top, F.pmod(number, F.col("tops"))).otherwise(F.col("tops") + F.pmod(number, F.col("rests"))).cast("int")
    others = F.sequence(F.when(is_top, F.col("tops")).otherwise(0), F.col("tops") + F.col("rests") - 1)
    tiles = F.transform(others, lambda p: F.xxhash64("key", F.least(own, p), F.greatest(own, p)))
    return joined.select(*members.columns, "root", F.explode(tiles).alias("tile"))


def _links_of(keys: np.ndarray, prints: np.ndarray, radius: int) -> np.ndarray:
    """Links within runs of equal keys: short runs all at once by offset, long ones one by one."""
    cuts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1], [True]]))
    sizes = np.diff(cuts)
    short = np.repeat(sizes <= 32, sizes)
    found = [np.zeros((0, 2), np.int64)]
    for step in range(1, min(32, int(sizes.max(initial=0)))):
        near = (keys[step:] == keys[:-step]) & short[step:] & _close(prints[step:], prints[:-step], radius)
        found.append(np.stack([prints[:-step][near], prints[step:][near]], 1))
    for i in np.flatnonzero(sizes > 32):
        links = spanning_links(prints[cuts[i] : cuts[i + 1]], radius)
        found.append(np.array(links, np.int64).reshape(-1, 2))
    return np.concatenate(found)


def links(prints: DataFrame, count: int, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Links (a, b) over distinct fingerprints `prints.fp`; their closure is that of all
    pairs within `radius` bits."""
    masks = F.array(*[F.lit(_signed(m)) for m in block_masks(count, radius)])
    keyed = prints.select("fp", F.posexplode(masks).alias("part", "mask"))
    # a key is one number: the masked bits mixed with the number of the mask
    keyed = keyed.select("fp", F.xxhash64("part", F.col("fp").bitwiseAND(F.col("mask"))).alias("key"))
    met = staged(keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "keys")
    members = keyed.join(met, "key")
    # groups beyond a tile: every member goes to the tiles of its part with all parts
    parts = F.ceil(F.col("n") / tile).cast("int")
    own = F.pmod(F.xxhash64("fp"), parts).cast("int")
    tiles = F.transform(F.sequence(F.lit(0), parts - 1), lambda p: F.xxhash64("key", F.least(own, p), F.greatest(own, p)))
    tiled = members.select("fp", F.explode(F.when(F.col("n") <= tile, F.array("key")).otherwise(tiles)).alias("tile"))
    dealt = tiled.repartition("tile").sortWithinPartitions("tile", "fp")

    def run(batches: Iterator) -> Iterator:
        keys, fps = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            keys = np.concatenate([keys, batch.column("tile").to_numpy()])
            fps = np.concatenate([fps, batch.column("fp").to_numpy()])
            if not len(keys):
                continue
            # the last run may go on in the next batch
            done = int(np.searchsorted(keys, keys[-1]))
            if done:
                yield _batch(_links_of(keys[:done], fps[:done], radius))
                keys, fps = keys[done:], fps[done:]
        if len(keys):
            yield _batch(_links_of(keys, fps, radius))

    return hung(dealt.select("tile", "fp").mapInArrow(run, "a long, b long"))


def _batch(found: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], ["a", "b"])


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) of every node of `edges` (a, b), root the smallest node it can reach.

    Each round hangs every node's larger neighbours, then its smaller ones, on its smallest
    neighbour, until only stars are left; the number of rounds grows with the logarithm of
    a component's size. Every round is written to the shared folder, which cuts lineage.
    """
    edges = staged(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct(), "edges")
    before = None
    for _ in range(rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # written, so that the join below shuffles both sides and can split a hub's rows
        least = staged(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "least")
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e"))
        edges = staged(small.select("e.a", "e.b").where("a != b").distinct(), "edges")
        # a star forest no longer changes; its sum and size tell
        now = edges.agg(F.count("*"), F.sum(F.col("a").cast("decimal(38,0)")), F.sum(F.col("b").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        before = now
    raise RuntimeError(f"components did not settle in {rounds} rounds")


def classes(rows: DataFrame, best: Column, links_of: Callable[[DataFrame], DataFrame], *more: Column) -> DataFrame:
    """(fp, best) per distinct fingerprint of `rows`: the least `best` of its component.
    `links_of` gets the fingerprints with their own `best` and the aggregates `more`."""
    prints = staged(rows.groupBy("fp").agg(F.min(best).alias("best"), *more), "prints")
    found = staged(links_of(prints), "links")
    roots = staged(components(found), "roots")
    rooted = prints.join(roots, prints["fp"] == roots["node"]).select("fp", "root", "best")
    least = rooted.groupBy("root").agg(F.min("best").alias("least"))
    joined = rooted.join(least, "root").select("fp", "least")
    return staged(prints.join(joined, "fp", "left").select("fp", F.coalesce("least", "best").alias("best")), "classes")


def near_copies(df: DataFrame, id_col: str = "doc_id", text: str = "text", width: int = WIDTH, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """The id, `fingerprint` and `component_id` of every row: the smallest id reachable over
    links of at most `radius` differing bits, its own included.

    Null counts as empty; texts without words have fingerprint zero and link like others.
    Null ids are passed over for a component's id unless it has no other. Repeated rows
    and ids stay as they are; an empty table gives no rows. Other columns are not read.
    """
    rows = staged(fingerprints(df, id_col, text, width), "fingerprints")
    # a struct orders by its first field, nulls last
    best = F.struct(F.col("id").isNull().alias("none"), F.col("id"))
    found = classes(rows, best, lambda prints: links(prints, prints.count(), radius, tile))
    return rows.join(found, "fp").select(
        F.col("id").alias(id_col),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("best.id").alias("component_id"),
    )


def drop_near_copies(df: DataFrame, id_col: str = "doc_id", text: str = "text", width: int = WIDTH, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """One row of each component, the one with the smallest id; columns as they are.

    Of rows with the smallest id the one whose text has the smallest SHA-256 stays, and one
    of them if texts are equal too. Texts move once, joined to the rows that stay.
    """
    rows = staged(fingerprints(df, id_col, text, width, keep=[text_sha(text).alias("sha")]), "fingerprints")
    found = classes(rows, by_id(), lambda prints: links(prints, prints.count(), radius, tile))
    return keep_best(df, found, id_col, text)


def text_sha(text: str) -> Column:
    return F.unhex(F.sha2(whole_text(text), 256))


def by_id() -> Column:
    """Orders rows by id, nulls last, then by the text's digest."""
    return F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("sha"))


def keep_best(df: DataFrame, found: DataFrame, id_col: str, text: str) -> DataFrame:
    """The rows of `df` that are the `best` (id, sha) of their class, each once."""
    stays = found.select(F.struct("best.id", "best.sha").alias("key")).distinct()
    others = F.to_json(F.struct(F.lit(0), *[c for c in df.columns if c not in (id_col, text)]))
    key = F.struct(F.col(id_col).alias("id"), text_sha(text).alias("sha"))
    whole = df.select(F.struct("*").alias("row"), key.alias("key"), others.alias("others"))
    held = whole.join(stays, "key", "left_semi")
    return held.groupBy("key").agg(F.min_by("row", "others").alias("row")).select("row.*")
