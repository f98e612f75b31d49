"""How far the sources of a language differ in their words, by count-level bitmaps.

A group is a (language, source). The kept terms of a language are numbered, and every group
stores, for each count it gives, the set of the terms with that count as a bitset: its
64-bit words other than zero, keyed by (language, bucket, word). Two groups' joint cells,
the number of terms that have count c here and count d there, are the population counts of
the AND of their words; the rows and columns of count zero follow by complement from the
marginal counts. A cell counts times the distance of the two rates, which only depend on
the counts, so no term is visited once its bit is set.

Bitsets are small beside the counts. A word's entries meet in one task, by blocks of
sources, and a task adds up its words before anything is shuffled.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tslines.llm.common import broadcast_if_small, runs
from tslines.session import staged

#: Documents of a language that must hold a term; added to every count; scale of the rates.
LEAST_DOCS, PRIOR, SCALE = 30, 5, 1_000_000_000
#: Ranks given of a group's own terms.
RANKS = 50
#: Terms numbered together, and sources compared at once.
BUCKET, BLOCK = 4096, 256
#: (source, term) counts that a task holds before it gives them on.
HELD = 200_000
#: Groups up to which a table with one row for each is broadcast.
MAX_GROUPS = 100_000

# every byte that is no letter and below 0x80 parts terms; A-Z get lower case
_LETTERS = bytes(b if b >= 0x80 or chr(b).isalpha() else 32 for b in range(256)).lower()


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8: runs of letters A-Z, a-z and characters past ASCII."""
    return text.translate(_LETTERS).split()


def term_counts(df: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", most: int = HELD) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents, summed over the rows that a
    task holds at a time. A null term stands for the group itself."""

    def run(batches: Iterator) -> Iterator:
        held: dict[tuple, tuple[Counter, Counter]] = {}
        for batch in batches:
            groups = zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), strict=True)
            texts = batch.column("text").cast(pa.binary())
            for group, value in zip(groups, texts, strict=True):
                n, docs = held.setdefault(group, (Counter(), Counter()))
                terms = terms_of(value.as_py())
                n.update(terms)
                docs.update(set(terms))
            if sum(len(n) for n, _ in held.values()) > most:
                yield from _count_rows(held)
                held = {}
        yield from _count_rows(held)

    rows = df.select(*(F.coalesce(F.col(c), F.lit("")).alias(to) for c, to in ((lang, "lang"), (source, "source"), (text, "text"))))
    return rows.mapInArrow(run, "lang string, source string, term string, n long, docs long")


def _count_rows(held: dict) -> Iterator:
    names = ["lang", "source", "term", "n", "docs"]
    for (lang, source), (n, docs) in held.items():
        terms = [None, *n]
        arrays = [
            pa.array([lang] * len(terms), pa.string()),
            pa.array([source] * len(terms), pa.string()),
            pa.array(terms, pa.binary()).cast(pa.string()),
            pa.array([0, *n.values()], pa.int64()),
            pa.array([0, *(docs[t] for t in n)], pa.int64()),
        ]
        yield pa.RecordBatch.from_arrays(arrays, names)


def rate(count: str, total: str = "total", terms: str = "terms") -> Column:
    """1 + floor(SCALE * (count + PRIOR) / (total + PRIOR * terms)), exact; null without terms."""
    whole = f"nullif({total} + {PRIOR} * {terms}, 0L)"
    return F.expr(f"1L + (cast({count} + {PRIOR} as decimal(20, 0)) * {SCALE}) div cast({whole} as decimal(20, 0))")


def numbered(kept: DataFrame, count: int, size: int = BUCKET) -> DataFrame:
    """Kept terms (lang, term, n) with the place of their bit: bucket, word and bit. Terms of
    like counts share words, so words hold few levels."""
    buckets = max(1, -(-count // size))
    bucket = F.pmod(F.xxhash64("lang", "term"), F.lit(buckets)).cast("int")
    order = Window.partitionBy("lang", "bucket").orderBy(F.desc("n"), "term")
    place = F.row_number().over(order) - 1
    return kept.withColumn("bucket", bucket).select(
        "lang", "term", "n", "bucket", F.floor(place / 64).cast("int").alias("word"), (place % 64).cast("int").alias("bit")
    )


def joint_sums(entries: DataFrame, size: int = BLOCK) -> DataFrame:
    """(lang, one, other, joint) with one < other, from entries (lang, bucket, word, sid, n_blocks, p,
    zero, bits): over the terms both have, the distance of the rates less what the marginal
    sums count for them."""
    block = F.floor(F.col("sid") / size).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("n_blocks") - 1), lambda j: F.struct(F.least("block", j).alias("left"), F.greatest("block", j).alias("right")))
    dealt = entries.withColumn("block", block).select("*", F.inline(pairs))
    keys = ["lang_id", "left", "right", "bucket", "word"]
    dealt = dealt.repartition(*keys).sortWithinPartitions(*keys, "sid")

    def run(batches: Iterator) -> Iterator:
        at, total = None, None
        for table in runs(batches, keys):
            here = tuple(table.column(k)[0].as_py() for k in ("lang_id", "left", "right"))
            if here != at:
                if at is not None:
                    yield _sum_rows(at, total, size)
                at, total = here, np.zeros((size, size), np.int64)
            _add_word(total, here[1], here[2], *(table.column(c).to_numpy() for c in ("sid", "p", "zero", "bits")))
        if at is not None:
            yield _sum_rows(at, total, size)

    given = dealt.select(*keys, "sid", "p", "zero", "bits")
    sums = given.mapInArrow(run, "lang_id int, one int, other int, joint long")
    return sums.groupBy("lang_id", "one", "other").agg(F.sum("joint").alias("joint"))


def _sum_rows(at: tuple[int, int, int], total: np.ndarray, size: int) -> pa.RecordBatch:
    lang, left, right = at
    if left == right:
        total = np.triu(total, 1)
    one, other = np.nonzero(total)
    arrays = [np.full(len(one), lang, np.int32), (one + left * size).astype(np.int32), (other + right * size).astype(np.int32), total[one, other]]
    return pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], ["lang_id", "one", "other", "joint"])


def _add_word(total: np.ndarray, left: int, right: int, sid: np.ndarray, p: np.ndarray, zero: np.ndarray, bits: np.ndarray) -> None:
    """Add the joint cells of one word of terms, for the sources of two blocks."""
    size = len(total)
    rows = np.flatnonzero(sid // size == left)
    cols = np.flatnonzero(sid // size == right)
    if not len(rows) or not len(cols):
        return
    bits = bits.view(np.uint64)
    starts = np.flatnonzero(np.r_[True, np.diff(sid[cols]) != 0])
    across = sid[cols][starts] % size
    step = max(1, (1 << 20) // len(cols))
    for a in range(0, len(rows), step):
        r = rows[a : a + step]
        cells = np.bitwise_count(bits[r][:, None] & bits[cols]).astype(np.int64)
        i, j = np.nonzero(cells)
        x, y = r[i], cols[j]
        far = np.abs(p[x] - p[y]) - np.abs(p[x] - zero[y]) - np.abs(zero[x] - p[y]) + np.abs(zero[x] - zero[y])
        cells[i, j] *= far
        summed = np.add.reduceat(cells, starts, axis=1)
        np.add.at(total, (sid[r][:, None] % size, across), summed)


def divergence(
    df: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    least_docs: int = LEAST_DOCS,
    ranks: int = RANKS,
    bucket: int = BUCKET,
    block: int = BLOCK,
    held: int = HELD,
) -> DataFrame:
    """(lang, source, part, item, value, rank). Part `pair`: the distance of the group's term
    rates from those of each other source of its language, all ranks. Part `term`: the terms
    more frequent in the group than in its language, up to `ranks`.

    Null language, source and text count as empty, so null and empty form one group. A group
    whose texts hold no kept term has all counts zero; in a language without kept terms all
    pairs have value 0 and no terms are given. A language's only source gives no pairs.
    Repeated rows count each. Ties go by the item's bytes. Empty tables give no rows. Other
    columns are not read, and texts of any length are counted whole.
    """
    counts = term_counts(df, text, lang, source, held).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    counts = staged(counts, "term-counts")
    terms = counts.where("term is not null")
    per_lang = terms.groupBy("lang", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    kept = staged(per_lang.where(F.col("docs") >= least_docs).drop("docs"), "kept")
    placed = staged(numbered(kept, kept.count(), bucket), "placed")
    joined = terms.select("lang", "source", "term", "n").join(placed.withColumnRenamed("n", "n_lang"), ["lang", "term"])
    joined = staged(joined, "counted")

    langs = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("n").alias("n_all"))
    totals = joined.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("own"))
    groups = counts.where("term is null").select("lang", "source").distinct()
    groups = groups.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").fillna(0)
    by_lang = Window.partitionBy("lang").orderBy("source")
    numbers = groups.select("*", (F.row_number().over(by_lang) - 1).alias("sid"), F.count("*").over(Window.partitionBy("lang")).alias("n_sources"))
    numbers = numbers.withColumn("zero", rate("0L"))
    groups = staged(numbers, "groups")
    small = broadcast_if_small(groups, MAX_GROUPS)

    rated = joined.join(small.drop("own", "zero", "sid", "n_sources"), ["lang", "source"])
    over = rated.select("lang", "source", F.col("term").alias("item"), (rate("n") - rate("n_lang", "n_all")).alias("value")).where("value > 0")
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    top = over.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= ranks)

    bit = F.expr("shiftleft(1L, bit)")
    levels = joined.groupBy("lang", "source", "bucket", "word", "n").agg(F.bit_or(bit).alias("bits"))
    entries = staged(levels.join(small, ["lang", "source"]).withColumn("p", rate("n")), "levels")
    pairs = group_pairs(entries, groups, small, block)
    ranked = pairs.withColumn("rank", F.row_number().over(best))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return ranked.withColumn("part", F.lit("pair")).select(columns).unionByName(top.withColumn("part", F.lit("term")).select(columns))


def group_pairs(entries: DataFrame, groups: DataFrame, small: DataFrame, block: int = BLOCK) -> DataFrame:
    """(lang, source, item, value) of every ordered pair of a language's sources."""
    # languages by number, as tasks compare keys as numbers
    langs = broadcast_if_small(staged(groups.groupBy("lang").agg(F.count("*").alias("n")).select("lang", F.row_number().over(Window.orderBy("lang")).alias("lang_id")), "langs"), MAX_GROUPS)
    cells = entries.join(langs, "lang").select("lang_id", "bucket", "word", "sid", F.ceil(F.col("n_sources") / block).cast("int").alias("n_blocks"), "p", "zero", "bits")
    joint = joint_sums(cells, block)

    # the terms a group has, against the rate of zero of each other group
    hist = entries.groupBy("lang", "source", "sid", "p").agg(F.sum(F.bit_count("bits").cast("long")).alias("m"))
    theirs = small.select("lang", F.col("sid").alias("sid_b"), F.col("zero").alias("zero_b"))
    edge = hist.join(theirs, "lang").where("sid != sid_b")
    edge = edge.groupBy("lang", "sid", "sid_b").agg(F.sum(F.col("m") * F.abs(F.col("p") - F.col("zero_b"))).alias("edge"))
    edge = edge.join(langs, "lang").select("lang_id", F.least("sid", "sid_b").alias("one"), F.greatest("sid", "sid_b").alias("other"), F.col("edge").alias("joint"))
    summed = joint.unionByName(edge).groupBy("lang_id", "one", "other").agg(F.sum("joint").alias("sums"))

    left = groups.join(langs, "lang").select("lang", "lang_id", "source", "terms", F.col("sid").alias("one"), F.col("own").alias("own_a"), F.col("zero").alias("zero_a"))
    right = small.select("lang", F.col("source").alias("item"), F.col("sid").alias("other"), F.col("own").alias("own_b"), F.col("zero").alias("zero_b"))
    both = left.join(right, "lang").where("one < other").join(summed, ["lang_id", "one", "other"], "left")
    neither = (F.col("terms") - F.col("own_a") - F.col("own_b")) * F.abs(F.col("zero_a") - F.col("zero_b"))
    value = F.coalesce(F.coalesce("sums", F.lit(0)) + neither, F.lit(0)).cast("long")
    ordered = both.select("lang", value.alias("value"), F.array(F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item"))).alias("ends"))
    return ordered.select("lang", "value", F.inline("ends"))
