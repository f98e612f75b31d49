"""Ingest rules: type conflicts, partial acceptance, assigned time, last write wins."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tslines.model import REJECTS
from tslines.operators.decode import last_fields, value_type
from tslines.session import is_small, staged

TAG_TYPE = "tag"
# A type table up to this many rows is sent to every task; a larger one is joined by key.
MAX_BROADCAST_TYPES = 50_000
MAX_BROADCAST_BATCHES = 100_000
# Parts of a measurement's lines when its types are joined by key.
SALTS = 64

# Lines per batch that fit into the packed write order below.
_LINE_SPAN = 10**12


def _signature(points: DataFrame) -> Column:
    """Names and types used by a point, fields first and in the order they have there.

    Tags take part, as a name is either tag or field.
    """
    tags = F.transform(
        F.array_sort(F.map_keys("tags")),
        lambda k: F.struct(k.alias("key"), F.lit(TAG_TYPE).alias("type")),
    )
    fields = F.transform(
        "fields", lambda f: F.struct(f["key"].alias("key"), value_type(f["value"]).alias("type"))
    )
    none = F.array().cast("array<struct<key:string,type:string>>")
    return F.concat(fields, F.coalesce(tags, none))


def _packed_order() -> Column:
    """`seq` as one fixed-width number, so that its minimum stays a hash aggregate."""
    batch, line = F.col("seq")["batch"], F.col("seq")["line"]
    return (
        batch.cast("decimal(20,0)") * F.lit(_LINE_SPAN).cast("decimal(13,0)")
        + line.cast("decimal(20,0)")
    ).cast("decimal(38,0)")


def learn_types(points: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Stored type of every (measurement, key): the one the first accepted point used.

    A point is accepted when none of its names was stored with another type before it, and
    only accepted points store types. Whether a point is accepted depends on its signature
    (its names and types) alone, decided where that signature first occurs: once accepted,
    its types are stored and it stays acceptable; once refused, it stays refused. So the
    points are reduced to their distinct signatures with the first place of each, in one
    aggregation, and the rule runs over those. Names seen with one type only cannot
    conflict; a table without conflicts needs no further step.

    A point that uses one name as tag and as field is never accepted. `known` holds types
    stored earlier: (measurement, key, type).
    Returns (measurement, key, type, place), where `place` is the first position the name
    was seen at, a hint for `decode.to_measurement`.
    """
    first = points.groupBy("measurement", _signature(points).alias("sig")).agg(
        F.min(_packed_order()).alias("first")
    )
    keys = F.transform("sig", lambda u: u["key"])
    first = first.where(F.size(F.array_distinct(keys)) == F.size(keys))
    first = staged(first.withColumn("id", F.monotonically_increasing_id()), "signatures")
    uses = first.select(
        "id", "measurement", "first", F.posexplode("sig").alias("place", "use")
    ).select("id", "measurement", "first", "use.key", "use.type", "place")
    if known is not None:
        stored = known.select(
            F.lit(-1).cast("bigint").alias("id"),
            "measurement",
            F.lit(-1).cast("decimal(38,0)").alias("first"),
            "key",
            "type",
            F.lit(None).cast("int").alias("place"),
        )
        uses = uses.unionByName(stored)
    kept = uses.join(_refused(uses), "id", "left_anti")
    return kept.groupBy("measurement", "key").agg(
        F.min("type").alias("type"), F.min("place").alias("place")
    )


def _refused(uses: DataFrame) -> DataFrame:
    """Ids of the signatures that are refused.

    Only names used with several types matter. What signatures use of them goes past in write
    order, and a task keeps the types stored so far for the names it has met. Signatures
    that share no disputed name, not even over others, cannot touch each other: each
    connected part of a measurement's disputed names goes past on its own.
    """
    by_key = uses.groupBy("measurement", "key").agg(F.count_distinct("type").alias("n"))
    disputed = by_key.where("n > 1").select("measurement", "key")
    node = F.xxhash64("measurement", "key").alias("node")
    open_uses = staged(uses.join(disputed, ["measurement", "key"], "left_semi").withColumn("node", node), "disputed")
    # stored types come first, each as a signature of its own
    own = F.when(F.col("id") < 0, F.col("key"))
    rows = open_uses.groupBy("measurement", "first", "id", own.alias("own")).agg(
        F.collect_list(F.struct("key", "type")).alias("sig"), F.array_sort(F.collect_set("node")).alias("nodes")
    )
    links = rows.where(F.size("nodes") > 1).select(F.col("nodes")[0].alias("a"), F.explode(F.slice("nodes", 2, 2**31 - 1)).alias("b"))
    rows = rows.withColumn("node", F.col("nodes")[0])
    parts = connected(links)
    if parts is not None:
        parts = _sized(parts, parts, MAX_BROADCAST_TYPES)
        rows = rows.join(parts, "node", "left").withColumn("node", F.coalesce("root", "node"))
    in_order = rows.repartition("measurement", "node").sortWithinPartitions("measurement", "node", "first")
    return in_order.select("measurement", "node", "id", "sig").mapInArrow(_refuse_in_order, "id bigint")


def connected(links: DataFrame) -> DataFrame | None:
    """(node, root) of every node of the links (a, b), one root for each connected part; None
    without links.

    Nodes hang on their smallest neighbour, and links are drawn anew between what they hang
    on, until none is left. Equal hashes of different names only join their parts.
    """
    links = staged(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a != b").distinct(), "links")
    total = None
    while not links.isEmpty():
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hung = staged(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("up")), "hung")
        if total is None:
            total = hung.select(F.col("a").alias("node"), F.col("up").alias("root"))
        else:
            moved = total.join(hung, F.col("root") == F.col("a"), "left")
            total = staged(moved.select("node", F.coalesce("up", "root").alias("root")), "roots")
        left = links.join(hung, "a").select("b", F.col("up").alias("one"))
        ends = left.join(hung, F.col("b") == hung["a"]).select(F.least("one", "up").alias("a"), F.greatest("one", "up").alias("b"))
        links = staged(ends.where("a != b").distinct(), "links")
    return total


def _refuse_in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, types = None, {}
    for batch in batches:
        refused = []
        for row in batch.to_pylist():
            if (row["measurement"], row["node"]) != part:
                part, types = (row["measurement"], row["node"]), {}
            uses = {u["key"]: u["type"] for u in row["sig"]}
            if all(types.get(k, t) == t for k, t in uses.items()):
                types.update(uses)
            else:
                refused.append(row["id"])
        yield pa.RecordBatch.from_arrays([pa.array(refused, pa.int64())], ["id"])


def _type_maps(types: DataFrame) -> DataFrame:
    """One row per measurement with its names and types as a map."""
    return types.groupBy("measurement").agg(
        F.map_from_entries(F.collect_list(F.struct("key", "type"))).alias("__types")
    )


def _sized(side: DataFrame, checked: DataFrame, bound: int) -> DataFrame:
    """`side` marked for broadcast when `checked` has at most `bound` rows."""
    return F.broadcast(side) if is_small(checked, bound) else side


def _with_types(parsed: DataFrame, types: DataFrame) -> DataFrame:
    """Lines with the types of their measurement. Many types are joined by measurement and a
    part of its lines, so that one measurement, or all lines without one, spread out."""
    expected = _type_maps(types)
    if is_small(types, MAX_BROADCAST_TYPES):
        return parsed.join(F.broadcast(expected), "measurement", "left")
    part = F.pmod(F.xxhash64("line", "lp"), F.lit(SALTS)).cast("int")
    copies = expected.withColumn("__part", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return parsed.withColumn("__part", part).join(copies, ["measurement", "__part"], "left")


def judge(
    parsed: DataFrame, types: DataFrame | None = None, accept_partial: bool = True
) -> DataFrame:
    """Parsed lines with `reject` completed by type conflicts.

    `parsed` comes from `parse_bodies` (columns `batch_id, line, lp`, the point columns and
    `reject`). `types` is the stored typing (measurement, key, type); without it the types
    are learned from these lines. With `accept_partial=False` one bad line rejects its
    whole batch.
    """
    if types is None:
        # learning reads the lines once more, so they are parsed into a table first
        parsed = staged(parsed, "parsed")
        types = staged(learn_types(parsed.where(F.col("reject").isNull())), "types")
    joined = _with_types(parsed, types)

    def clashes(key: Column, kind: Column) -> Column:
        return F.coalesce(F.try_element_at("__types", key) != kind, F.lit(False))

    bad_field = F.filter("fields", lambda f: clashes(f["key"], value_type(f["value"])))
    bad_tag = F.filter(F.map_keys("tags"), lambda k: clashes(k, F.lit(TAG_TYPE)))
    clash = F.coalesce(F.get(bad_field, F.lit(0))["key"], F.get(bad_tag, F.lit(0)))
    judged = joined.withColumn(
        "reject",
        F.coalesce(
            "reject", F.when(clash.isNotNull(), F.concat(F.lit("type conflict on "), clash))
        ),
    ).drop("__types")
    judged = judged.select(*parsed.columns)
    return judged if accept_partial else _whole_batches(judged)


def _whole_batches(judged: DataFrame) -> DataFrame:
    judged = staged(judged, "judged")
    bad = judged.where(F.col("reject").isNotNull()).select("batch_id").distinct()
    bad = bad.withColumn("__bad", F.lit(True))
    bad = _sized(bad, bad, MAX_BROADCAST_BATCHES)
    refused = F.when(F.col("__bad"), F.lit("batch holds a rejected line"))
    return (
        judged.join(bad, "batch_id", "left")
        .withColumn("reject", F.coalesce("reject", refused))
        .select(*judged.columns)
    )


def accepted(judged: DataFrame) -> DataFrame:
    """Points of the good lines."""
    return judged.where(F.col("reject").isNull()).drop("reject")


def rejects(judged: DataFrame, keep: list[str] = ()) -> DataFrame:
    """Rejected lines with number, reason and text, next to the columns in `keep`."""
    return judged.where(F.col("reject").isNotNull()).select(
        *keep,
        F.col("batch_id").cast(REJECTS["batch_id"].dataType).alias("batch_id"),
        F.col("line").cast("bigint").alias("line"),
        F.col("reject").alias("message"),
        F.col("lp").alias("original_line"),
    )


def split(judged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejects) over one written copy, so that parsing runs once for both."""
    stored = staged(judged, "judged")
    return accepted(stored), rejects(stored)


def assign_time(points: DataFrame, ingest_time_ns: int) -> DataFrame:
    """Give points without time the time of ingest.

    One constant per call, so that a retried task or job assigns the same time again.
    """
    return points.withColumn(
        "time_ns", F.coalesce("time_ns", F.lit(ingest_time_ns).cast("bigint"))
    )


def last_write_wins(
    rows: DataFrame, series: list[str], fields: list[str], seq: str = "seq", time: str = "time_ns"
) -> DataFrame:
    """One row per (series, time): for each field the last value written, NULLs ignored.

    A field absent from a later write keeps its earlier value. `seq` must be unique per
    row; any orderable column will do. One shuffle, with duplicates merged before it, so
    a (series, time) that is written over and over is not gathered anywhere. Numbers-only
    frames with a numeric `seq` aggregate in hash tables.
    """
    newest = [
        F.expr(f"max_by(`{f}`, `{seq}`) filter (where `{f}` is not null)").alias(f)
        for f in fields
    ]
    return rows.groupBy(*(F.col(f"`{c}`") for c in [*series, time])).agg(*newest)


def _series() -> Column:
    """The tags in one order, as a key."""
    tags = F.coalesce("tags", F.create_map().cast("map<string,string>"))
    return F.array_sort(F.map_entries(tags))


def last_write_wins_points(points: DataFrame) -> DataFrame:
    """The same rule on points in long form.

    Most points are written once. A first pass counts writes by a hash of series and time,
    which shuffles a few bytes per point; the points of hashes seen once pass as they are.
    The others, few or many, are merged field by field. Two series that share a hash only
    take the longer way. The input is read twice, so it had better be a stored table.
    """
    written = points.where(F.size("fields") > 0).select(
        "measurement", _series().alias("series"), "fields", "time_ns", "seq", F.xxhash64("measurement", _series(), "time_ns").alias("__hash")
    )
    again = written.groupBy("__hash").agg(F.count("*").alias("n")).where("n > 1").select("__hash")
    again = staged(again, "overwritten").withColumn("__again", F.lit(True))
    again = _sized(again, again, MAX_BROADCAST_TYPES)
    marked = written.join(again, "__hash", "left")
    once = marked.where(F.col("__again").isNull())
    merged = _merge_fields(marked.where("__again"))
    kept = once.select("measurement", "series", last_fields(F.col("fields")).alias("fields"), "time_ns", "seq")
    return kept.unionByName(merged).select("measurement", F.map_from_entries("series").alias("tags"), "fields", "time_ns", "seq")


def _merge_fields(points: DataFrame) -> DataFrame:
    """One point per (series, time), merged per field first (with merging before the shuffle),
    then put together; a group of the second step holds one row per field name."""
    fields = points.select("measurement", "series", "time_ns", "seq", F.posexplode("fields").alias("place", "field"))
    newest = fields.groupBy("measurement", "series", "time_ns", F.col("field.key").alias("key")).agg(
        F.max_by("field.value", F.struct("seq", "place")).alias("value"),
        F.min(F.struct("seq", "place")).alias("first"),
        F.max("seq").alias("seq"),
    )
    whole = newest.groupBy("measurement", "series", "time_ns").agg(
        F.array_sort(F.collect_list(F.struct("first", "key", "value"))).alias("fields"),
        F.max("seq").alias("seq"),
    )
    cells = F.transform("fields", lambda f: F.struct(f["key"].alias("key"), f["value"].alias("value")))
    return whole.select("measurement", "series", cells.alias("fields"), "time_ns", "seq")


def wide_schema(types: DataFrame, measurement: str) -> tuple[list[str], dict[str, str]]:
    """Tag names and field types of one measurement, for `decode.to_measurement`.

    Reads one row per column of the measurement.
    """
    rows = types.where(F.col("measurement") == measurement).select("key", "type", "place").collect()
    rows.sort(key=lambda r: (r["place"] is None, r["place"], r["key"]))
    tags = sorted(r["key"] for r in rows if r["type"] == TAG_TYPE)
    return tags, {r["key"]: r["type"] for r in rows if r["type"] != TAG_TYPE}
