"""Points and frames to line-protocol text. Projections only: no shuffle, no Python worker."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tslines.functions import literals, text, times
from tslines.model import Precision, WriteOptions
from tslines.operators.decode import split_body
from tslines.session import is_utc

# Above this many fields the parts are joined through one array expression, which Spark
# compiles in pieces, and the all-NULL check looks at the joined text.
WIDE_FIELDS = 100


def _any(conditions: list[Column]) -> Column:
    """OR of many conditions as a balanced tree, so that deep frames plan quickly."""
    while len(conditions) > 1:
        pairs = zip(conditions[::2], conditions[1::2], strict=False)
        odd = conditions[-1:] if len(conditions) % 2 else []
        conditions = [a | b for a, b in pairs] + odd
    return conditions[0]


def frame_roles(
    df: DataFrame, tags: list[str], timestamp_column: str | None
) -> tuple[list[str], list[str]]:
    """Tag columns in caller order and field columns in frame order.

    Tag names the frame lacks are skipped; a repeated name repeats the tag.
    """
    present = set(df.columns)
    reserved = {*tags, timestamp_column}
    return [t for t in tags if t in present], [c for c in df.columns if c not in reserved]


def _check_zone(df: DataFrame, used: list[str]) -> None:
    ntz = [c for c in used if isinstance(df.schema[c].dataType, T.TimestampNTZType)]
    if ntz and not is_utc(df.sparkSession):
        raise ValueError(f"columns {ntz} have no zone: set spark.sql.session.timeZone=UTC")


def has_field(df: DataFrame, fields: list[str]) -> Column | None:
    """Condition "some field is set"; None when a field column can never be NULL."""
    if any(not df.schema[c].nullable for c in fields):
        return None
    return _any([F.col(f"`{c}`").isNotNull() for c in fields]) if fields else F.lit(False)


def frame_line(
    df: DataFrame,
    measurement: str,
    tags: list[str] = (),
    timestamp_column: str | None = None,
    precision: Precision | str = Precision.NS,
    unsigned: list[str] = (),
    wide_int: list[str] = (),
) -> Column:
    """Line-protocol text of a frame row, for use in any projection over `df`."""
    tag_cols, field_cols = frame_roles(df, list(tags), timestamp_column)
    known_time = timestamp_column if timestamp_column in df.columns else None
    _check_zone(df, [*field_cols, *([known_time] if known_time else [])])

    # Constant pieces (measurement, names, separators) are escaped here, once.
    pieces, pending = [], text.measurement_name(measurement)
    for name in tag_cols:
        field = df.schema[name]
        value = F.expr(literals.tag_text(field))
        label = f",{text.key_name(name)}="
        if field.nullable:
            pieces += [F.lit(pending), F.coalesce(F.concat(F.lit(label), value), F.lit(""))]
            pending = ""
        else:
            pieces += [F.lit(pending + label), value]
            pending = ""
    pieces.append(F.lit(pending + " "))

    parts = [
        F.concat(
            F.lit(f"{text.key_name(c)}="),
            F.expr(literals.field_text(df.schema[c], unsigned, wide_int)),
        )
        for c in field_cols
    ]
    if len(parts) > WIDE_FIELDS:
        pieces.append(F.array_join(F.array(*parts), ","))
    else:
        pieces.append(F.concat_ws(",", *parts) if parts else F.lit(""))

    if known_time:
        t = times.frame_time(F.col(f"`{known_time}`"), df.schema[known_time].dataType, precision)
        if t is not None:
            pieces.append(F.coalesce(F.concat(F.lit(" "), t.cast("string")), F.lit("")))
    return F.concat(*pieces)


def encode_frame(
    df: DataFrame,
    measurement: str,
    tags: list[str] = (),
    timestamp_column: str | None = None,
    precision: Precision | str = Precision.NS,
    unsigned: list[str] = (),
    wide_int: list[str] = (),
    keep: list[str] = (),
) -> DataFrame:
    """Frame to one line per row, in column `lp`; rows without any field are dropped.

    `keep` passes columns through next to the line (an order key, a partition column).
    """
    line = frame_line(df, measurement, tags, timestamp_column, precision, unsigned, wide_int)
    kept = [F.col(f"`{c}`") for c in keep]
    _, fields = frame_roles(df, list(tags), timestamp_column)
    some = has_field(df, fields)
    if some is None:
        return df.select(*kept, line.alias("lp"))
    # A filter on the input columns reaches the file scan as pushed IS NOT NULL tests.
    return df.where(some).select(*kept, line.alias("lp"))


def merged_tags(tags: Column, default_tags: dict[str, str]) -> Column:
    """Default tags under the point's own."""
    if not default_tags:
        return tags
    defaults = F.create_map(*(F.lit(x) for kv in default_tags.items() for x in kv))
    missing = F.map_filter(defaults, lambda k, _: ~F.map_contains_key(tags, k))
    return F.when(tags.isNull(), defaults).otherwise(F.map_concat(missing, tags))


def ordered_tags(tags: Column, tag_order: tuple[str, ...] = ()) -> Column:
    """Tag entries: listed keys first, in the order listed, then the rest sorted by bytes."""
    entries = F.array_sort(F.map_entries(tags))
    if not tag_order:
        return entries
    order = F.array(*(F.lit(k) for k in tag_order))
    listed = F.transform(
        F.filter(order, lambda k: F.map_contains_key(tags, k)),
        lambda k: F.struct(k.alias("key"), F.element_at(tags, k).alias("value")),
    )
    rest = F.filter(entries, lambda e: ~F.array_contains(order, e["key"]))
    return F.concat(listed, rest)


def point_line(options: WriteOptions = WriteOptions()) -> Column:
    """Line-protocol text of a canonical point row; fails for a point without fields."""
    tags = ordered_tags(
        merged_tags(F.col("tags"), options.default_tags), options.tag_order
    )
    tag_part = F.array_join(
        F.transform(
            tags,
            lambda e: F.concat(
                F.lit(","), text.escape_key(e["key"]), F.lit("="), text.escape_key(e["value"])
            ),
        ),
        "",
    )
    pair = f"concat({text.sql_escape_key('f.key')}, '=', {literals.value_text('f.value')})"
    field_part = F.expr(f"array_join(transform(fields, f -> {pair}), ',')")
    name = text.escape_measurement(F.col("measurement"))
    time = times.scale_time(F.col("time_ns"), options.precision).cast("string")
    line = F.concat(
        name,
        F.coalesce(tag_part, F.lit("")),
        F.lit(" "),
        field_part,
        F.coalesce(F.concat(F.lit(" "), time), F.lit("")),
    )
    no_fields = F.coalesce(F.size("fields"), F.lit(0)) < 1
    message = F.concat(
        F.lit("point '"), F.col("measurement"), F.lit("' has no fields; it needs at least one")
    )
    return F.when(no_fields, F.raise_error(message)).otherwise(line)


def encode_points(
    points: DataFrame,
    options: WriteOptions = WriteOptions(),
    on_empty: str = "error",
    keep: list[str] = (),
) -> DataFrame:
    """Canonical points to one line per row, in column `lp`.

    A point without fields is an error; `on_empty='reject'` turns it into a row whose `lp`
    is NULL and whose `reject` column says why.
    """
    line = point_line(options)
    kept = [F.col(f"`{c}`") for c in keep]
    if on_empty == "error":
        return points.select(*kept, line.alias("lp"))
    if on_empty != "reject":
        raise ValueError(f"on_empty must be 'error' or 'reject', not {on_empty!r}")
    empty = F.coalesce(F.size("fields"), F.lit(0)) < 1
    return points.select(
        *kept,
        F.when(~empty, line).alias("lp"),
        F.when(empty, F.lit("no fields")).alias("reject"),
    )


def line_fault(lp: Column, on_newline: str = "names") -> Column:
    """Why plain readers could not read a line back, or NULL.

    `on_newline='names'` minds line breaks in names and tag values, which no reader can tell
    from the end of a line, and a leading `#`, which makes the line a comment; breaks inside
    string fields pass. `'error'` minds any line break. `'keep'` minds nothing.
    """
    if on_newline == "keep":
        return F.lit(None).cast("string")
    if on_newline not in ("names", "error"):
        raise ValueError(f"on_newline must be 'keep', 'names' or 'error', not {on_newline!r}")
    broken = F.contains(lp, F.lit("\n"))
    if on_newline == "names":
        broken &= F.get(split_body(lp, multiline=True), F.lit(0)) != lp
    return F.when(lp.startswith("#"), F.lit("name starts with #")).when(
        broken, F.lit("line break inside a " + ("name or tag" if on_newline == "names" else "value"))
    )


def check_newlines(lines: DataFrame, on_newline: str = "names") -> DataFrame:
    """Lines as they are, or failing on one that `line_fault` minds."""
    if on_newline == "keep":
        return lines
    fault = line_fault(F.col("lp"), on_newline)
    return lines.withColumn("lp", F.when(fault.isNotNull(), F.raise_error(fault)).otherwise(F.col("lp")))


def split_faulty(lines: DataFrame, on_newline: str = "names") -> DataFrame:
    """Lines with a column `reject`; `lp` is NULL where it is set."""
    fault = line_fault(F.col("lp"), on_newline)
    kept = [F.col(f"`{c}`") for c in lines.columns if c not in ("lp", "reject")]
    before = [F.col("reject")] if "reject" in lines.columns else []
    return lines.select(
        *kept, F.when(fault.isNull(), F.col("lp")).alias("lp"), F.coalesce(*before, fault).alias("reject")
    )
