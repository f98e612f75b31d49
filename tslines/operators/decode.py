"""Line-protocol text to points.

`parse_lines` cuts lines by a structural index over whole Arrow batches. `parse_by_pattern`
gives the same rows by expressions alone, without a Python worker, at about a third of the
speed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tslines.functions import structure, text, times
from tslines.functions.grammar import (
    FALSE_TEXT,
    FIELD_PAIR,
    LEADING_NAME,
    LINE,
    STRING,
    TAG_PAIR,
    TRUE_TEXT,
)
from tslines.model import POINTS, U64, U64_MAX, VALUE, Precision
from tslines.session import ship_package

# One line of a body, where a quoted string in the field set may run over line breaks. What
# does not follow the grammar ends at the next line break.
_HEAD = r"[^ \n\\]*+(?:\\[^\n][^ \n\\]*+)*+"
_FLAT_NAME = r"[^,= \n\\]*+(?:\\[^\n][^,= \n\\]*+)*+"
_LINE_FIELD = rf'{_FLAT_NAME}=(?:{STRING}|[^,= "\n]++)'
LOGICAL_LINE = (
    rf"(?s){_HEAD}(?: (?:{_LINE_FIELD}(?:,{_LINE_FIELD})*+)?+)?+[^\n]*+(?:\n|\z)"
)

_UINT = r"^[0-9]+u$"
_TIME = r"^-?[0-9]+$"
_NUL = "\0"


def _pairs(joined: Column, pattern: str) -> Column:
    """Raw `key=value` pairs of a tag or field text.

    Text without quotes and backslashes is cut at its commas, other text by the grammar.
    """
    tricky = F.contains(joined, F.lit('"')) | F.contains(joined, F.lit("\\"))
    by_grammar = F.regexp_extract_all(joined, F.lit(pattern), F.lit(0))
    # tag text starts with a comma, field text does not
    by_comma = F.split(joined if pattern == FIELD_PAIR else F.substr(joined, F.lit(2)), ",")
    return F.when(joined == "", F.array().cast("array<string>")).otherwise(
        F.when(tricky, by_grammar).otherwise(by_comma)
    )


def _cut_pair(pair: Column) -> Column:
    """A raw pair as the array (raw key, raw value)."""
    escaped_key = F.regexp_extract(pair, LEADING_NAME, 1)
    exact = F.array(escaped_key, F.substr(pair, F.length(escaped_key) + 2))
    return F.when(F.contains(pair, F.lit("\\")), exact).otherwise(F.split(pair, "=", 2))


def _member(raw: Column, member: str) -> Column:
    """Field text as a value of one type; NULL when it is not of that type."""
    if member == "s":
        inside = text.unescape_quoted(F.substr(raw, F.lit(2), F.length(raw) - 2))
        return F.when(raw.startswith('"'), inside)
    if member == "b":
        return F.when(raw.isin(*TRUE_TEXT), True).when(raw.isin(*FALSE_TEXT), False)
    head = F.substr(raw, F.lit(1), F.length(raw) - 1)
    if member == "i":
        return F.when(raw.endswith("i") & ~raw.startswith("+"), head.try_cast("bigint"))
    if member == "u":
        whole = head.try_cast(U64)
        in_range = whole <= F.lit(str(U64_MAX)).cast(U64)
        return F.when(raw.endswith("u") & raw.rlike(_UINT) & in_range, whole)
    # Java also reads hexadecimal floats, and a type letter at the end.
    last = F.substring(raw, -1, 1)
    hexadecimal = F.contains(raw, F.lit("x")) | F.contains(raw, F.lit("X"))
    plain = (last.between("0", "9") | (last == ".")) & ~hexadecimal
    return F.when(plain, raw.try_cast("double"))


def parse_value(raw: Column) -> Column:
    """Field text to the union value; every member NULL when the text is not a value."""

    def only(member: str) -> Column:
        return F.struct(
            *(
                (_member(raw, member) if m.name == member else F.lit(None))
                .cast(m.dataType)
                .alias(m.name)
                for m in VALUE
            )
        )

    return (
        F.when(raw.endswith("i"), only("i"))
        .when(raw.startswith('"'), only("s"))
        .when(raw.endswith("u"), only("u"))
        .when(raw.isin(*TRUE_TEXT, *FALSE_TEXT), only("b"))
        .otherwise(only("f"))
    )


def value_type(value: Column) -> Column:
    """Which member of a union value is set: f, i, u, s, b, or NULL for none."""
    return F.coalesce(*(F.when(value[m.name].isNotNull(), m.name) for m in VALUE))


def _parts(lp: Column) -> Column:
    """Measurement, tag text, field text and time text of a line as an array.

    One pass of the matcher rewrites a matching line into its four parts behind NUL marks.
    A line that holds NUL itself takes the slower form, one extraction per part.
    """
    marks = _NUL.join(["", "$1", "$2", "$3", "$4"])
    fast = F.split(F.regexp_replace(lp, LINE, marks), _NUL)
    slow = F.when(
        lp.rlike(LINE), F.array(F.lit(""), *(F.regexp_extract(lp, LINE, g) for g in (1, 2, 3, 4)))
    ).otherwise(F.array(lp))
    return F.when(F.contains(lp, F.lit(_NUL)), slow).otherwise(fast)


#: What the structural index gives for a line; time in its own unit.
INDEXED = T.StructType(
    [
        T.StructField("measurement", T.StringType()),
        POINTS["tags"],
        POINTS["fields"],
        T.StructField("time", T.LongType()),
        T.StructField("reject", T.StringType()),
    ]
)
_LATE = "time out of range"


def _as_row(lines: DataFrame, keep: list[Column], point: Column) -> DataFrame:
    """Columns that are kept, and the point's. `inline` of one struct keeps the row as it is. It also
    stops filters on the parsed columns from moving below it, where Spark would parse every
    line a second time to evaluate them."""
    return lines.select(*keep, F.inline(F.array(point)))


def parse_lines(lines: DataFrame, precision: Precision | str = Precision.NS) -> DataFrame:
    """Column `lp` to the canonical point columns plus `reject`, NULL for a good line.

    Other columns pass through. `reject` names the first thing wrong with the line; the
    point columns of a rejected line are NULL.
    """
    keep = [F.col(f"`{c}`") for c in lines.columns]
    ship_package(lines.sparkSession)
    found = lines.select(*keep, F.arrow_udf(structure.parse, INDEXED)(F.col("lp")).alias("__x"))
    x = F.col("__x")
    if Precision.parse(precision) is Precision.NS:
        names = (x["time"].alias("time_ns"), x["reject"].alias("reject"))
        cells = [x[c].alias(c) for c in ("measurement", "tags", "fields")]
        return _as_row(found, keep, F.struct(*cells, *names))
    time = times.to_nanos(x["time"], precision)
    late = x["time"].isNotNull() & time.isNull()
    cells = [F.when(~late, x[c]).alias(c) for c in ("measurement", "tags", "fields")]
    reject = F.coalesce(x["reject"], F.when(late, F.lit(_LATE)))
    return _as_row(found, keep, F.struct(*cells, time.alias("time_ns"), reject.alias("reject")))


def parse_by_pattern(lines: DataFrame, precision: Precision | str = Precision.NS) -> DataFrame:
    """`parse_lines` by expressions alone."""
    keep = [F.col(f"`{c}`") for c in lines.columns]
    parts = lines.select(*keep, _parts(F.col("lp")).alias("__p"))
    part = [F.get("__p", F.lit(i)) for i in range(5)]
    # Cutting the pairs is a transform of its own, which keeps the pieces; inside one
    # lambda they would be cut again for each use.
    raw = parts.select(
        *keep,
        text.unescape_measurement(part[1]).alias("__name"),
        F.transform(
            F.transform(_pairs(part[2], TAG_PAIR), _cut_pair),
            lambda t: F.struct(
                text.unescape_key(t[0]).alias("key"), text.unescape_key(t[1]).alias("value")
            ),
        ).alias("__tags"),
        F.transform(
            F.transform(_pairs(part[3], FIELD_PAIR), _cut_pair),
            lambda f: F.struct(
                text.unescape_key(f[0]).alias("key"), parse_value(f[1]).alias("value")
            ),
        ).alias("__fields"),
        F.nullif(part[4], F.lit("")).alias("__time"),
    )
    time = times.to_nanos(F.col("__time").try_cast("bigint"), precision)
    bad = F.filter("__fields", lambda f: value_type(f["value"]).isNull())
    reject = (
        F.when(F.col("__name").isNull(), F.lit("cannot be parsed"))
        .when(_repeats(F.col("__tags")), F.lit("tag given twice"))
        .when(_in_both(F.col("__tags"), F.col("__fields")), F.lit("name is both tag and field"))
        .when(F.size(bad) > 0, F.concat(F.lit("invalid value of field "), F.get(bad, F.lit(0))["key"]))
        .when(F.col("__time").isNotNull() & time.isNull(), F.lit(_LATE))
    )
    judged = raw.select("*", time.alias("__time_ns"), reject.alias("__reject"))
    good = F.col("__reject").isNull()
    point = F.struct(
        F.when(good, F.col("__name")).alias("measurement"),
        F.when(good, F.map_from_entries("__tags")).alias("tags"),
        F.when(good, last_fields(F.col("__fields"))).alias("fields"),
        F.when(good, F.col("__time_ns")).alias("time_ns"),
        F.col("__reject").alias("reject"),
    )
    return _as_row(judged, keep, point)


def _repeats(entries: Column) -> Column:
    keys = F.transform(entries, lambda e: e["key"])
    return F.size(F.array_distinct(keys)) < F.size(keys)


def _in_both(tags: Column, fields: Column) -> Column:
    names = [F.transform(c, lambda e: e["key"]) for c in (tags, fields)]
    return F.when(F.size(tags) > 0, F.arrays_overlap(*names)).otherwise(F.lit(False))


def last_fields(fields: Column) -> Column:
    """A field given twice in a line keeps its first place and its last value."""
    keys = F.array_distinct(F.transform(fields, lambda f: f["key"]))
    merged = F.transform(
        keys,
        lambda k: F.struct(
            k.alias("key"),
            F.element_at(F.filter(fields, lambda f: f["key"] == k), -1)["value"].alias("value"),
        ),
    )
    return F.when(_repeats(fields), merged).otherwise(fields)


def split_body(body: Column, multiline: bool = False) -> Column:
    """Lines of a body as an array; place in the array + 1 is the line number.

    The plain split cuts at every line feed; one carriage return before it, or at the end of
    the body, goes with it. `multiline=True` keeps a break inside a quoted string field. A
    break inside a name or tag value cannot be told from the end of a line by either.
    """
    if not multiline:
        return F.split(F.regexp_replace(body, r"\r\z", ""), "\r?\n")
    pieces = F.regexp_extract_all(body, F.lit(LOGICAL_LINE), F.lit(0))
    return F.transform(pieces, lambda p: F.regexp_replace(p, r"\r?\n\z|\r\z", ""))


def end_of_line(lp: Column) -> Column:
    """A line cut at line feeds only, without the carriage return that went before."""
    return F.regexp_replace(lp, r"\r\z", "")


def has_point(lp: Column) -> Column:
    """Whether a line is neither blank nor a comment."""
    return (F.trim(lp) != "") & ~lp.startswith("#")


def explode_lines(bodies: DataFrame, multiline: bool = False, key: str = "batch_id") -> DataFrame:
    """Bodies `(key, body)` to `(key, line, lp)`, lines numbered from 1.

    Blank lines and comment lines count in the numbering but yield no row.
    """
    exploded = bodies.select(
        key, F.posexplode(split_body(F.col("body"), multiline)).alias("line", "lp")
    )
    return exploded.where(has_point(F.col("lp"))).select(
        key, (F.col("line") + 1).cast("bigint").alias("line"), "lp"
    )


def parse_bodies(
    bodies: DataFrame, precision: Precision | str = Precision.NS, multiline: bool = False
) -> DataFrame:
    """Bodies to parsed lines with `seq` = (batch, line) as the write order."""
    parsed = parse_lines(explode_lines(bodies, multiline), precision)
    return parsed.withColumn(
        "seq", F.struct(F.col("batch_id").alias("batch"), F.col("line").alias("line"))
    )


def _cells(points: DataFrame, fields: dict[str, str]) -> tuple[DataFrame, dict[str, Column]]:
    """Points with a map for those whose fields stand in another order than expected, and
    the union value of every field.

    Rows of one source list their fields in the same order; where that is the order of
    `fields`, cells are taken by place. Other rows are turned into a map once and searched.
    """
    expected = F.array(*(F.lit(k) for k in fields)).cast("array<string>")
    in_order = F.transform("fields", lambda f: f["key"]) == expected
    rows = points.select("*", F.when(~in_order, F.map_from_entries("fields")).alias("__by_name"))
    cells = {
        key: F.when(F.col("__by_name").isNull(), F.get("fields", F.lit(place))["value"]).otherwise(
            F.try_element_at("__by_name", F.lit(key))
        )
        for place, key in enumerate(fields)
    }
    return rows, cells


def to_measurement(
    points: DataFrame,
    measurement: str,
    tags: list[str],
    fields: dict[str, str],
    keep: list[str] = (),
) -> DataFrame:
    """Points of one measurement as a wide table: time, one column per tag and field.

    `fields` maps field name to its member (f, i, u, s, b).
    """
    rows, cells = _cells(points.where(F.col("measurement") == measurement), fields)
    return rows.select(
        "time_ns",
        times.nanos_to_timestamp(F.col("time_ns")).alias("time"),
        *(F.try_element_at("tags", F.lit(t)).alias(t) for t in tags),
        *(cells[k][m].alias(k) for k, m in fields.items()),
        *(F.col(f"`{c}`") for c in keep),
    )


def parse_measurement(
    lines: DataFrame,
    measurement: str,
    tags: list[str],
    fields: dict[str, str],
    precision: Precision | str = Precision.NS,
) -> DataFrame:
    """Lines of one measurement of known columns straight to its wide table.

    Gives `time_ns`, the tags, the fields and `reject`, next to the other columns of `lines`.
    A field of another type than `fields` says is an invalid value. Lines that do not start
    with the measurement name are left out; fields outside `fields` are passed over.
    """
    keep = [F.col(f"`{c}`") for c in lines.columns]
    lp, prefix = F.col("lp"), text.measurement_name(measurement)
    mine = lp.startswith(prefix + ",") | lp.startswith(prefix + " ") | (lp == prefix)
    parsed = parse_lines(lines.where(mine), precision)
    rows, cells = _cells(parsed, fields)
    wrong = F.coalesce(
        F.lit(None).cast("string"),
        *(F.when(cells[k].isNotNull() & cells[k][m].isNull(), F.lit(k)) for k, m in fields.items()),
    )
    reject = F.coalesce("reject", F.concat(F.lit("invalid value of field "), wrong))
    judged = rows.select("*", reject.alias("__reject"))
    good = F.col("__reject").isNull()
    return judged.select(
        *keep,
        F.when(good, F.col("time_ns")).alias("time_ns"),
        *(F.when(good, F.try_element_at("tags", F.lit(t))).alias(t) for t in tags),
        *(F.when(good, cells[k][m]).alias(k) for k, m in fields.items()),
        F.col("__reject").alias("reject"),
    )
