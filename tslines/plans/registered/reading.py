"""Reading line protocol and files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tslines.operators.decode import (
    parse_bodies,
    parse_by_pattern,
    parse_lines,
    parse_measurement,
    to_measurement,
)
from tslines.operators.encode import encode_frame
from tslines.operators.ingest import learn_types, wide_schema
from tslines.plans.registered.registry import (
    EVENT_LINE,
    EVENT_TAGS,
    Tables,
    event_lines,
    named,
    sql_ns,
)
from tslines.session import scratch_path
from tslines.sources.files import read_csv, read_lp, read_parquet
from tslines.sources.sinks import write_frame, write_lines

# Files that are read whole hold about as many bytes as a large request body.
_LINES_PER_FILE = 100_000

_EVENT_FIELDS = {"event_id": "i", "value": "f", "props": "s"}

_EVENT_COLUMNS = f"""event_id, event_type, CAST(user_id AS VARCHAR) AS user_id, value, props,
    {sql_ns('ts')} AS time_ns"""


@named("lp_roundtrip", f"SELECT {_EVENT_COLUMNS} FROM events")
def lp_roundtrip(t: Tables) -> DataFrame:
    """Frame to text files and back to a wide table."""
    path = scratch_path(t.spark, "lp")
    write_lines(event_lines(t), path, _LINES_PER_FILE)
    parsed = read_lp(t.spark, path, layout="auto")
    return to_measurement(parsed, "events", EVENT_TAGS, _EVENT_FIELDS).drop("time")


@named("lp_roundtrip_by_line", f"SELECT {_EVENT_COLUMNS} FROM events")
def lp_roundtrip_by_line(t: Tables) -> DataFrame:
    """The same through the reader for files too large to be read whole."""
    path = scratch_path(t.spark, "lp")
    write_lines(event_lines(t), path)
    parsed = read_lp(t.spark, path, layout="lines")
    return to_measurement(parsed, "events", EVENT_TAGS, _EVENT_FIELDS).drop("time")


@named(
    "lp_crlf",
    """SELECT layout, event_id AS v, 'a' || chr(13) || 'b' AS s, event_type AS k, NULL::VARCHAR AS reject
       FROM events, (VALUES ('bodies'), ('lines')) AS l(layout)""",
)
def lp_crlf(t: Tables) -> DataFrame:
    """Lines that end in carriage return and line feed, with a lone return in a string."""
    lp = "concat('m,k=', event_type, ' v=', event_id, 'i,s=\"a\\rb\" ', event_id, '\\r')"
    path = scratch_path(t.spark, "lp")
    write_lines(t.events.select(F.expr(lp).alias("lp")), path, _LINES_PER_FILE)

    def read(layout: str) -> DataFrame:
        wide = to_measurement(read_lp(t.spark, path, layout=layout), "m", ["k"], {"v": "i", "s": "s"})
        return wide.select(F.lit(layout).alias("layout"), "v", "s", "k", F.lit(None).cast("string").alias("reject"))

    return read("bodies").unionByName(read("lines"))


@named("lp_roundtrip_by_pattern", f"SELECT {_EVENT_COLUMNS} FROM events")
def lp_roundtrip_by_pattern(t: Tables) -> DataFrame:
    """The reader that uses expressions alone."""
    parsed = parse_by_pattern(event_lines(t))
    return to_measurement(parsed, "events", EVENT_TAGS, _EVENT_FIELDS).drop("time")


@named("lp_roundtrip_quick", f"SELECT {_EVENT_COLUMNS} FROM events")
def lp_roundtrip_quick(t: Tables) -> DataFrame:
    """Lines with strings through the reader for known columns."""
    wide = parse_measurement(event_lines(t), "events", EVENT_TAGS, _EVENT_FIELDS)
    return wide.drop("lp", "reject")


@named(
    "lp_roundtrip_quick_numbers",
    """SELECT CAST(l_orderkey AS BIGINT) AS l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
       CAST(l_partkey AS BIGINT) AS l_partkey, CAST(l_suppkey AS BIGINT) AS l_suppkey,
       l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, epoch_us(l_shipdate) * 1000 AS time_ns, NULL::VARCHAR AS reject
       FROM lineitem""",
)
def lp_roundtrip_quick_numbers(t: Tables) -> DataFrame:
    """Lines of plain numbers, which need no pattern at all."""
    tags = ["l_returnflag", "l_linestatus"]
    whole = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    usual = encode_frame(t.lineitem, "lineitem", tags, "l_shipdate")
    fields = dict.fromkeys(whole, "i") | dict.fromkeys(["l_quantity", "l_extendedprice", "l_discount", "l_tax"], "f")
    return parse_measurement(usual, "lineitem", tags, fields).drop("lp")


@named(
    "lp_quick_deviating",
    """SELECT l_orderkey, CASE WHEN l_tax > 0.02 THEN l_tax END AS l_tax, CASE WHEN l_discount > 0.05
       THEN l_discount END AS l_discount, l_linestatus, CASE WHEN l_quantity > 25 THEN l_returnflag
       END AS l_returnflag, NULL::BIGINT AS time_ns, NULL::VARCHAR AS reject FROM lineitem""",
)
def lp_quick_deviating(t: Tables) -> DataFrame:
    """Tags and fields that come and go, and stand in another order than expected."""
    frame = t.lineitem.select(
        F.when(F.col("l_quantity") > 25, F.col("l_returnflag")).alias("l_returnflag"),
        "l_linestatus",
        F.when(F.col("l_discount") > 0.05, F.col("l_discount")).alias("l_discount"),
        F.when(F.col("l_tax") > 0.02, F.col("l_tax")).alias("l_tax"),
        "l_orderkey",
    )
    lines = encode_frame(frame, "li", ["l_linestatus", "l_returnflag"])
    fields = {"l_orderkey": "i", "l_tax": "f", "l_discount": "f"}
    return parse_measurement(lines, "li", ["l_returnflag", "l_linestatus"], fields).drop("lp")


@named(
    "lp_roundtrip_documents",
    "SELECT doc_id, text, lang, source, n_chars FROM documents",
)
def lp_roundtrip_documents(t: Tables) -> DataFrame:
    """Whole texts with line breaks, through bodies and back."""
    path = scratch_path(t.spark, "lp")
    write_frame(t.documents, path, "documents", ["lang", "source"])
    parsed = parse_bodies(t.spark.read.parquet(path), multiline=True)
    fields = {"doc_id": "i", "text": "s", "n_chars": "i"}
    wide = to_measurement(parsed, "documents", ["lang", "source"], fields)
    return wide.select("doc_id", "text", "lang", "source", "n_chars")


@named("lp_roundtrip_documents_in_blocks", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def lp_roundtrip_documents_in_blocks(t: Tables) -> DataFrame:
    """Whole texts with line breaks through files that are read in blocks, not whole."""
    path = scratch_path(t.spark, "lp")
    write_lines(encode_frame(t.documents, "documents", ["lang", "source"]), path)
    parsed = read_lp(t.spark, path, multiline=True, layout="lines")
    wide = to_measurement(parsed, "documents", ["lang", "source"], {"doc_id": "i", "text": "s", "n_chars": "i"})
    return wide.select("doc_id", "text", "lang", "source", "n_chars")


@named(
    "lp_roundtrip_learned",
    """SELECT CAST(l_orderkey AS BIGINT) AS l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
       CAST(l_partkey AS BIGINT) AS l_partkey, CAST(l_suppkey AS BIGINT) AS l_suppkey,
       l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus,
       epoch_us(l_shipdate) // 1000000 * 1000000000 AS time_ns FROM lineitem""",
)
def lp_roundtrip_learned(t: Tables) -> DataFrame:
    """Columns and types of the wide table taken from the text itself; time in seconds."""
    path = scratch_path(t.spark, "lp")
    lines = encode_frame(t.lineitem, "lineitem", ["l_returnflag", "l_linestatus"], "l_shipdate", "s")
    write_lines(lines, path, _LINES_PER_FILE)
    parsed = read_lp(t.spark, path, "s", layout="auto")
    tags, fields = wide_schema(learn_types(parsed), "lineitem")
    return to_measurement(parsed, "lineitem", tags, fields).drop("time")


# Each kind of event breaks its line in another way, or not at all.
_BROKEN = """CASE event_type
    WHEN 'click' THEN 'm v=' || value
    WHEN 'view' THEN 'm,k= v="' || event_id || '" ' || event_id
    WHEN 'purchase' THEN 'm,a=' || user_id || ',a=2 v=1i'
    WHEN 'error' THEN 'm v=' || event_id || 'i,w=NaN ' || event_id
    ELSE CASE WHEN value < 30 THEN 'm v="open ' || event_id
              ELSE 'm v=' || event_id || 'u 99999999999999999999999' END END AS lp"""


@named(
    "lp_parse_rejects",
    """SELECT event_id, CASE event_type WHEN 'purchase' THEN 'tag given twice'
        WHEN 'error' THEN 'invalid value of field w' WHEN 'click' THEN NULL WHEN 'view' THEN NULL
        ELSE CASE WHEN value < 30 THEN 'cannot be parsed' ELSE 'time out of range' END
        END AS reject,
        CASE WHEN event_type = 'click' THEN value END AS f,
        CASE WHEN event_type = 'view' THEN CAST(event_id AS VARCHAR) END AS s,
        CASE WHEN event_type = 'view' THEN event_id END AS time_ns FROM events""",
)
def lp_parse_rejects(t: Tables) -> DataFrame:
    parsed = parse_lines(t.events.selectExpr("event_id", _BROKEN))
    first = F.get("fields", F.lit(0))["value"]
    return parsed.select(
        "event_id", "reject", first["f"].alias("f"), first["s"].alias("s"), "time_ns"
    )


@named("src_parquet", f"SELECT {EVENT_LINE} AS lp FROM events")
def src_parquet(t: Tables) -> DataFrame:
    return encode_frame(read_parquet(t.spark, t.path("events")), "events", EVENT_TAGS, "ts")


@named("src_csv", f"SELECT {EVENT_LINE} AS lp FROM events")
def src_csv(t: Tables) -> DataFrame:
    """A CSV copy of the frame, read with its schema."""
    path = scratch_path(t.spark, "csv")
    events = t.events
    # two quote signs for one, so that quotes and backslashes in cells survive
    form = {"escape": '"', "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"}
    events.write.options(header=True, **form).csv(path)
    frame = read_csv(t.spark, path, events.schema, **form)
    return encode_frame(frame, "events", EVENT_TAGS, "ts")


@named(
    "src_csv_untyped",
    """SELECT 'region r_regionkey="' || r_regionkey || '",r_name="' || r_name || '"' AS lp
       FROM region""",
)
def src_csv_untyped(t: Tables) -> DataFrame:
    """Columns read as text land as string fields, numbers too."""
    path = scratch_path(t.spark, "csv")
    t.region.write.options(header=True).csv(path)
    frame = read_csv(t.spark, path, "r_regionkey string, r_name string")
    return encode_frame(frame, "region")
