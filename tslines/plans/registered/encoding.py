"""Encoding of frames and points, scalar functions."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tslines.functions import literals, text, times
from tslines.model import PRECISION_NAMES, Precision, WriteOptions
from tslines.operators.batches import local_bodies
from tslines.operators.encode import encode_frame, encode_points, split_faulty
from tslines.operators.points import points_from_frame, union_value, with_field, with_tag, with_time
from tslines.plans.registered.registry import (
    EVENT_LINE,
    EVENT_TAGS,
    Tables,
    event_lines,
    named,
    sql_key,
    sql_measurement,
    sql_ns,
    sql_quoted,
)
from tslines.sources.files import points_from_rows


@named("enc_frame_events", f"SELECT event_id, {EVENT_LINE} AS lp FROM events")
def enc_frame_events(t: Tables) -> DataFrame:
    return event_lines(t, keep=["event_id"])


@named(
    "enc_frame_lineitem_ms",
    """SELECT 'lineitem,l_returnflag=' || l_returnflag || ',l_linestatus=' || l_linestatus
       || ' l_orderkey=' || l_orderkey || 'i,l_partkey=' || l_partkey || 'i,l_suppkey='
       || l_suppkey || 'i,l_linenumber=' || l_linenumber || 'i,l_quantity='
       || CAST(l_quantity AS VARCHAR) || ',l_extendedprice=' || CAST(l_extendedprice AS VARCHAR)
       || ',l_discount=' || CAST(l_discount AS VARCHAR) || ',l_tax=' || CAST(l_tax AS VARCHAR)
       || ' ' || (epoch_us(l_shipdate) * 1000 // 1000000) AS lp FROM lineitem""",
)
def enc_frame_lineitem_ms(t: Tables) -> DataFrame:
    return encode_frame(
        t.lineitem, "lineitem", ["l_returnflag", "l_linestatus"], "l_shipdate", "ms"
    )


# Cells are blanked by what they hold: some rows lose the tag, some the time, some every
# field, in which case the row is dropped.
_BLANKED = """SELECT event_id,
    CASE WHEN event_type <> 'error' THEN event_type END AS kind,
    CASE WHEN value >= 20 THEN value END AS value,
    CASE WHEN value < 90 AND value >= 10 THEN props END AS props,
    CASE WHEN value < 95 THEN ts END AS moment FROM events"""


def _blanked(t: Tables) -> DataFrame:
    def only_if(condition, c: str):
        return F.when(condition, F.col(c))

    value = F.col("value")
    return t.events.select(
        "event_id",
        only_if(F.col("event_type") != "error", "event_type").alias("kind"),
        only_if(value >= 20, "value").alias("value"),
        only_if((value < 90) & (value >= 10), "props").alias("props"),
        only_if(value < 95, "ts").alias("moment"),
    )


_BLANKED_LINE = f"""'ev,event_id=' || event_id || coalesce(',kind=' || {sql_key('kind')}, '')
    || ' ' || concat_ws(',', 'value=' || CAST(value AS VARCHAR), 'props=' || {sql_quoted('props')})
    || coalesce(' ' || {sql_ns('moment')}, '')"""


@named(
    "enc_frame_nulls",
    f"""SELECT event_id, {_BLANKED_LINE} AS lp FROM ({_BLANKED})
        WHERE value IS NOT NULL OR props IS NOT NULL""",
)
def enc_frame_nulls(t: Tables) -> DataFrame:
    return encode_frame(_blanked(t), "ev", ["event_id", "kind"], "moment", keep=["event_id"])


@named(
    "enc_frame_types",
    f"""SELECT o_orderkey, 'orders\\,\\ all,o_orderpriority=' || {sql_key('o_orderpriority')}
        || ' o_orderkey=' || o_orderkey || 'i,small=' || (o_custkey % 100) || 'i,uns=' || o_custkey
        || 'u,big=' || (CAST(o_custkey AS HUGEINT) * 1000000000000) || 'i,f32='
        || CAST(CAST(o_custkey AS FLOAT) / 4 AS VARCHAR) || ',flag='
        || CAST(o_orderstatus = 'F' AS VARCHAR) || ',day='
        || (CAST(o_orderdate AS DATE) - DATE '1970-01-01') || 'i,at=' || epoch_us(o_orderdate)
        || 'i,price="' || CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) || '"'
        AS lp FROM orders""",
)
def enc_frame_types(t: Tables) -> DataFrame:
    wide = F.col("o_custkey").cast("decimal(20,0)") * F.lit(1_000_000_000_000).cast("decimal(13,0)")
    df = t.orders.select(
        "o_orderkey",
        "o_orderpriority",
        (F.col("o_custkey") % 100).cast("smallint").alias("small"),
        F.col("o_custkey").alias("uns"),
        wide.cast("decimal(38,0)").alias("big"),
        (F.col("o_custkey").cast("float") / 4).cast("float").alias("f32"),
        (F.col("o_orderstatus") == "F").alias("flag"),
        F.col("o_orderdate").cast("date").alias("day"),
        F.col("o_orderdate").alias("at"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("price"),
    )
    return encode_frame(
        df,
        "orders, all",
        ["o_orderpriority"],
        unsigned=["uns"],
        wide_int=["big"],
        keep=["o_orderkey"],
    )


@named(
    "enc_frame_documents",
    f"""SELECT doc_id, 'documents,lang=' || {sql_key('lang')} || ',source=' || {sql_key('source')}
        || ' doc_id=' || doc_id || 'i,text=' || {sql_quoted('text')} || ',n_chars=' || n_chars
        || 'i' AS lp FROM documents""",
)
def enc_frame_documents(t: Tables) -> DataFrame:
    """Whole texts, line breaks and all, as string fields."""
    return encode_frame(t.documents, "documents", ["lang", "source"], keep=["doc_id"])


WIDE = 150


@named(
    "enc_frame_wide",
    f"""SELECT o_orderkey, 'wide,p=' || {sql_key('o_orderpriority')} || ' ' || concat_ws(',',
        {", ".join(
            f"'f{i}=' || CAST(CASE WHEN o_custkey % {i + 2} <> 0 THEN o_totalprice + {i} END"
            " AS VARCHAR)" for i in range(WIDE)
        )}) || ' ' || o_orderkey AS lp FROM orders
        WHERE {" OR ".join(f"o_custkey % {i + 2} <> 0" for i in range(WIDE))}""",
)
def enc_frame_wide(t: Tables) -> DataFrame:
    """More columns than fit one generated method, with gaps."""
    cells = [
        F.when(F.col("o_custkey") % (i + 2) != 0, F.col("o_totalprice") + F.lit(float(i))).alias(
            f"f{i}"
        )
        for i in range(WIDE)
    ]
    df = t.orders.select("o_orderkey", F.col("o_orderpriority").alias("p"), *cells)
    return encode_frame(df, "wide", ["p"], "o_orderkey", keep=["o_orderkey"])


def order_points(t: Tables) -> DataFrame:
    return points_from_frame(
        t.orders,
        "orders",
        {"status": F.col("o_orderstatus"), "priority": F.col("o_orderpriority")},
        times.datetime_nanos(F.col("o_orderdate")),
        fields=["o_orderkey", "o_totalprice", "o_custkey"],
        unsigned=["o_custkey"],
    )


_ORDER_FIELDS = f"""' o_orderkey=' || o_orderkey || 'i,o_totalprice='
    || CAST(o_totalprice AS VARCHAR) || ',o_custkey=' || o_custkey || 'u'"""


@named(
    "enc_point_default_tags",
    f"""SELECT 'orders,status=' || {sql_key('o_orderstatus')} || ',env=prod,priority='
        || {sql_key('o_orderpriority')} || {_ORDER_FIELDS} || ' '
        || {sql_ns('o_orderdate')} // 1000000000 AS lp FROM orders""",
)
def enc_point_default_tags(t: Tables) -> DataFrame:
    options = WriteOptions(
        precision="s", default_tags={"env": "prod", "status": "none"}, tag_order=("status", "gone")
    )
    return encode_points(order_points(t), options)


@named(
    "enc_point_sorted_tags",
    f"""SELECT 'orders,priority=' || {sql_key('o_orderpriority')} || ',status='
        || {sql_key('o_orderstatus')} || {_ORDER_FIELDS} || ' ' || {sql_ns('o_orderdate')} AS lp
        FROM orders""",
)
def enc_point_sorted_tags(t: Tables) -> DataFrame:
    return encode_points(order_points(t))


@named(
    "enc_point_replace",
    f"""SELECT 'orders,extra\\ tag=' || o_custkey || ',priority=low,status='
        || {sql_key('o_orderstatus')} || ' o_orderkey=' || o_orderkey || 'i,o_totalprice="none",'
        || 'o_custkey=' || o_custkey || 'u,cheap=' || CAST(o_totalprice < 100000 AS VARCHAR)
        || ' ' || {sql_ns('o_orderdate')} // 1000000 AS lp FROM orders""",
)
def enc_point_replace(t: Tables) -> DataFrame:
    """Tags and fields set again keep their place and take the last value."""
    cheap = F.element_at("fields", 2)["value"]["f"] < 100_000
    points = with_field(order_points(t), "cheap", union_value("b", cheap))
    points = with_field(points, "o_totalprice", union_value("s", F.lit("none")))
    points = with_tag(points, "priority", "low")
    custkey = F.element_at("fields", 3)["value"]["u"].cast("string")
    points = with_tag(points, "extra tag", custkey)
    return encode_points(points, WriteOptions(precision="ms"))


@named(
    "enc_point_empty",
    """SELECT event_id, CASE WHEN value < 20 THEN NULL
           ELSE 'e value=' || CAST(value AS VARCHAR) END AS lp,
           CASE WHEN value < 20 THEN 'no fields' END AS reject FROM events""",
)
def enc_point_empty(t: Tables) -> DataFrame:
    """Points without any field, turned into rejects instead of failing the job."""
    df = t.events.select("event_id", F.when(F.col("value") >= 20, F.col("value")).alias("value"))
    seq = F.struct(F.col("event_id").alias("batch"), F.lit(0).cast("bigint").alias("line"))
    points = points_from_frame(df, "e", {}, fields=["value"], seq=seq)
    rows = encode_points(points, on_empty="reject", keep=["seq"])
    return rows.select(F.col("seq.batch").alias("event_id"), "lp", "reject")


@named(
    "fn_escape",
    f"""SELECT doc_id, md5({sql_measurement('text')}) AS measurement, md5({sql_key('text')}) AS tag,
        md5({sql_quoted('text')}) AS quoted FROM documents""",
)
def fn_escape(t: Tables) -> DataFrame:
    body = F.col("text")
    return t.documents.select(
        "doc_id",
        F.md5(text.escape_measurement(body)).alias("measurement"),
        F.md5(text.escape_key(body)).alias("tag"),
        F.md5(text.quoted(body)).alias("quoted"),
    )


@named("fn_unescape", "SELECT doc_id, text AS tag, text AS quoted FROM documents")
def fn_unescape(t: Tables) -> DataFrame:
    """What was escaped reads back as it was."""
    body = F.col("text")
    return t.documents.select(
        "doc_id",
        text.unescape_key(text.escape_key(body)).alias("tag"),
        text.unescape_quoted(text.escape_quoted(body)).alias("quoted"),
    )


@named(
    "fn_float_text",
    """SELECT l_orderkey, CAST(l_extendedprice AS VARCHAR) AS price,
       CAST(l_extendedprice * 1024 AS VARCHAR) AS large, CAST(l_discount / 64 AS VARCHAR) AS small,
       CAST(CAST(l_tax AS FLOAT) AS VARCHAR) AS f32 FROM lineitem""",
)
def fn_float_text(t: Tables) -> DataFrame:
    from tslines.functions.numbers import f32_text, f64_text

    texts = {
        "price": f64_text("l_extendedprice"),
        "large": f64_text("l_extendedprice * 1024"),
        "small": f64_text("l_discount / 64"),
        "f32": f32_text("cast(l_tax as float)"),
    }
    return t.lineitem.select("l_orderkey", *(F.expr(v).alias(k) for k, v in texts.items()))


@named(
    "fn_value_display",
    """SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS i,
       regexp_replace(CAST(o_totalprice AS VARCHAR), '\\.0$', '') AS f,
       CAST(o_custkey AS VARCHAR) AS u FROM orders""",
)
def fn_value_display(t: Tables) -> DataFrame:
    shown = [
        F.expr(literals.value_display(f"fields[{n}].value")).alias(name)
        for n, name in ((0, "i"), (1, "f"), (2, "u"))
    ]
    key = F.element_at("fields", 1)["value"]["i"].alias("o_orderkey")
    return order_points(t).select(key, *shown)


@named(
    "fn_scale_precision",
    """SELECT event_id, ns, ns // 1000 AS us, ns // 1000000 AS ms, ns // 1000000000 AS s FROM
       (SELECT event_id, epoch_us(ts - INTERVAL 60 YEAR) * 1000 - event_id AS ns FROM events)""",
)
def fn_scale_precision(t: Tables) -> DataFrame:
    """Times before 1970, where rounding toward zero and rounding down differ."""
    before = F.col("ts") - F.make_interval(F.lit(60))
    ns = times.datetime_nanos(before) - F.col("event_id")
    df = t.events.select("event_id", ns.alias("ns"))
    return df.select(
        "event_id",
        "ns",
        *(times.scale_time(F.col("ns"), p).alias(p) for p in ("us", "ms", "s")),
    )


@named(
    "fn_time_range",
    """SELECT o_orderkey, CASE WHEN abs(us::HUGEINT * 1000) <= 9223372036854775807
       THEN us * 1000 END AS ns FROM
       (SELECT o_orderkey, epoch_us(o_orderdate + INTERVAL 265 YEAR) AS us FROM orders)""",
)
def fn_time_range(t: Tables) -> DataFrame:
    """Datetimes beyond the range of a 64-bit nanosecond count have no time."""
    late = F.col("o_orderdate") + F.make_interval(F.lit(265))
    orders = with_time(t.orders, late)
    return orders.select("o_orderkey", F.col("time_ns").alias("ns"))


@named(
    "fn_frame_time",
    """SELECT event_id, event_id AS whole, CAST(user_id AS BIGINT) AS narrow, event_id AS uns,
       CAST(event_id - 9223372036854775808::HUGEINT AS BIGINT) AS wrapped,
       epoch_us(ts) * 1000 // 1000000 AS ms, NULL::BIGINT AS text FROM events""",
)
def fn_frame_time(t: Tables) -> DataFrame:
    """A time column by its type: whole numbers as they are, unsigned ones wrapped beyond 64
    bits with a sign, datetimes scaled, text none."""
    df = t.events.select(
        "event_id",
        F.col("event_id").alias("whole"),
        F.col("user_id").cast("int").alias("narrow"),
        F.col("event_id").cast("decimal(20,0)").alias("uns"),
        (F.col("event_id").cast("decimal(19,0)") + F.lit(Decimal(2**63))).cast("decimal(20,0)").alias("wrapped"),
        F.col("ts").alias("ms"),
        F.col("event_type").alias("text"),
    )
    kinds = {f.name: f.dataType for f in df.schema.fields}

    def time(name: str):
        c = times.frame_time(F.col(name), kinds[name], "ms")
        return (F.lit(None).cast("bigint") if c is None else c).alias(name)

    return df.select("event_id", *(time(c) for c in ("whole", "narrow", "uns", "wrapped", "ms", "text")))


_SPELLINGS = list(PRECISION_NAMES)


@named(
    "fn_precision",
    f"""SELECT event_id, spelling, CASE WHEN spelling[1] = 'n' THEN 'nanosecond'
        WHEN spelling[1] IN ('u', 'µ') OR spelling = 'microsecond' THEN 'microsecond'
        WHEN spelling[1] = 'm' THEN 'millisecond' ELSE 'second' END AS wire_name,
        ns // CASE WHEN spelling[1] = 'n' THEN 1
        WHEN spelling[1] IN ('u', 'µ') OR spelling = 'microsecond' THEN 1000
        WHEN spelling[1] = 'm' THEN 1000000 ELSE 1000000000 END AS scaled FROM
        (SELECT event_id, epoch_us(ts) * 1000 AS ns,
         {_SPELLINGS}[event_id % {len(_SPELLINGS)} + 1] AS spelling FROM events)""",
)
def fn_precision(t: Tables) -> DataFrame:
    """Every spelling of a precision, its name on the wire and the time in it."""
    names = F.array(*(F.lit(n) for n in _SPELLINGS))
    df = t.events.select(
        "event_id",
        F.get(names, (F.col("event_id") % len(_SPELLINGS)).cast("int")).alias("spelling"),
        times.datetime_nanos(F.col("ts")).alias("ns"),
    )

    def by_spelling(value) -> Column:
        found = F.lit(None)
        for name in _SPELLINGS:
            found = F.when(F.col("spelling") == name, value(Precision.parse(name))).otherwise(found)
        return found

    return df.select(
        "event_id",
        "spelling",
        by_spelling(lambda p: F.lit(p.wire_name)).alias("wire_name"),
        by_spelling(lambda p: times.scale_time(F.col("ns"), p)).alias("scaled"),
    )


@named(
    "src_points",
    """SELECT 'nation,name=' || replace(n_name, ' ', '\\ ') || ' key=' || n_nationkey || 'i' AS lp FROM nation
       UNION ALL SELECT 'customer,segment=' || replace(c_mktsegment, ' ', '\\ ') || ' c_custkey='
       || c_custkey || 'i' FROM customer""",
)
def src_points(t: Tables) -> DataFrame:
    """Points held by the caller, one per nation, together with points of a table."""
    nothing = dict.fromkeys("fiusb")
    held = points_from_rows(t.spark, (
        ("nation", {"name": r.n_name}, [{"key": "key", "value": {**nothing, "i": r.n_nationkey}}], None, None)
        for r in t.nation.toLocalIterator()
    ))
    customers = points_from_frame(t.customer, "customer", {"segment": F.col("c_mktsegment")}, fields=["c_custkey"])
    return encode_points(held.unionByName(customers))


@named(
    "enc_empty",
    """SELECT CAST(count(*) AS BIGINT) AS n_rows, 0::BIGINT AS n_lines, 0::BIGINT AS n_bodies FROM events""",
)
def enc_empty(t: Tables) -> DataFrame:
    """An empty frame gives no line and no body."""
    none = encode_frame(t.events.where("event_id < 0"), "events", EVENT_TAGS, "ts")
    return (
        t.events.agg(F.count("*").alias("n_rows"))
        .withColumn("n_lines", F.lit(none.count()).cast("bigint"))
        .withColumn("n_bodies", F.lit(local_bodies(none).count()).cast("bigint"))
    )


@named(
    "enc_newline_reject",
    """SELECT event_id, CASE WHEN kind NOT IN ('click', 'view') THEN name || ',kind=' || kind || ' text="a' || chr(10)
       || 'b",id=' || event_id || 'i' WHEN kind = 'view' THEN name || ',kind=view id=' || event_id || 'i' END AS lp,
       CASE WHEN kind = 'click' THEN CASE WHEN event_id % 2 = 0 THEN 'name starts with #'
       ELSE 'line break inside a name or tag' END END AS reject FROM
       (SELECT event_id, event_type AS kind, CASE WHEN event_type = 'click' AND event_id % 2 = 0
        THEN '#m' ELSE 'm' END AS name FROM events)""",
)
def enc_newline_reject(t: Tables) -> DataFrame:
    """Breaks inside string fields pass; those in tag values and comment names do not."""
    click, even = F.col("event_type") == "click", F.col("event_id") % 2 == 0
    df = t.events.select(
        F.when(click & even, "#m").otherwise("m").alias("name"),
        F.when(click & ~even, "cl\nick").otherwise(F.col("event_type")).alias("kind"),
        F.when(~F.col("event_type").isin("click", "view"), "a\nb").alias("text"),
        F.col("event_id").alias("id"),
    )
    seq = F.struct(F.col("id").alias("batch"), F.lit(0).cast("bigint").alias("line"))
    points = points_from_frame(df, F.col("name"), ["kind"], fields=["text", "id"], seq=seq)
    lines = split_faulty(encode_points(points, keep=["seq"]))
    return lines.select(F.col("seq.batch").alias("event_id"), "lp", "reject")
