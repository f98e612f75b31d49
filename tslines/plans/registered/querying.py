"""Queries over measurement tables and normalised results."""

from __future__ import annotations

from datetime import UTC, datetime

import pyarrow as pa
from pyspark.errors import SparkRuntimeException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tslines.functions import views
from tslines.operators.points import points_from_frame
from tslines.operators.results import (
    UnsupportedType,
    as_map,
    column_names,
    iter_rows,
    map_batches,
    normalize,
    num_rows,
)
from tslines.plans import queries as q
from tslines.plans.registered.encoding import order_points
from tslines.plans.registered.registry import Tables, named

NOW_NS = 1_706_745_600_000_000_000  # 2024-02-01 00:00:00 UTC
NOW = "TIMESTAMP '2024-02-01 00:00:00'"


def event_table(t: Tables) -> DataFrame:
    """Events as a measurement table, with the whole-number time next to the readable one."""
    time = (F.unix_micros(F.col("ts").cast("timestamp")) * 1000).alias("time_ns")
    return t.events.select(
        time, F.col("ts").cast("timestamp").alias("time"), "event_id", "user_id", "event_type",
        "value", "props",
    )


def _sql(t: Tables, text: str, params=()) -> DataFrame:
    names = ["orders", "lineitem", "customer", "nation", "region", "supplier", "part"]
    q.register(t.spark, {n: getattr(t, n) for n in names} | {"events": event_table(t)})
    return q.sql(t.spark, text, params)


@named(
    "q_mean_range",
    f"SELECT round(avg(value), 9) AS mean FROM events WHERE ts > {NOW} - INTERVAL 10 DAY",
)
def q_mean_range(t: Tables) -> DataFrame:
    start = q.since(NOW_NS, days=10)
    return q.mean_since(event_table(t), "value", start).select(F.round("mean", 9).alias("mean"))


@named(
    "q_show_measurements",
    """SELECT event_type AS measurement FROM events UNION SELECT 'orders' FROM orders""",
)
def q_show_measurements(t: Tables) -> DataFrame:
    events = points_from_frame(t.events, F.col("event_type"), ["user_id"], fields=["value"])
    return q.show_measurements(events.unionByName(order_points(t)))


@named(
    "q_param_count",
    "SELECT CAST(count(*) AS BIGINT) AS n FROM events WHERE event_type = 'click'",
)
def q_param_count(t: Tables) -> DataFrame:
    return _sql(t, "SELECT COUNT(*) AS n FROM events WHERE event_type = $t", {"t": "click"})


@named(
    "q_param_types",
    """SELECT event_id, 'click,view' AS kinds, '$t' AS quoted, true AS flag, NULL::INTEGER AS none
       FROM events WHERE event_type IN ('click', 'view') AND value > 12.5 AND value < 90""",
)
def q_param_types(t: Tables) -> DataFrame:
    """Lists, numbers, booleans and NULL; a marker inside quotes stays text."""
    text = """SELECT "event_id", array_join($kinds, ',') AS kinds, '$t' AS quoted, $flag AS flag,
              CAST($none AS INT) AS "none" -- not a $marker
              FROM events WHERE array_contains($kinds, event_type) AND value > $low
              AND value < $top"""
    first = [("top", 1), ("kinds", ["click", "view"]), ("low", 12.5)]
    return _sql(t, text, [*first, ("flag", True), ("none", None), ("top", 90)])


@named(
    "q_param_map",
    """SELECT event_type, CAST(count(*) AS BIGINT) AS n, CASE event_type WHEN 'click' THEN 1
       WHEN 'view' THEN 2 END AS weight FROM events GROUP BY ALL""",
)
def q_param_map(t: Tables) -> DataFrame:
    text = """SELECT event_type, COUNT(*) AS n, try_element_at($weights, event_type) AS weight
              FROM events GROUP BY event_type"""
    return _sql(t, text, {"weights": {"click": 1, "view": 2}})


@named(
    "q_relative_range",
    """SELECT event_id, value FROM events WHERE event_type = 'click'
       AND ts >= (SELECT max(ts) FROM events) - INTERVAL 10 HOUR""",
)
def q_relative_range(t: Tables) -> DataFrame:
    """The documented relative range, with the last event as the present."""
    text = """SELECT event_id, value FROM events WHERE time >= $now - interval '10 hour'
              AND "event_type" = $kind ORDER BY time"""
    last = event_table(t).agg(F.max("time_ns").alias("ns")).first()["ns"]
    now = datetime.fromtimestamp(last // 10**9, UTC).replace(microsecond=last // 1000 % 10**6)
    return _sql(t, text, {"now": now, "kind": "click"})


@named(
    "q_time_window",
    f"""SELECT event_id FROM events WHERE ts >= {NOW} - INTERVAL 20 DAY
        AND ts < {NOW} - INTERVAL 10 DAY""",
)
def q_time_window(t: Tables) -> DataFrame:
    start, end = q.since(NOW_NS, days=20), q.since(NOW_NS, days=10)
    return event_table(t).where(q.in_range(F.col("time_ns"), start, end)).select("event_id")


@named("q_latest", "SELECT event_id, value FROM events ORDER BY ts DESC, event_id LIMIT 10")
def q_latest(t: Tables) -> DataFrame:
    return q.latest(event_table(t), 10, ["event_id"]).select("event_id", "value")


@named("q_by_time", "SELECT event_id, event_type, value FROM events ORDER BY ts, event_id")
def q_by_time(t: Tables) -> DataFrame:
    return q.by_time(event_table(t), ["event_id"]).select("event_id", "event_type", "value")


@named(
    "q_count_where",
    "SELECT CAST(count(*) AS BIGINT) AS n FROM events WHERE event_type = 'view' AND user_id = 8",
)
def q_count_where(t: Tables) -> DataFrame:
    return q.count_where(event_table(t), event_type="view", user_id=8)


def _conformance(name: str, text: str) -> None:
    """A query text that reads the same in both engines."""

    @named(name, text)
    def run(t: Tables) -> DataFrame:
        return _sql(t, text)


_conformance(
    "q_sql_join",
    """SELECT n_name, CAST(count(*) AS BIGINT) AS n, CAST(sum(CAST(l_quantity AS DECIMAL(12,2)))
       AS DECIMAL(22,2)) AS quantity FROM lineitem JOIN orders ON l_orderkey = o_orderkey
       JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
       GROUP BY n_name""",
)
_conformance(
    "q_sql_window",
    """SELECT o_orderkey, CAST(rn AS BIGINT) AS rn, before FROM (SELECT o_orderkey, o_custkey,
       row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS rn,
       lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey)
       AS before FROM orders) x WHERE rn <= 2""",
)
_conformance(
    "q_sql_setop",
    """SELECT c_nationkey AS k FROM customer INTERSECT SELECT s_nationkey FROM supplier
       EXCEPT SELECT n_nationkey FROM nation WHERE n_regionkey = 2""",
)
_conformance(
    "q_sql_rollup",
    """SELECT l_returnflag, l_linestatus, CAST(count(*) AS BIGINT) AS n,
       CAST(grouping(l_returnflag) + grouping(l_linestatus) AS BIGINT) AS level
       FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)""",
)
_conformance(
    "q_sql_cte",
    """WITH spend AS (SELECT o_custkey, sum(CAST(o_totalprice AS DECIMAL(12,2))) AS total
       FROM orders GROUP BY o_custkey), top AS (SELECT max(total) AS best FROM spend)
       SELECT c_mktsegment, CAST(count(*) AS BIGINT) AS n FROM customer
       JOIN spend ON c_custkey = o_custkey WHERE total > (SELECT best / 2 FROM top)
       GROUP BY c_mktsegment""",
)
_conformance(
    "q_sql_distinct",
    """SELECT user_id, CAST(count(DISTINCT event_type) AS BIGINT) AS kinds, max(value) AS top
       FROM events GROUP BY user_id HAVING count(DISTINCT event_type) >= 2""",
)


@named(
    "res_normalize",
    """SELECT event_id, epoch_us(ts) * 1000 AS ts, CAST(CAST(value AS DECIMAL(10,2)) AS VARCHAR)
       AS amount, CAST(user_id AS DECIMAL(20,0)) AS uns, CAST(event_id % 100 AS SMALLINT) AS small,
       value > 50 AS big, props, NULL::VARCHAR AS day FROM events""",
)
def res_normalize(t: Tables) -> DataFrame:
    """Times as nanoseconds, decimals as text; a DATE column of NULLs passes."""
    df = t.events.select(
        "event_id",
        "ts",
        F.col("value").cast("decimal(10,2)").alias("amount"),
        F.col("user_id").cast("decimal(20,0)").alias("uns"),
        (F.col("event_id") % 100).cast("smallint").alias("small"),
        (F.col("value") > 50).alias("big"),
        "props",
        F.lit(None).cast("date").alias("day"),
    )
    return normalize(df, unsigned=("uns",))


def typed_cells(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.col("l_linenumber").cast("smallint").alias("i16"),
        F.col("l_linenumber").alias("i32"),
        F.col("l_orderkey").alias("i64"),
        F.col("l_partkey").cast("decimal(20,0)").alias("u64"),
        F.col("l_quantity").alias("f64"),
        F.when(F.col("l_returnflag") != "A", F.col("l_returnflag")).alias("s"),
        (F.col("l_linestatus") == "O").alias("b"),
        F.col("l_shipdate").alias("at"),
        F.encode("l_linestatus", "UTF-8").alias("raw"),
    )


@named(
    "res_views",
    """SELECT l_orderkey AS i64, NULL::DOUBLE AS f_i16, CAST(l_linenumber AS DOUBLE) AS f_i32,
       CAST(l_partkey AS DOUBLE) AS f_u64, l_quantity AS f_f64,
       CAST(l_linenumber AS BIGINT) AS i_i16, NULL::BIGINT AS i_u64, epoch_us(l_shipdate) * 1000 AS i_at,
       NULL::BIGINT AS i_f64, CASE WHEN l_returnflag <> 'A' THEN l_returnflag END AS s_s,
       NULL::VARCHAR AS s_b, l_linestatus = 'O' AS b_b, NULL::BOOLEAN AS b_s, l_returnflag = 'A' AS n_s
       FROM lineitem""",
)
def res_views(t: Tables) -> DataFrame:
    df = typed_cells(t)
    return df.select(
        "i64",
        views.as_f64(df, "i16").alias("f_i16"),
        views.as_f64(df, "i32").alias("f_i32"),
        views.as_f64(df, "u64").alias("f_u64"),
        views.as_f64(df, "f64").alias("f_f64"),
        views.as_i64(df, "i16").alias("i_i16"),
        views.as_i64(df, "u64").alias("i_u64"),
        views.as_i64(df, "at").alias("i_at"),
        views.as_i64(df, "f64").alias("i_f64"),
        views.as_str(df, "s").alias("s_s"),
        views.as_str(df, "b").alias("s_b"),
        views.as_bool(df, "b").alias("b_b"),
        views.as_bool(df, "s").alias("b_s"),
        views.is_null(df, "s").alias("n_s"),
    )


@named(
    "res_row_map",
    """SELECT CAST(l_linenumber AS VARCHAR) AS i32, CAST(l_partkey AS VARCHAR) AS u64,
       regexp_replace(CAST(l_quantity AS VARCHAR), '\\.0$', '') AS f64,
       CASE WHEN l_returnflag = 'A' THEN 'null' ELSE l_returnflag END AS s,
       CAST(l_linestatus = 'O' AS VARCHAR) AS b, CAST(epoch_us(l_shipdate) * 1000 AS VARCHAR) AS at,
       '1b' AS raw FROM lineitem""",
)
def res_row_map(t: Tables) -> DataFrame:
    rows = as_map(typed_cells(t))
    return rows.select(
        *(F.element_at("row", c).alias(c) for c in ("i32", "u64", "f64", "s", "b", "at", "raw"))
    )


@named(
    "res_batches",
    """SELECT l_returnflag, CAST(count(*) AS BIGINT) AS n,
       CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity FROM lineitem GROUP BY 1""",
)
def res_batches(t: Tables) -> DataFrame:
    """A large result reduced batch by batch on the executors."""

    def reduce(batch: pa.RecordBatch) -> pa.RecordBatch:
        table = pa.Table.from_batches([batch])
        sums = table.group_by("l_returnflag").aggregate([("l_quantity", "sum"), ([], "count_all")])
        return pa.record_batch(
            [sums["l_returnflag"].combine_chunks(), sums["count_all"].combine_chunks(),
             sums["l_quantity_sum"].combine_chunks()],
            ["l_returnflag", "n", "quantity"],
        )

    part = map_batches(
        t.lineitem.select("l_returnflag", F.col("l_quantity").cast("bigint").alias("l_quantity")),
        reduce,
        "l_returnflag string, n bigint, quantity bigint",
    )
    return part.groupBy("l_returnflag").agg(
        F.sum("n").alias("n"), F.sum("quantity").alias("quantity")
    )


@named(
    "q_language",
    """SELECT event_type, CAST(count(*) AS BIGINT) AS n,
       'no text interface for ''influxql'': use mean_since, show_measurements and latest' AS refused
       FROM events GROUP BY 1""",
)
def q_language(t: Tables) -> DataFrame:
    """SQL text runs, text in another language is refused with a hint."""
    text = "SELECT event_type, COUNT(*) AS n FROM events GROUP BY event_type"
    counted = _sql(t, text)
    try:
        q.sql(t.spark, "SHOW MEASUREMENTS", language="influxql")
        refused = None
    except ValueError as refusal:
        refused = str(refusal)
    return counted.withColumn("refused", F.lit(refused))


@named(
    "res_columns",
    """SELECT CAST(row_number() OVER () - 1 AS INTEGER) AS place, column_name AS name,
       (SELECT CAST(count(*) AS BIGINT) FROM lineitem) AS n_rows FROM (DESCRIBE lineitem)""",
)
def res_columns(t: Tables) -> DataFrame:
    """Column names in order, next to the number of rows."""
    names = F.array(*(F.lit(c) for c in column_names(t.lineitem)))
    n = num_rows(t.lineitem)
    return t.spark.range(1).select(F.posexplode(names).alias("place", "name"), F.lit(n).cast("bigint").alias("n_rows"))


@named(
    "res_rows",
    """SELECT l_returnflag AS flag, l_linestatus AS status, CAST(count(*) AS BIGINT) AS n,
       CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity FROM lineitem GROUP BY 1, 2""",
)
def res_rows(t: Tables) -> DataFrame:
    """A small result read row by row, its cells by place and by name."""
    counted = t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("n"), F.sum(F.col("l_quantity").cast("bigint")).alias("quantity")
    )
    rows = [(r[0], r["l_linestatus"], r.n, r["quantity"]) for r in iter_rows(counted)]
    return t.spark.createDataFrame(rows, "flag string, status string, n bigint, quantity bigint")


@named(
    "res_unsupported",
    """SELECT CAST(count(*) AS BIGINT) AS n,
       'unsupported data type in query result: date' AS strict, true AS late FROM orders""",
)
def res_unsupported(t: Tables) -> DataFrame:
    """A type outside the value model fails when planning, or on its first value."""
    df = t.orders.withColumn("day", F.to_date("o_orderdate"))

    def message(work) -> str | None:
        try:
            work()
        except UnsupportedType as refusal:
            return str(refusal)
        except SparkRuntimeException as failure:
            return failure.getMessage() if hasattr(failure, "getMessage") else str(failure)
        return None

    strict = message(lambda: normalize(df, strict=True))
    late = message(lambda: normalize(df).agg(F.count("day")).collect()) or ""
    kept = normalize(df.drop("day"))
    return kept.agg(
        F.count("*").alias("n"), F.lit(strict).alias("strict"), F.lit("query result: date" in late).alias("late")
    )
