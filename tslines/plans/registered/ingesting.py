"""Ingest rules over lines and tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tslines.model import WriteOptions
from tslines.operators.decode import parse_lines
from tslines.operators.ingest import (
    assign_time,
    judge,
    last_write_wins,
    last_write_wins_points,
    learn_types,
    rejects,
    split,
)
from tslines.operators.points import points_from_frame
from tslines.plans.registered.encoding import order_points
from tslines.plans.registered.registry import Tables, named
from tslines.session import scratch_path
from tslines.sources.sinks import write_parsed

# Every event is written twice; the second time with a new value, or none, and new text.
_WRITES = """SELECT user_id, date_trunc('hour', ts) AS hour, event_id AS seq, value, props FROM events
    UNION ALL SELECT user_id, date_trunc('hour', ts), event_id + 1000000000,
    CASE WHEN value > 40 THEN value * 2 END, CASE WHEN value < 60 THEN event_type END FROM events"""
_CURRENT = """SELECT user_id, epoch_us(hour) * 1000 AS time_ns,
    arg_max(value, seq) FILTER (WHERE value IS NOT NULL) AS value,
    arg_max(props, seq) FILTER (WHERE props IS NOT NULL) AS props"""


def writes(t: Tables) -> DataFrame:
    hour = F.date_trunc("hour", F.col("ts").cast("timestamp"))
    time = (F.unix_micros(hour) * 1000).alias("time_ns")
    value = F.col("value")
    first = t.events.select("user_id", time, F.col("event_id").alias("seq"), "value", "props")
    second = t.events.select(
        "user_id",
        time,
        (F.col("event_id") + 1_000_000_000).alias("seq"),
        F.when(value > 40, value * 2).alias("value"),
        F.when(value < 60, F.col("event_type")).alias("props"),
    )
    return first.unionAll(second)


@named("ing_lww", f"{_CURRENT} FROM ({_WRITES}) GROUP BY ALL")
def ing_lww(t: Tables) -> DataFrame:
    return last_write_wins(writes(t), ["user_id"], ["value", "props"])


@named("ing_replay", f"{_CURRENT} FROM ({_WRITES}) GROUP BY ALL")
def ing_replay(t: Tables) -> DataFrame:
    """Every write delivered twice, and the result merged once more: nothing changes."""
    once = last_write_wins(
        writes(t).unionAll(writes(t)), ["user_id"], ["value", "props"]
    ).withColumn("seq", F.lit(0))
    return last_write_wins(once, ["user_id"], ["value", "props"])


@named(
    "ing_lww_hot_series",
    """SELECT o_orderstatus, CAST(0 AS BIGINT) AS time_ns, arg_max(o_totalprice, o_orderkey) AS price,
       arg_max(o_orderpriority, o_orderkey) FILTER (WHERE o_orderpriority <> '5-LOW') AS priority
       FROM orders GROUP BY 1""",
)
def ing_lww_hot_series(t: Tables) -> DataFrame:
    """Three (series, time) keys hold the whole table; merging happens before the shuffle."""
    rows = t.orders.select(
        "o_orderstatus",
        F.lit(0).cast("bigint").alias("time_ns"),
        F.col("o_orderkey").alias("seq"),
        F.col("o_totalprice").alias("price"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("priority"),
    )
    return last_write_wins(rows, ["o_orderstatus"], ["price", "priority"])


@named(
    "ing_lww_points",
    f"""WITH c AS ({_CURRENT} FROM ({_WRITES}) GROUP BY ALL)
        SELECT CAST(user_id AS VARCHAR) AS user_id, time_ns, 'value' AS key, value AS f,
        NULL::VARCHAR AS s FROM c WHERE value IS NOT NULL
        UNION ALL SELECT CAST(user_id AS VARCHAR), time_ns, 'props', NULL, props FROM c
        WHERE props IS NOT NULL""",
)
def ing_lww_points(t: Tables) -> DataFrame:
    rows = writes(t)
    seq = F.struct(F.col("seq").alias("batch"), F.lit(1).cast("bigint").alias("line"))
    points = points_from_frame(
        rows, "events", ["user_id"], F.col("time_ns"), ["value", "props"], seq=seq
    )
    current = last_write_wins_points(points)
    return current.select(
        F.element_at("tags", "user_id").alias("user_id"), "time_ns", F.explode("fields").alias("c")
    ).select(
        "user_id", "time_ns", F.col("c.key").alias("key"), F.col("c.value.f").alias("f"),
        F.col("c.value.s").alias("s"),
    )


_RARE = "event_id % 50 = 0"


@named(
    "ing_lww_points_few",
    f"""SELECT CAST(event_id AS VARCHAR) AS event, 'value' AS key, CASE WHEN {_RARE} AND value > 40
            THEN value * 2 ELSE value END AS f, NULL::VARCHAR AS s FROM events
        UNION ALL SELECT CAST(event_id AS VARCHAR), 'props', NULL, CASE WHEN {_RARE} THEN event_type ELSE props END FROM events""",
)
def ing_lww_points_few(t: Tables) -> DataFrame:
    """One point in fifty is written again; the others go through without being taken apart."""
    columns = ["event_id", "time_ns", "seq", "value", "props"]
    first = t.events.withColumns({"time_ns": F.col("event_id"), "seq": F.lit(0).cast("bigint")}).select(columns)
    raised = F.when(F.col("value") > 40, F.col("value") * 2)
    again = t.events.where(_RARE.replace("=", "==")).select("event_id", F.col("event_id").alias("time_ns"), F.lit(1).cast("bigint").alias("seq"), raised.alias("value"), F.col("event_type").alias("props"))
    seq = F.struct(F.col("seq").alias("batch"), F.col("event_id").cast("bigint").alias("line"))
    points = points_from_frame(first.unionByName(again), "events", ["event_id"], F.col("time_ns"), ["value", "props"], seq=seq)
    cells = last_write_wins_points(points).select(F.element_at("tags", "event_id").alias("event"), F.explode("fields").alias("c"))
    return cells.select("event", F.col("c.key").alias("key"), F.col("c.value.f").alias("f"), F.col("c.value.s").alias("s"))


# Lines in batches. Error events write `value` as text, the others as a number.
_TEXT_LINES = """event_id // {size} AS batch_id, event_id % {size} + 1 AS line,
    'ev,user=' || user_id || ' value=' || CASE WHEN event_type = 'error'
    THEN '"' || CAST(value AS VARCHAR) || '"' ELSE CAST(value AS VARCHAR) END || ' ' || event_id AS lp,
    event_id, CASE WHEN event_type = 'error' THEN 's' ELSE 'f' END AS kind"""
_JUDGED_BY = f"""(SELECT *, kind <> arg_min(kind, event_id) OVER () AS bad FROM
    (SELECT {_TEXT_LINES} FROM events))"""
_JUDGED = _JUDGED_BY.format(size=100)
_JUDGED_BY_3 = _JUDGED_BY.format(size=3)


def mixed_lines(t: Tables, size: int = 100) -> DataFrame:
    value = F.col("value").cast("string")
    text = F.when(F.col("event_type") == "error", F.concat(F.lit('"'), value, F.lit('"')))
    lines = t.events.select(
        F.expr(f"event_id div {size}").alias("batch_id"),
        (F.col("event_id") % size + 1).alias("line"),
        F.concat(
            F.lit("ev,user="), "user_id", F.lit(" value="), F.coalesce(text, value), F.lit(" "),
            "event_id",
        ).alias("lp"),
    )
    seq = F.struct(F.col("batch_id").alias("batch"), F.col("line").alias("line"))
    return parse_lines(lines).withColumn("seq", seq)


def _kept(judged: DataFrame) -> DataFrame:
    return judged.select("batch_id", "line", F.col("fields")[0]["value"].alias("v")).select(
        "batch_id", "line", F.col("v.f").alias("f"), F.col("v.s").alias("s")
    )


_KEPT = """SELECT batch_id, line, CASE WHEN kind = 'f' THEN CAST(split_part(split_part(lp,
    'value=', 2), ' ', 1) AS DOUBLE) END AS f, CASE WHEN kind = 's' THEN
    split_part(lp, '"', 2) END AS s"""


@named("ing_conflicts", f"{_KEPT} FROM {_JUDGED} WHERE NOT bad")
def ing_conflicts(t: Tables) -> DataFrame:
    """The first line written fixes the type; lines of the other type are turned down."""
    return _kept(split(judge(mixed_lines(t)))[0])


@named(
    "ing_rejects",
    f"""SELECT batch_id, line, 'type conflict on value' AS message, lp AS original_line
        FROM {_JUDGED} WHERE bad""",
)
def ing_rejects(t: Tables) -> DataFrame:
    return rejects(judge(mixed_lines(t)))


@named(
    "ing_all_or_nothing",
    f"""{_KEPT} FROM {_JUDGED_BY_3} WHERE batch_id NOT IN
        (SELECT batch_id FROM {_JUDGED_BY_3} WHERE bad)""",
)
def ing_all_or_nothing(t: Tables) -> DataFrame:
    """One bad line turns down its whole batch. Batches of three lines, so some survive."""
    judged = judge(mixed_lines(t, 3), accept_partial=False)
    return _kept(judged.where("reject is null"))


@named(
    "ing_write_call",
    f"""{_KEPT}, CAST(NULL AS VARCHAR) AS message FROM {_JUDGED_BY_3} WHERE batch_id NOT IN
        (SELECT batch_id FROM {_JUDGED_BY_3} WHERE bad)
        UNION ALL SELECT batch_id, line, NULL, NULL, CASE WHEN bad THEN 'type conflict on value'
        ELSE 'batch holds a rejected line' END FROM {_JUDGED_BY_3} WHERE batch_id IN
        (SELECT batch_id FROM {_JUDGED_BY_3} WHERE bad)""",
)
def ing_write_call(t: Tables) -> DataFrame:
    """Text to both tables in one call whose options turn down whole batches."""
    points, bad = scratch_path(t.spark, "points"), scratch_path(t.spark, "rejects")
    write_parsed(mixed_lines(t, 3), points, bad, WriteOptions(accept_partial=False))
    kept = _kept(t.spark.read.parquet(points)).withColumn("message", F.lit(None).cast("string"))
    refused = t.spark.read.parquet(bad).select("batch_id", "line", "message")
    return kept.unionByName(refused, allowMissingColumns=True)


@named("ing_stored_types", f"{_KEPT} FROM {_JUDGED} WHERE kind = 'f'")
def ing_stored_types(t: Tables) -> DataFrame:
    """Types stored earlier win over what comes first now."""
    known = t.spark.createDataFrame(
        [("ev", "value", "f")], "measurement string, key string, type string"
    )
    parsed = mixed_lines(t)
    return _kept(judge(parsed, learn_types(parsed, known)).where("reject is null"))


@named(
    "ing_learn_types",
    """SELECT 'orders' AS measurement, unnest(['status', 'priority', 'o_orderkey', 'o_totalprice',
           'o_custkey']) AS key, unnest(['tag', 'tag', 'i', 'f', 'u']) AS type
       UNION ALL SELECT 'ev', 'user', 'tag'
       UNION ALL SELECT 'ev', 'value', CASE WHEN arg_min(event_type, event_id) = 'error' THEN 's'
           ELSE 'f' END FROM events""",
)
def ing_learn_types(t: Tables) -> DataFrame:
    lines = mixed_lines(t)
    columns = ["measurement", "tags", "fields", "time_ns", "seq"]
    orders = order_points(t).withColumn(
        "seq",
        F.struct(
            F.element_at("fields", 1)["value"]["i"].alias("batch"),
            F.lit(0).cast("bigint").alias("line"),
        ),
    )
    types = learn_types(lines.select(columns).unionByName(orders.select(columns)))
    return types.select("measurement", "key", "type")


@named(
    "ing_assigned_time",
    """SELECT event_id, CASE WHEN value < 50 THEN epoch_us(ts) * 1000
       ELSE 1700000000000000000 END AS time_ns FROM events""",
)
def ing_assigned_time(t: Tables) -> DataFrame:
    time = F.when(F.col("value") < 50, F.unix_micros(F.col("ts").cast("timestamp")) * 1000)
    rows = t.events.select("event_id", time.alias("time_ns"))
    return assign_time(rows, 1_700_000_000_000_000_000)


@named(
    "ing_own_clash",
    """SELECT event_id, CASE event_type WHEN 'click' THEN 'name is both tag and field'
       WHEN 'view' THEN 'type conflict on a' END AS reject FROM events
       WHERE (SELECT min(event_id) FROM events WHERE event_type NOT IN ('click', 'view'))
             < (SELECT min(event_id) FROM events WHERE event_type = 'view')
       UNION ALL SELECT event_id, CASE WHEN event_type = 'click' THEN 'name is both tag and field'
       WHEN event_type <> 'view' THEN 'type conflict on a' END FROM events
       WHERE (SELECT min(event_id) FROM events WHERE event_type NOT IN ('click', 'view'))
             > (SELECT min(event_id) FROM events WHERE event_type = 'view')""",
)
def ing_own_clash(t: Tables) -> DataFrame:
    """Lines that use a name as tag and field are refused and store no type."""
    lp = """CASE event_type WHEN 'click' THEN concat('m,a=x a=', event_id)
            WHEN 'view' THEN concat('m,a=y b=', event_id) ELSE concat('m a=', event_id) END"""
    lines = t.events.select(
        F.lit(0).cast("bigint").alias("batch_id"), F.col("event_id").cast("bigint").alias("line"), F.expr(lp).alias("lp")
    )
    order = F.struct(F.col("batch_id").alias("batch"), F.col("line").alias("line"))
    judged = judge(parse_lines(lines).withColumn("seq", order))
    return judged.select(F.col("line").alias("event_id"), "reject")


_PARTS = """SELECT event_id, user_id % 40 AS part, CASE event_type WHEN 'error' THEN 's' WHEN 'view' THEN 'i' ELSE 'f' END AS kind FROM events"""


@named(
    "ing_conflict_parts",
    f"""SELECT event_id, CASE WHEN kind <> arg_min(kind, event_id) OVER (PARTITION BY part)
            THEN 'type conflict on x' || part END AS reject FROM ({_PARTS})""",
)
def ing_conflict_parts(t: Tables) -> DataFrame:
    """One measurement whose disputed names fall into parts that are judged apart: each line
    uses both names of its part."""
    value = """CASE event_type WHEN 'error' THEN '"t"' WHEN 'view' THEN '1i' ELSE '1.5' END"""
    lp = f"concat('m x', user_id % 40, '=', {value}, ',y', user_id % 40, '=', {value})"
    lines = t.events.select(
        F.lit(0).cast("bigint").alias("batch_id"), F.col("event_id").cast("bigint").alias("line"), F.expr(lp).alias("lp")
    )
    order = F.struct(F.col("batch_id").alias("batch"), F.col("line").alias("line"))
    judged = judge(parse_lines(lines).withColumn("seq", order))
    return judged.select(F.col("line").alias("event_id"), "reject")
