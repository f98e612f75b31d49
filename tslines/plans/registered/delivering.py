"""Delivery with retries, and responses as tables."""

from __future__ import annotations

import gzip
import time
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tslines.model import RetryPolicy, WriteOptions
from tslines.operators import outcomes
from tslines.operators.batches import assign_batches, join_bodies
from tslines.plans.registered.registry import EVENT_LINE, EVENT_TAGS, Tables, event_lines, named
from tslines.sources.delivery import Reply, deliver, deliver_frame, failures

# Every event stands for one write attempt with some outcome.
_STATUS = """CASE WHEN value < 5 THEN 429 WHEN value < 10 THEN 503 WHEN value < 15 THEN 404
    WHEN value < 20 THEN 400 WHEN value < 25 THEN 500 ELSE 204 END"""
_ERROR_KIND = """CASE WHEN value > 200 THEN 'timeout' WHEN value > 150 THEN 'decode'
    WHEN value > 120 THEN 'connect' END"""
_BODY = """CASE event_type WHEN 'click' THEN '{"error":"no such table ' || user_id || '"}'
    WHEN 'view' THEN '{"message":"try later"}' WHEN 'error' THEN 'plain text ' || event_id
    WHEN 'signup' THEN '{"error":7,"message":"unused"}'
    ELSE '{"error":"partial write of line protocol occurred","data":[{"line_number":'
        || (user_id + 1) || ',"error_message":"bad value","original_line":"m v=' || user_id
        || '"},{"error_message":"no number"},{"line_number":"5","error_message":"text number"},'
        || '{"line_number":' || (user_id + 2) || ',"error_message":"other"}]}' END"""


def responses(t: Tables) -> DataFrame:
    return t.events.selectExpr(
        "event_id AS batch_id", "0 AS attempt", f"{_STATUS} AS status",
        f"{_ERROR_KIND} AS error_kind", "CAST(user_id AS STRING) AS retry_after", f"{_BODY} AS body",
    )


_RESPONSES = f"""(SELECT event_id AS batch_id, event_type, user_id, value, {_STATUS} AS status,
    {_ERROR_KIND} AS error_kind, {_BODY} AS body FROM events)"""


@named(
    "del_classify",
    f"""SELECT batch_id, CASE WHEN error_kind IN ('timeout', 'connect') THEN 'retry'
        WHEN error_kind IS NOT NULL THEN 'fatal' WHEN status = 204 THEN 'ok'
        WHEN status IN (429, 500, 503) THEN 'retry' ELSE 'fatal' END AS outcome
        FROM {_RESPONSES}""",
)
def del_classify(t: Tables) -> DataFrame:
    outcome = outcomes.classify(F.col("status"), F.col("error_kind"))
    return responses(t).select("batch_id", outcome.alias("outcome"))


@named(
    "del_classify_query",
    """SELECT event_id, CASE WHEN event_type = 'click' THEN 'ok' WHEN event_type IN
       ('view', 'error', 'purchase') THEN 'retry' ELSE 'fatal' END AS outcome FROM events""",
)
def del_classify_query(t: Tables) -> DataFrame:
    kind = F.expr(
        """CASE event_type WHEN 'view' THEN 'Unavailable' WHEN 'error' THEN 'DeadlineExceeded'
           WHEN 'purchase' THEN 'transport' WHEN 'signup' THEN 'InvalidArgument' END"""
    )
    return t.events.select("event_id", outcomes.classify_query(kind).alias("outcome"))


@named(
    "del_error_body",
    f"""SELECT batch_id, event_type = 'purchase' AS partial, CASE event_type
        WHEN 'click' THEN 'no such table ' || user_id WHEN 'view' THEN 'try later'
        WHEN 'purchase' THEN 'partial write of line protocol occurred' ELSE body END AS message
        FROM {_RESPONSES}""",
)
def del_error_body(t: Tables) -> DataFrame:
    body = F.col("body")
    return responses(t).select(
        "batch_id",
        outcomes.is_partial(body).alias("partial"),
        outcomes.error_message(body).alias("message"),
    )


@named(
    "del_line_errors",
    f"""SELECT batch_id, 0 AS place, user_id + 1 AS line, 'bad value' AS message,
        'm v=' || user_id AS original_line FROM {_RESPONSES}
        WHERE event_type = 'purchase' AND status <> 204
        UNION ALL SELECT batch_id, 3, user_id + 2, 'other', NULL FROM {_RESPONSES}
        WHERE event_type = 'purchase' AND status <> 204""",
)
def del_line_errors(t: Tables) -> DataFrame:
    return outcomes.line_errors(responses(t))


@named(
    "del_summary",
    f"""SELECT batch_id, CAST(2 AS BIGINT) AS n_rejected,
        'partial write: 2 line(s) rejected; first error: bad value' AS summary FROM {_RESPONSES}
        WHERE event_type = 'purchase' AND status <> 204""",
)
def del_summary(t: Tables) -> DataFrame:
    answers = responses(t)
    return outcomes.partial_summary(outcomes.line_errors(answers), responses=answers)


@named(
    "del_retry_after",
    """SELECT event_id, CASE event_type WHEN 'click' THEN user_id WHEN 'view' THEN user_id END
       AS seconds FROM events""",
)
def del_retry_after(t: Tables) -> DataFrame:
    text = F.expr(
        """CASE event_type WHEN 'click' THEN CAST(user_id AS STRING)
           WHEN 'view' THEN '  ' || user_id || ' ' WHEN 'error' THEN '-' || (user_id + 1)
           WHEN 'signup' THEN 'Wed, 21 Oct 2015 07:28:00 GMT' ELSE 'nonsense' END"""
    )
    return t.events.select("event_id", outcomes.retry_after_seconds(text).alias("seconds"))


@named(
    "del_backoff_ceiling",
    """SELECT event_id, least(250.0::DOUBLE * pow(2, event_id % 12), 30000.0::DOUBLE) AS ceiling_ms,
       true AS within FROM events""",
)
def del_backoff_ceiling(t: Tables) -> DataFrame:
    """The longest wait per attempt, and that waits drawn at random keep to it."""
    attempt = F.col("event_id") % 12
    df = t.events.select(
        "event_id",
        outcomes.backoff_ceiling_ms(attempt).alias("ceiling_ms"),
        outcomes.backoff_ms(attempt).alias("wait"),
    )
    within = F.col("wait").between(F.lit(0), F.col("ceiling_ms"))
    return df.select("event_id", "ceiling_ms", within.alias("within"))


class ScriptedSender:
    """Answers by the size of the body: some are refused, some need several attempts."""

    def __init__(self):
        self.seen = Counter()

    def __call__(self, payload: bytes, gzipped: bool) -> Reply:
        attempt = self.seen[payload]
        self.seen[payload] += 1
        if len(payload) % 5 == 0:
            return Reply(400, body='{"error":"refused"}')
        if attempt < len(payload) % 4:
            return Reply(None, "timeout") if len(payload) % 2 else Reply(503, retry_after="0")
        return Reply(204)


_BODIES = f"""(SELECT batch_id, octet_length(encode(string_agg(lp, chr(10) ORDER BY event_id)))
    AS n FROM (SELECT event_id, (row_number() OVER (ORDER BY event_id) - 1) // 20 AS batch_id,
    {EVENT_LINE} AS lp FROM events) GROUP BY 1)"""
_LAST = "least(CASE WHEN n % 5 = 0 THEN 0 ELSE n % 4 END, 2)"  # two retries are allowed
_REPLIES = f"(SELECT batch_id, n, unnest(range({_LAST} + 1)) AS attempt FROM {_BODIES})"


def _delivered(t: Tables) -> DataFrame:
    lines = event_lines(t, keep=["event_id"])
    bodies = join_bodies(assign_batches(lines, ["event_id"], 20))
    policy = RetryPolicy(max_retries=2, base_delay_ms=0)
    return deliver(bodies, ScriptedSender(), policy, WriteOptions(gzip_threshold=None))


@named(
    "del_deliver",
    f"""SELECT batch_id, CAST(attempt AS INTEGER) AS attempt, CASE WHEN n % 5 = 0 THEN 400
        WHEN attempt < n % 4 THEN CASE WHEN n % 2 = 0 THEN 503 END ELSE 204 END AS status,
        CASE WHEN n % 5 <> 0 AND attempt < n % 4 AND n % 2 = 1 THEN 'timeout' END AS error_kind
        FROM {_REPLIES}""",
)
def del_deliver(t: Tables) -> DataFrame:
    return _delivered(t).select("batch_id", "attempt", "status", "error_kind")


@named(
    "del_failures",
    f"""SELECT batch_id, CASE WHEN n % 5 = 0 THEN 1 ELSE 3 END::BIGINT AS attempts,
        CASE WHEN n % 5 = 0 THEN 'refused' ELSE 'timeout' END AS message FROM {_BODIES}
        WHERE n % 5 = 0 OR n % 4 = 3""",
)
def del_failures(t: Tables) -> DataFrame:
    """Batches that did not get through within the allowed attempts."""
    return failures(_delivered(t)).select("batch_id", "attempts", "message")


@named(
    "del_exhausted",
    f"""SELECT batch_id, CAST(3 AS BIGINT) AS attempts FROM {_BODIES}
        WHERE n % 5 <> 0 AND n % 4 = 3""",
)
def del_exhausted(t: Tables) -> DataFrame:
    policy = RetryPolicy(max_retries=2)
    return outcomes.exhausted(_delivered(t), policy).select("batch_id", "attempts")


# Bodies dealt to eight writers by number, in order for each.
_WRITERS = 8


def _dealt(t: Tables) -> DataFrame:
    lines = event_lines(t, keep=["event_id"])
    bodies = join_bodies(assign_batches(lines, ["event_id"], 20))
    writer = (F.col("batch_id") % _WRITERS).cast("int")
    return bodies.repartitionById(_WRITERS, writer).sortWithinPartitions("batch_id")


@named(
    "del_failfast",
    f"""WITH b AS (SELECT batch_id, n, n % 5 = 0 OR n % 4 = 3 AS bad FROM {_BODIES}),
        f AS (SELECT batch_id % {_WRITERS} AS writer, min(batch_id) AS first FROM b WHERE bad GROUP BY 1)
        SELECT batch_id, CASE WHEN first IS NULL OR batch_id < first THEN 'through'
        WHEN batch_id = first THEN 'failed' ELSE 'not sent' END AS state
        FROM b LEFT JOIN f ON batch_id % {_WRITERS} = writer""",
)
def del_failfast(t: Tables) -> DataFrame:
    """A writer sends nothing after its first body that does not get through."""
    policy = RetryPolicy(max_retries=2, base_delay_ms=0)
    options = WriteOptions(gzip_threshold=None, max_inflight=1)
    replies = deliver(_dealt(t), ScriptedSender(), policy, options, mode="stop")
    state = F.when(F.col("attempts") == 0, "not sent").when(F.col("outcome") == "ok", "through")
    return outcomes.final_attempts(replies).select("batch_id", state.otherwise("failed").alias("state"))


class CountingSender:
    """Answers with the number of bodies it took before, and how many are on their way."""

    def __init__(self):
        self.taken, self.active = 0, 0

    def __call__(self, payload: bytes, gzipped: bool) -> Reply:
        place, self.taken, self.active = self.taken, self.taken + 1, self.active + 1
        try:
            time.sleep(0.001)
            return Reply(204, body=f"{place} {self.active}")
        finally:
            self.active -= 1


@named(
    "del_in_order",
    f"SELECT batch_id, CAST(batch_id // {_WRITERS} AS BIGINT) AS place, true AS alone FROM {_BODIES}",
)
def del_in_order(t: Tables) -> DataFrame:
    """With one body on its way at a time, a writer sends its bodies in order."""
    options = WriteOptions(gzip_threshold=None, max_inflight=1)
    said = F.split("body", " ")
    return deliver(_dealt(t), CountingSender(), options=options).select(
        "batch_id", said[0].cast("bigint").alias("place"), (said[1] == "1").alias("alone")
    )


@named("del_inflight", f"SELECT batch_id, true AS within FROM {_BODIES}")
def del_inflight(t: Tables) -> DataFrame:
    """Never more bodies on their way at once than allowed."""
    replies = deliver(_dealt(t), CountingSender(), options=WriteOptions(max_inflight=3))
    return replies.select("batch_id", F.split("body", " ")[1].cast("int").between(1, 3).alias("within"))


class SizeSender:
    """Answers with the lines and bytes it was given."""

    def __call__(self, payload: bytes, gzipped: bool) -> Reply:
        text = gzip.decompress(payload) if gzipped else payload
        return Reply(204, body=f"{text.count(chr(10).encode()) + 1} {len(text)}")


@named(
    "del_one_call",
    f"""SELECT CAST(count(*) AS BIGINT) AS n_lines,
        CAST(sum(octet_length(encode({EVENT_LINE}))) AS BIGINT) AS n_bytes, true AS sized FROM events""",
)
def del_one_call(t: Tables) -> DataFrame:
    """From a frame to the server's replies: every line arrives in one body."""
    options = WriteOptions(batch_size=50)
    replies = deliver_frame(t.events, SizeSender(), "events", EVENT_TAGS, "ts", options)
    said = F.split("body", " ")
    lines, size = said[0].cast("bigint"), said[1].cast("bigint")
    return replies.agg(
        F.sum(lines).alias("n_lines"),
        # line breaks part the lines of a body and are no part of them
        (F.sum(size) - F.sum(lines - 1)).alias("n_bytes"),
        (F.max(lines) <= options.batch_size).alias("sized"),
    )
