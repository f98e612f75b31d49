import json

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tslines.model import RESPONSES, RetryPolicy, WriteOptions
from tslines.operators import outcomes
from tslines.sources import delivery
from tslines.sources.delivery import DeliveryFailed, Reply, deliver, failures, raise_on_failure

PARTIAL = json.dumps(
    {
        "error": "partial write of line protocol occurred",
        "data": [
            {"line_number": 7, "error_message": "no such unit", "original_line": "m v=1q"},
            {"line_number": 3}, {"error_message": "no number"},
            {"line_number": 9, "error_message": "later"},
        ],
    }
)


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column(F.col("v"))).first()[0]


@pytest.mark.parametrize("code", [429, 500, 502, 503, 504])
def test_transient_status(spark, code):
    none = F.lit(None).cast("string")
    assert one(spark, lambda v: outcomes.classify(v, none), code, "int") == "retry"


@pytest.mark.parametrize("code, want", [(200, "ok"), (204, "ok"), (400, "fatal"), (401, "fatal"), (403, "fatal"), (404, "fatal"), (422, "fatal")])
def test_definite_status(spark, code, want):
    none = F.lit(None).cast("string")
    assert one(spark, lambda v: outcomes.classify(v, none), code, "int") == want


def test_error_kinds(spark):
    status = F.lit(None).cast("int")
    rows = [("connect", "retry"), ("timeout", "retry"), ("send", "retry"), ("decode", "fatal")]
    assert all(one(spark, lambda v: outcomes.classify(status, v), k) == w for k, w in rows)
    rpc = [("Unavailable", "retry"), ("Internal", "retry"), ("Aborted", "retry"), ("InvalidArgument", "fatal"),
           ("Unauthenticated", "fatal"), ("transport", "retry"), ("timeout", "retry"), (None, "ok")]
    assert all(one(spark, outcomes.classify_query, k) == w for k, w in rpc)


@pytest.mark.parametrize("text, want", [("1", 1), ("  30 ", 30), ("+5", 5), ("Wed, 21 Oct 2015 07:28:00 GMT", None),
                                        ("nonsense", None), ("-1", None), ("1.5", None), ("", None), (None, None)])
def test_retry_after(spark, text, want):
    assert one(spark, outcomes.retry_after_seconds, text) == want


@pytest.mark.parametrize(
    "body, partial, message",
    [
        ('{"error":"database not found"}', False, "database not found"),
        ('{"message":"m"}', False, "m"),
        ('{"error":"e","message":"m"}', False, "e"),
        ('{"error":7,"message":"m"}', False, '{"error":7,"message":"m"}'),
        ('{"error":null,"message":"m"}', False, '{"error":null,"message":"m"}'),
        ('{"other":1}', False, '{"other":1}'),
        ("not json", False, "not json"),
        ('"text"', False, '"text"'),
        ("", False, ""),
        (PARTIAL, True, "partial write of line protocol occurred"),
        ('{"error":"partial write","data":{}}', False, "partial write"),
        ('{"error":"partial write","data":[]}', True, "partial write"),
        ('{"data":[]}', False, '{"data":[]}'),
    ],
)
def test_error_bodies(spark, body, partial, message):
    assert one(spark, outcomes.is_partial, body) is partial
    assert one(spark, outcomes.error_message, body) == message


def test_line_errors_and_summary(spark):
    rows = [(1, 0, 400, None, None, PARTIAL), (2, 0, 204, None, None, PARTIAL), (3, 0, 400, None, None, '{"error":"x"}')]
    errors = outcomes.line_errors(spark.createDataFrame(rows, RESPONSES))
    assert [tuple(r) for r in errors.orderBy("place").collect()] == [
        (1, 0, 7, "no such unit", "m v=1q"), (1, 3, 9, "later", None),
    ]
    assert [tuple(r) for r in outcomes.partial_summary(errors).collect()] == [
        (1, 2, "partial write: 2 line(s) rejected; first error: no such unit")
    ]
    bare = spark.createDataFrame([*rows, (4, 0, 400, None, None, '{"error":"partial write of line protocol occurred","data":[]}')], RESPONSES)
    assert sorted(tuple(r)[:2] for r in outcomes.partial_summary(errors, responses=bare).collect()) == [(1, 2), (4, 0)]
    assert "unknown" in outcomes.partial_summary(errors, responses=bare).where("batch_id = 4").first().summary


def test_backoff_never_exceeds_the_cap(spark):
    policy = RetryPolicy(base_delay_ms=100, max_delay_ms=5000)
    df = spark.range(12 * 16).select((F.col("id") % 12).alias("a"))
    row = df.select("a", outcomes.backoff_ms(F.col("a"), policy).alias("w"), outcomes.backoff_ceiling_ms(F.col("a"), policy).alias("c"))
    for r in row.collect():
        assert 0 <= r.w <= r.c == policy.ceiling_ms(r.a) <= 5000


class Script:
    """Replies from a list, the last one repeated."""

    def __init__(self, *replies):
        self.replies, self.calls = replies, 0

    def __call__(self, payload, gzipped):
        reply = self.replies[min(self.calls, len(self.replies) - 1)]
        self.calls += 1
        return reply


def send_one(spark, *replies, body="m v=1i", mode="report", options=WriteOptions(max_inflight=1), **policy):
    df = spark.createDataFrame([(7, 1, body)], "batch_id bigint, n_points int, body string").coalesce(1)
    return deliver(df, Script(*replies), RetryPolicy(base_delay_ms=1, **policy), options, mode=mode)


def attempts(df):
    return [(r.attempt, r.status) for r in df.orderBy("attempt").collect()]


def test_recovers_on_the_third_attempt(spark):
    df = send_one(spark, Reply(503), Reply(503), Reply(204))
    assert attempts(df) == [(0, 503), (1, 503), (2, 204)] and failures(df).isEmpty()


def test_gives_up_when_retries_run_out(spark):
    df = send_one(spark, Reply(503, body="busy"), max_retries=2)
    assert attempts(df) == [(0, 503), (1, 503), (2, 503)]
    assert outcomes.exhausted(df, RetryPolicy(max_retries=2)).count() == 1
    with pytest.raises(DeliveryFailed, match=r"batch 7 failed after 3 attempt\(s\) with 503: busy"):
        raise_on_failure(df)


@pytest.mark.parametrize("reply", [Reply(404, body='{"error":"database not found"}'), Reply(400, body=PARTIAL), Reply(None, "decode")])
def test_definite_failures_are_not_retried(spark, reply):
    assert len(attempts(send_one(spark, reply))) == 1


def test_transport_errors_are_retried_and_retries_can_be_off(spark):
    assert len(attempts(send_one(spark, Reply(None, "timeout"), Reply(204)))) == 2
    assert len(attempts(send_one(spark, Reply(503), max_retries=0))) == 1


def test_server_delay_and_time_budget(spark):
    slow = Reply(503, retry_after="3600")
    assert len(attempts(send_one(spark, slow, max_elapsed_ms=1000))) == 1
    assert len(attempts(send_one(spark, slow, max_elapsed_ms=1000, honor_retry_after=False))) == 4


def test_failfast_raises_after_the_job(spark):
    with pytest.raises(DeliveryFailed):
        send_one(spark, Reply(401), mode="failfast")
    with pytest.raises(ValueError):
        send_one(spark, Reply(204), mode="sometimes")


def test_stops_after_the_first_failure(spark):
    rows = [(n, 1, f"m v={n}i") for n in range(4)]
    df = spark.createDataFrame(rows, "batch_id bigint, n_points int, body string").coalesce(1)
    one = WriteOptions(max_inflight=1)
    out = deliver(df, Script(Reply(204), Reply(401, body="who")), options=one, mode="stop")
    got = {r.batch_id: (r.attempt, r.status, r.error_kind) for r in out.collect()}
    assert got == {0: (0, 204, None), 1: (0, 401, None), 2: (None, None, "not sent"), 3: (None, None, "not sent")}
    assert {r.batch_id: r.attempts for r in failures(out).collect()} == {1: 1, 2: 0, 3: 0}
    with pytest.raises(DeliveryFailed, match="batch 1 failed"):
        raise_on_failure(out)


class Recorder:
    def __init__(self, folder):
        self.folder = folder

    def __call__(self, payload, gzipped):
        import uuid
        from pathlib import Path

        Path(self.folder, uuid.uuid4().hex).write_bytes(payload)
        return Reply(204, body="gz" if gzipped else "plain")


def test_every_body_is_sent_once_however_often_the_result_is_read(spark, tmp_path):
    rows = [(i, 1, f"m v={i}i" + " " * (2000 * (i % 2))) for i in range(20)]
    df = spark.createDataFrame(rows, "batch_id bigint, n_points int, body string")
    out = deliver(df, Recorder(str(tmp_path)))
    assert out.count() == out.distinct().count() == 20
    assert len(list(tmp_path.iterdir())) == 20
    assert {r.batch_id % 2: r.body for r in out.collect()} == {0: "plain", 1: "gz"}


def test_a_transfer_of_bodies_gives_one_table_of_replies():
    rows = [(i, f"m v={i}i", False) for i in range(50)]
    frames = [pd.DataFrame(r, columns=["batch_id", "body", "gzipped"]) for r in (rows[:40], rows[40:])]
    for inflight in (1, 3):
        seen = set()

        def send(payload, gzipped, seen=seen):
            if payload in seen:
                return Reply(204)
            seen.add(payload)
            return Reply(503)

        tables = list(delivery._send_all(iter(frames), send, RetryPolicy(base_delay_ms=0), inflight, False))
        assert len(tables) <= 3
        got = [(r.batch_id, r.attempt, r.status) for t in tables for r in t.itertuples()]
        assert got == [(i, n, status) for i in range(50) for n, status in enumerate((503, 204))]
