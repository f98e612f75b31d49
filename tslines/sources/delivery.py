"""Delivering bodies through a sender the caller supplies, with retries.

No network code is part of this package. A task plays the part of one write call: it
keeps up to `max_inflight` bodies on their way, so a table with many partitions is
delivered by many writers at once.
"""

from __future__ import annotations

import random
import time
from collections import deque
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tslines.model import RESPONSES, RetryPolicy, WriteOptions
from tslines.operators.batches import compresses, local_bodies
from tslines.operators.encode import check_newlines, encode_frame, encode_points
from tslines.operators.outcomes import (
    RETRY_STATUS,
    RETRY_TRANSPORT,
    error_message,
    final_attempts,
    is_partial,
)
from tslines.session import scratch_path, sql_conf, staged
from tslines.sources.sinks import zip_bytes


class Reply(NamedTuple):
    """What a sender reports: a status, or an error kind when no reply came."""

    status: int | None = None
    error_kind: str | None = None
    retry_after: str | None = None
    body: str | None = None


Sender = Callable[[bytes, bool], Reply]

NOT_SENT = Reply(error_kind="not sent")


class DeliveryFailed(RuntimeError):
    """At least one batch was not delivered."""


def _wait_ms(reply: Reply, attempt: int, policy: RetryPolicy) -> float:
    if policy.honor_retry_after and reply.status is not None:
        text = (reply.retry_after or "").strip().removeprefix("+")
        if text.isascii() and text.isdigit():
            return int(text) * 1000.0
    return float(int(random.random() * policy.ceiling_ms(attempt)))


def _transient(reply: Reply) -> bool:
    if reply.error_kind is not None:
        return reply.error_kind in RETRY_TRANSPORT
    return reply.status in RETRY_STATUS


def _through(reply: Reply) -> bool:
    return reply.error_kind is None and reply.status is not None and 200 <= reply.status < 300


def _attempts(body: str, gzipped: bool, send: Sender, policy: RetryPolicy) -> list[Reply]:
    """Send one body until it is through, refused, or out of retries or time.

    The body is compressed once, here, so that only text moves between Spark and Python.
    """
    payload = zip_bytes(body) if gzipped else body.encode()
    start, replies = time.monotonic(), []
    while True:
        reply = Reply(*send(payload, gzipped))
        replies.append(reply)
        attempt = len(replies) - 1
        if not _transient(reply) or attempt >= policy.max_retries:
            return replies
        wait = _wait_ms(reply, attempt, policy)
        spent = (time.monotonic() - start) * 1000
        if policy.max_elapsed_ms is not None and spent + wait > policy.max_elapsed_ms:
            return replies
        time.sleep(wait / 1000)


def _send_all(
    frames: Iterator[pd.DataFrame], send: Sender, policy: RetryPolicy, inflight: int, stops: bool
) -> Iterator[pd.DataFrame]:
    """Replies to the bodies of one task, in the order of the bodies."""
    failed, rows = False, []

    def settle(batch_id, done) -> None:
        nonlocal failed
        replies = done.result()
        failed |= not _through(replies[-1])
        rows.extend((batch_id, n, *reply) for n, reply in enumerate(replies))

    def table() -> pd.DataFrame:
        # objects, so that whole numbers next to missing ones stay whole
        out = pd.DataFrame(rows, columns=RESPONSES.names, dtype=object)
        rows.clear()
        return out

    waiting: deque = deque()
    with ThreadPoolExecutor(inflight) as pool:
        for frame in frames:
            for row in frame.itertuples(index=False):
                if len(waiting) >= inflight:
                    settle(*waiting.popleft())
                if stops and failed:
                    rows.append((row.batch_id, None, *NOT_SENT))
                    continue
                work = pool.submit(_attempts, row.body, row.gzipped, send, policy)
                waiting.append((row.batch_id, work))
            # one table of replies for each transfer of bodies
            if rows:
                yield table()
        while waiting:
            settle(*waiting.popleft())
        if rows:
            yield table()


def deliver(
    batches: DataFrame,
    send: Sender,
    policy: RetryPolicy = RetryPolicy(),
    options: WriteOptions = WriteOptions(),
    path: str | None = None,
    mode: str = "report",
) -> DataFrame:
    """Send every body once per attempt and return all replies as a table.

    `send(payload, gzipped)` must be picklable. The replies are written to `path` (a fresh
    scratch path by default) in the one job that sends, and read back; looking at the
    result sends nothing again. Spark may still re-run a lost task, which is safe as
    writes are idempotent. `max_inflight=1` keeps the bodies of a partition in order.
    `mode='failfast'`: a task whose body was refused or is out of retries sends no further
    body, notes the rest as not sent (`attempt` NULL), and the call raises after the job.
    `mode='stop'` stops in the same way and returns the replies instead.
    """
    if mode not in ("report", "failfast", "stop"):
        raise ValueError(f"mode must be 'report', 'failfast' or 'stop', not {mode!r}")
    inflight, stops = options.max_inflight, mode != "report"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return _send_all(frames, send, policy, inflight, stops)

    spark = batches.sparkSession
    path = path or scratch_path(spark, "responses")
    gzipped = compresses(F.col("body"), options.gzip_threshold).alias("gzipped")
    replies = batches.select("batch_id", "body", gzipped).mapInPandas(run, RESPONSES)
    # Bodies may be megabytes each, or a few lines: an Arrow transfer is bounded by bytes, and
    # many small ones share its cost.
    small = {
        "spark.sql.execution.arrow.maxRecordsPerBatch": str(max(1000, 4 * inflight)),
        "spark.sql.execution.arrow.maxBytesPerBatch": str(64 * 1024 * 1024),
    }
    with sql_conf(spark, small):
        replies.write.parquet(path)
    stored = spark.read.schema(RESPONSES).parquet(path)
    if mode == "failfast":
        raise_on_failure(stored)
    return stored


def deliver_points(points: DataFrame, send: Sender, options: WriteOptions = WriteOptions(), **delivery) -> DataFrame:
    """Points to the replies of their delivery in one call."""
    return _deliver_lines(encode_points(points, options), send, options, **delivery)


def deliver_frame(
    df: DataFrame,
    send: Sender,
    measurement: str,
    tags: list[str] = (),
    timestamp_column: str | None = None,
    options: WriteOptions = WriteOptions(),
    encode: dict | None = None,
    **delivery,
) -> DataFrame:
    """A frame to the replies of its delivery in one call; `encode` goes to `encode_frame`."""
    lines = encode_frame(df, measurement, tags, timestamp_column, options.precision, **(encode or {}))
    return _deliver_lines(lines, send, options, **delivery)


def _deliver_lines(lines: DataFrame, send: Sender, options: WriteOptions, on_newline: str = "names", **delivery):
    """Bodies are stored first: a retried task must send the very bodies whose replies count."""
    bodies = staged(local_bodies(check_newlines(lines, on_newline), options.batch_size), "bodies")
    return deliver(bodies, send, options=options, **delivery)


def failures(responses: DataFrame) -> DataFrame:
    """Batches that were not delivered, with a message."""
    last = final_attempts(responses).where("outcome != 'ok'")
    return last.select(
        "batch_id",
        "attempts",
        "status",
        "error_kind",
        is_partial(F.col("body")).alias("partial"),
        F.coalesce("error_kind", error_message(F.col("body"))).alias("message"),
    )


def raise_on_failure(responses: DataFrame) -> None:
    """Raise for the first batch, by number, that was not delivered."""
    sent = failures(responses).where("attempts > 0")
    first = sent.orderBy("batch_id").limit(1).collect()
    if first:
        row = first[0]
        raise DeliveryFailed(
            f"batch {row['batch_id']} failed after {row['attempts']} attempt(s) "
            f"with {row['status'] or row['error_kind']}: {row['message']}"
        )
