"""Delivery responses as tables: classification, error bodies, line errors, backoff."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tslines.model import RetryPolicy

# Status codes and error kinds that are transient.
RETRY_STATUS = (429, 500, 502, 503, 504)
RETRY_TRANSPORT = ("connect", "timeout", "send")
RETRY_RPC = ("Unavailable", "ResourceExhausted", "Internal", "DeadlineExceeded", "Aborted")

PARTIAL = "partial write"


def classify(status: Column, error_kind: Column) -> Column:
    """`ok`, `retry` or `fatal` for one write attempt.

    `error_kind` is set when no response came: a transport error.
    """
    return (
        F.when(error_kind.isin(*RETRY_TRANSPORT), "retry")
        .when(error_kind.isNotNull(), "fatal")
        .when(status.between(200, 299), "ok")
        .when(status.isin(*RETRY_STATUS), "retry")
        .otherwise("fatal")
    )


def classify_query(error_kind: Column) -> Column:
    """`ok`, `retry` or `fatal` for a query attempt: RPC code, `transport` or `timeout`."""
    return (
        F.when(error_kind.isNull(), "ok")
        .when(error_kind.isin(*RETRY_RPC, "transport", "timeout"), "retry")
        .otherwise("fatal")
    )


def retry_after_seconds(text: Column) -> Column:
    """Seconds form of Retry-After; NULL for dates and anything else."""
    trimmed = F.regexp_replace(text, r"(?U)^\s+|\s+$", "")
    digits = F.regexp_replace(trimmed, r"^\+", "")
    return F.when(trimmed.rlike(r"^\+?[0-9]+$"), digits.try_cast("bigint"))


def _variant(body: Column) -> Column:
    return F.try_parse_json(body)


def _json_text(body: Column, path: str) -> Column:
    """Value at a path when it is a JSON string, else NULL."""
    v = _variant(body)
    is_text = F.schema_of_variant(F.try_variant_get(v, path, "variant")) == "STRING"
    return F.when(is_text, F.try_variant_get(v, path, "string"))


def _has(body: Column, path: str) -> Column:
    return F.try_variant_get(_variant(body), path, "variant").isNotNull()


def is_partial(body: Column) -> Column:
    """Whether an error body reports a partial write: its text says so and `data` is a list."""
    listed = F.schema_of_variant(F.try_variant_get(_variant(body), "$.data", "variant"))
    return F.coalesce(
        F.contains(_json_text(body, "$.error"), F.lit(PARTIAL)) & listed.startswith("ARRAY"),
        F.lit(False),
    )


def error_message(body: Column) -> Column:
    """`error` of the body, else `message` when there is no `error`, else the body itself."""
    member = F.when(_has(body, "$.error"), _json_text(body, "$.error")).otherwise(
        _json_text(body, "$.message")
    )
    return F.coalesce(member, body, F.lit(""))


def line_errors(responses: DataFrame, keep: list[str] = ("batch_id",)) -> DataFrame:
    """Rejected lines of partial writes: one row per entry, with its place in the list.

    Entries without a line number or a message are left out.
    """
    entries = F.try_variant_get(_variant(F.col("body")), "$.data", "array<variant>")
    listed = (
        responses.where(~F.col("status").between(200, 299) & is_partial(F.col("body")))
        .select(*keep, F.posexplode(entries).alias("place", "entry"))
    )

    def part(name: str, json_type: str, spark_type: str) -> Column:
        raw = F.try_variant_get("entry", f"$.{name}", "variant")
        typed = F.schema_of_variant(raw) == json_type
        return F.when(typed, F.try_variant_get("entry", f"$.{name}", spark_type))

    line = part("line_number", "BIGINT", "bigint")
    return listed.select(
        *keep,
        "place",
        F.when(line >= 0, line).alias("line"),
        part("error_message", "STRING", "string").alias("message"),
        part("original_line", "STRING", "string").alias("original_line"),
    ).where("line is not null and message is not null")


def partial_summary(
    line_errors: DataFrame, keep: list[str] = ("batch_id",), responses: DataFrame | None = None
) -> DataFrame:
    """One text per batch: how many lines were rejected, and the first reason.

    With `responses`, partial writes that list no line have a row too.
    """
    counted = line_errors.groupBy(*keep).agg(
        F.count("*").alias("n_rejected"), F.min_by("message", "place").alias("__first")
    )
    if responses is not None:
        partial = responses.where(~F.col("status").between(200, 299) & is_partial(F.col("body")))
        counted = partial.select(*keep).distinct().join(counted, list(keep), "left")
    n = F.coalesce("n_rejected", F.lit(0).cast("bigint"))
    reason = F.coalesce("__first", F.lit("unknown"))
    summary = F.concat(F.lit("partial write: "), n.cast("string"), F.lit(" line(s) rejected; first error: "), reason)
    return counted.select(*keep, n.alias("n_rejected"), summary.alias("summary"))


def backoff_ceiling_ms(attempt: Column, policy: RetryPolicy = RetryPolicy()) -> Column:
    """Longest wait after a zero-based attempt: grows by the factor up to the cap."""
    grown = F.lit(float(policy.base_delay_ms)) * F.pow(F.lit(policy.multiplier), attempt)
    return F.greatest(F.least(grown, F.lit(float(policy.max_delay_ms))), F.lit(0.0))


def backoff_ms(attempt: Column, policy: RetryPolicy = RetryPolicy()) -> Column:
    """A wait drawn evenly between 0 and the ceiling, in whole milliseconds."""
    return F.floor(F.rand() * backoff_ceiling_ms(attempt, policy))


def final_attempts(responses: DataFrame) -> DataFrame:
    """Last attempt of every batch with its class and the number of attempts made.

    A batch that was never sent has one row without an attempt number, and 0 attempts.
    """
    order = F.coalesce("attempt", F.lit(-1))
    return responses.groupBy("batch_id").agg(
        F.count("attempt").alias("attempts"),
        F.max_by("status", order).alias("status"),
        F.max_by("error_kind", order).alias("error_kind"),
        F.max_by("body", order).alias("body"),
    ).withColumn("outcome", classify(F.col("status"), F.col("error_kind")))


def exhausted(responses: DataFrame, policy: RetryPolicy = RetryPolicy()) -> DataFrame:
    """Batches whose last attempt was transient and that have no retry left."""
    return final_attempts(responses).where(
        (F.col("outcome") == "retry") & (F.col("attempts") > policy.max_retries)
    )
