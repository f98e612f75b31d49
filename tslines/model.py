"""Schemas, precision names, write options and retry policy."""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from enum import Enum

from pyspark.sql import types as T

U64 = T.DecimalType(20, 0)
U64_MAX = 2**64 - 1

VALUE = T.StructType(
    [
        T.StructField("f", T.DoubleType()),
        T.StructField("i", T.LongType()),
        T.StructField("u", U64),
        T.StructField("s", T.StringType()),
        T.StructField("b", T.BooleanType()),
    ]
)
FIELD = T.StructType([T.StructField("key", T.StringType()), T.StructField("value", VALUE)])
SEQ = T.StructType([T.StructField("batch", T.LongType()), T.StructField("line", T.LongType())])

POINTS = T.StructType(
    [
        T.StructField("measurement", T.StringType(), False),
        T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
        T.StructField("fields", T.ArrayType(FIELD)),
        T.StructField("time_ns", T.LongType()),
        T.StructField("seq", SEQ),
    ]
)
BATCHES = T.StructType(
    [
        T.StructField("batch_id", T.LongType()),
        T.StructField("n_points", T.IntegerType()),
        T.StructField("body", T.StringType()),
    ]
)
REJECTS = T.StructType(
    [
        T.StructField("batch_id", T.LongType()),
        T.StructField("line", T.LongType()),
        T.StructField("message", T.StringType()),
        T.StructField("original_line", T.StringType()),
    ]
)
RESPONSES = T.StructType(
    [
        T.StructField("batch_id", T.LongType()),
        T.StructField("attempt", T.IntegerType()),
        T.StructField("status", T.IntegerType()),
        T.StructField("error_kind", T.StringType()),
        T.StructField("retry_after", T.StringType()),
        T.StructField("body", T.StringType()),
    ]
)

# Names of the value members, in struct order, with the Spark type of each.
VALUE_TYPES = {member.name: member.dataType for member in VALUE.fields}


class Precision(Enum):
    """Time precision: wire name and nanoseconds per unit."""

    NS = ("nanosecond", 1)
    US = ("microsecond", 1_000)
    MS = ("millisecond", 1_000_000)
    S = ("second", 1_000_000_000)

    @property
    def wire_name(self) -> str:
        return self.value[0]

    @property
    def nanos(self) -> int:
        return self.value[1]

    @classmethod
    def parse(cls, name: Precision | str) -> Precision:
        if isinstance(name, Precision):
            return name
        if name not in PRECISION_NAMES:
            raise ValueError(f"unknown precision: {name}")
        return PRECISION_NAMES[name]


# Every spelling the write interface accepts.
PRECISION_NAMES = {
    "nanosecond": Precision.NS,
    "ns": Precision.NS,
    "microsecond": Precision.US,
    "us": Precision.US,
    "µs": Precision.US,
    "millisecond": Precision.MS,
    "ms": Precision.MS,
    "second": Precision.S,
    "s": Precision.S,
}

# Documented write defaults.
DEFAULT_BATCH_SIZE = 5_000
DEFAULT_MAX_INFLIGHT = 4
DEFAULT_GZIP_THRESHOLD = 1_024


@dataclass(frozen=True)
class WriteOptions:
    """Settings of one write.

    `default_tags` and `tag_order` act on points only, precision and batch size on points
    and frames, `gzip_threshold` on stored payloads and on delivery, `max_inflight` on
    delivery, and `accept_partial` on parsed text (`sinks.write_parsed`).
    """

    precision: Precision = Precision.NS
    batch_size: int = DEFAULT_BATCH_SIZE
    default_tags: dict[str, str] = field(default_factory=dict)
    tag_order: tuple[str, ...] = ()
    gzip_threshold: int | None = DEFAULT_GZIP_THRESHOLD
    accept_partial: bool = True
    max_inflight: int = DEFAULT_MAX_INFLIGHT

    def __post_init__(self):
        object.__setattr__(self, "precision", Precision.parse(self.precision))
        object.__setattr__(self, "tag_order", tuple(self.tag_order))
        # 0 means "smallest possible" for both counts, as in the write interface.
        object.__setattr__(self, "batch_size", max(1, self._count("batch_size")))
        object.__setattr__(self, "max_inflight", max(1, self._count("max_inflight")))
        if self.gzip_threshold is not None:
            self._count("gzip_threshold")

    def _count(self, name: str) -> int:
        value = getattr(self, name)
        if isinstance(value, bool) or not isinstance(value, int) or value < 0:
            raise ValueError(f"{name} must be a whole number of at least 0, not {value!r}")
        return value

    def with_(self, **changes) -> WriteOptions:
        return replace(self, **changes)

    def default_tag(self, key: str, value: str) -> WriteOptions:
        return replace(self, default_tags={**self.default_tags, key: value})


@dataclass(frozen=True)
class RetryPolicy:
    """How often and how long to retry a batch whose failure is transient."""

    max_retries: int = 3
    base_delay_ms: int = 250
    max_delay_ms: int = 30_000
    multiplier: float = 2.0
    honor_retry_after: bool = True
    max_elapsed_ms: int | None = None

    @classmethod
    def disabled(cls) -> RetryPolicy:
        return cls(max_retries=0)

    def ceiling_ms(self, attempt: int) -> float:
        """Longest wait after the zero-based `attempt`."""
        return max(0.0, min(self.base_delay_ms * self.multiplier**attempt, self.max_delay_ms))
