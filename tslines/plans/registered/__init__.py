"""Named queries over the star-schema tables, each with its equivalent in plain SQL."""

from tslines.plans.registered import (  # noqa: F401
    batching,
    delivering,
    encoding,
    ingesting,
    querying,
    reading,
    streaming,
)
from tslines.plans.registered.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
