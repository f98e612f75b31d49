"""Headline timings. Prints one JSON line.

BENCH_SF_DIR  folder with the tables (default /root/testdata/sf0.1)
BENCH_CPUS    cores of the local session (default 8)
BENCH_SIZES   sizes of the wide frame (default 10k,1m,10m)
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tslines.operators.batches import assign_batches, join_bodies, local_bodies
from tslines.operators.decode import parse_lines, parse_measurement, to_measurement
from tslines.operators.encode import encode_frame, encode_points
from tslines.operators.ingest import judge, last_write_wins
from tslines.plans.registered.encoding import order_points
from tslines.plans.registered.ingesting import mixed_lines, writes
from tslines.plans.registered.registry import EVENT_TAGS, Tables, event_lines
from tslines.session import local_session, prepare, scratch_path

LINE_TAGS = ["l_returnflag", "l_linestatus"]
LINE_FIELDS = {
    "l_orderkey": "i", "l_partkey": "i", "l_suppkey": "i", "l_linenumber": "i",
    "l_quantity": "f", "l_extendedprice": "f", "l_discount": "f", "l_tax": "f",
}


def telemetry(spark: SparkSession, rows: int, cores: int) -> DataFrame:
    """One tag of 32 values, 20 floats, 4 whole numbers and a time."""
    i = F.col("id")
    host = F.concat(F.lit("host-"), F.lpad((i % 32).cast("string"), 3, "0"))
    floats = [(i * (c + 1) * 0.25).alias(f"f{c}") for c in range(20)]
    whole = [(i * (c + 7)).alias(f"i{c}") for c in range(4)]
    time_ns = (F.lit(1_700_000_000_000_000_000) + i * 1_000_000).alias("time")
    return spark.range(0, rows, 1, cores).select(host.alias("host"), *floats, *whole, time_ns)


def run(df: DataFrame) -> float:
    start = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    spark = prepare(local_session("bench", str(cores), partitions=cores, memory="12g"))
    spark.sparkContext.setLogLevel("OFF")
    times: dict[str, float] = {}
    rates: dict[str, int] = {}

    def bench(name: str, rows: int, make, repeat: int = 2) -> None:
        best = None
        for _ in range(repeat):
            start = time.perf_counter()
            plan = make()
            took = time.perf_counter() - start + run(plan)
            best = took if best is None else min(best, took)
        times[name], rates[name] = round(best, 3), int(rows / best)

    # The tables come as one file each; a copy in as many files as cores keeps all busy.
    copies = scratch_path(spark, "tables")
    source = Tables(spark, folder)
    for name in ("lineitem", "events", "orders"):
        getattr(source, name).repartition(cores).write.parquet(f"{copies}/{name}.parquet")
    t = Tables(spark, copies)
    lineitem, n_lines = t.lineitem, t.lineitem.count()
    events, n_events = t.events, t.events.count()

    # Encoding. The first small run also warms the session up.
    sizes = {"10k": (10_000, 3), "1m": (1_000_000, 2), "10m": (10_000_000, 1)}
    for label in os.environ.get("BENCH_SIZES", "10k,1m,10m").split(","):
        rows, repeat = sizes[label]
        path = scratch_path(spark, f"telemetry-{label}")
        telemetry(spark, rows, cores).write.parquet(path)
        frame = spark.read.parquet(path)
        bench(f"encode_wide_{label}", rows, lambda: encode_frame(frame, "m", ["host"], "time"), repeat)
    bench("encode_lineitem", n_lines, lambda: encode_frame(
        lineitem, "lineitem", LINE_TAGS, "l_shipdate", "ms"))
    bench("encode_events", n_events, lambda: encode_frame(events, "events", EVENT_TAGS, "ts"))
    bench("encode_points", t.orders.count(), lambda: encode_points(order_points(t)))

    # Decoding of what was just encoded.
    path = scratch_path(spark, "lp")
    encode_frame(lineitem, "lineitem", LINE_TAGS, "l_shipdate", "ms").write.text(path)
    lines = spark.read.text(path).withColumnRenamed("value", "lp")
    bench("decode_points", n_lines, lambda: parse_lines(lines, "ms"))
    bench("decode_wide", n_lines, lambda: to_measurement(
        parse_lines(lines, "ms"), "lineitem", LINE_TAGS, LINE_FIELDS))
    bench("decode_quick", n_lines, lambda: parse_measurement(
        lines, "lineitem", LINE_TAGS, LINE_FIELDS, "ms"))

    # Batching.
    bench("batch_local", n_events, lambda: local_bodies(event_lines(t)))
    bench("batch_global", n_events, lambda: join_bodies(
        assign_batches(event_lines(t, keep=["event_id"]), ["event_id"])))

    # Ingest rules.
    bench("last_write_wins", 2 * n_events, lambda: last_write_wins(
        writes(t), ["user_id"], ["value", "props"]))
    bench("judge", n_events, lambda: judge(mixed_lines(t, 5000)))

    print(
        json.dumps(
            {
                "metric": "total time of line-protocol jobs",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "rows_per_sec": rates,
                "cpus": cores,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
