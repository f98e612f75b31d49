"""Session settings the library relies on, and the shared scratch folder."""

from __future__ import annotations

import re
import shutil
import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

from pyspark.sql import SparkSession

# Runtime SQL settings. All can be changed on a running session, so `prepare`
# works on a session that somebody else built.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # HotSpot does not compile methods over 8,000 bytes. A stage that would need a longer
    # one runs faster as separate projections, which Spark cuts into short methods.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Bytes handed to a Python worker at once, besides the number of rows; lines may be long.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
}

_local_scratch: dict[str, str] = {}
_shipped: set[str] = set()
_run_folder: ContextVar[str | None] = ContextVar("run_folder", default=None)


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings the library needs to a running session, and ship the package."""
    ship_package(spark)
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package, once per application.

    Delivery and local batching run Python on the executors, which may not have it.
    """
    sc = spark.sparkContext
    if sc.applicationId not in _shipped:
        package = Path(__file__).parent
        archive = Path(tempfile.mkdtemp(prefix="tslines-")) / package.name
        sc.addPyFile(shutil.make_archive(str(archive), "zip", package.parent, package.name))
        _shipped.add(sc.applicationId)


def local_session(
    app: str = "tslines",
    cores: str = "*",
    partitions: int = 8,
    memory: str = "8g",
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """A single-machine session for tests and benches."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in {**RUNTIME_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by the session in `spark.checkpoint.dir`.

    A session without that setting gets a temporary folder only when it runs on one
    machine; on a cluster a machine-local folder would lose data with its executor, so
    that case is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return sc.getCheckpointDir()
    # "local-cluster" has executors of their own
    if not re.fullmatch(r"local(\[.*\])?", sc.master):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    if sc.applicationId not in _local_scratch:
        _local_scratch[sc.applicationId] = tempfile.mkdtemp(prefix="tslines-")
    return _local_scratch[sc.applicationId]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the scratch folder, or below that of the `scratch_run` around it."""
    root = _run_folder.get() or scratch_root(spark)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def scratch_run(spark: SparkSession):
    """Give what a block stages a folder of its own and delete it at the end.

    For jobs that run again and again. Whatever is to stay must be written elsewhere inside
    the block; a frame over staged tables cannot be read after it.
    """
    folder = scratch_path(spark, "run")
    token = _run_folder.set(folder)
    try:
        yield folder
    finally:
        _run_folder.reset(token)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def staged(df, name: str = "stage"):
    """Write `df` once to the shared folder and read it back.

    Used where two passes must see the very same rows (row numbers, sampled ranges,
    side effects) and where lineage has to be cut; the written table outlives executors.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def sql_conf(spark: SparkSession, settings: dict[str, str]):
    """Run a block under changed runtime settings, then put the old ones back."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def is_utc(spark: SparkSession) -> bool:
    return spark.conf.get("spark.sql.session.timeZone") in {"UTC", "Etc/UTC", "GMT", "Z"}


def is_small(df, max_rows: int) -> bool:
    """Whether `df` has at most `max_rows` rows; stops counting one row past the bound."""
    return df.limit(max_rows + 1).count() <= max_rows
