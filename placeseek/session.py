"""Session helpers: shared scratch folders and size checks.

Nothing here builds a session for library code; operators receive the
caller's ``SparkSession``.  ``local_session`` exists for tests and the bench.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_KEY = "spark.checkpoint.dir"
#: With this setting, what a query has shuffled is dropped when it ends, not when the driver collects its garbage.
SHUFFLES_DROPPED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, checkpoint_dir: str | None = None) -> SparkSession:
    """A local session for tests and the bench (UI off, AQE on, UTC)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("placeseek")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
    )
    if checkpoint_dir:
        builder = builder.config(CHECKPOINT_KEY, checkpoint_dir)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``placeseek`` importable in the Python workers of ``spark``.

    Python code that runs in tasks (the Excel data source, the column audit)
    is pickled by reference to its module, so executors must be able to
    import the package.  The package is zipped once on the driver and handed
    to ``SparkContext.addPyFile``, which copies it to every executor.
    """
    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    import zipfile

    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="placeseek-pyfiles-"), "placeseek.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, dirs, files in os.walk(pkg_dir):
            dirs[:] = [d for d in dirs if d != "__pycache__"]
            for name in files:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(pkg_dir)))
    sc.addPyFile(archive)
    _SHIPPED.add(key)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    It is read from the session and never overridden (and handed to the
    SparkContext if only the session has it).  Only where it is unset and all
    tasks run in this very process (master ``local``, as in tests) is a folder of
    our own made; on a cluster a driver-local folder would be invisible to
    the executors, so a missing setting is an error.
    """
    sc = spark.sparkContext
    root = spark.conf.get(CHECKPOINT_KEY, None) or sc.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError(f"set {CHECKPOINT_KEY} to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="placeseek-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder path under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/placeseek/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back: what
    follows neither recomputes it nor loses it with an executor."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def removed(spark: SparkSession, path: str) -> None:
    """Drop a scratch folder that nothing returned to the caller reads."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def session_conf(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """``settings`` hold for the queries run in the block; then the session has its own again."""
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def estimated_bytes(df: DataFrame) -> int | None:
    """Spark's own estimate of the size of ``df`` (file sizes for a scan), made
    without a job; None where it has none."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return size if size < 1 << 60 else None


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Rebalance ``df`` on ``keys`` only where its scan is too small to give every
    task slot a full split.

    Per-word work (explode, edit distance, sound codes) is CPU-bound and
    narrow: it runs in the scan's tasks.  A large input already arrives in
    thousands of splits and is left alone (no shuffle); a few big row
    groups would keep most cores idle, so they are hash-partitioned on the
    key (deterministic on retry, no sort needed) before the heavy step.
    """
    spark = df.sparkSession
    slots = spark.sparkContext.defaultParallelism
    split = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    size = estimated_bytes(df)
    if df.isStreaming or size is None or size >= slots * split:
        return df
    return df.repartition(slots, *keys) if keys else df.repartition(slots)


# A side whose estimate is this many times the byte bound is not even measured.
MEASURED_UP_TO = 16


def fits_for_broadcast(df: DataFrame, max_rows: int, max_bytes: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows *and* its values take
    at most ``max_bytes`` (text bytes of every column).

    One aggregate measures both; one row reaches the driver.  Spark's estimate only
    ever turns a side down (a scan of many times the bound is not worth
    measuring), never accepts one.
    """
    size = estimated_bytes(df)
    if size is not None and size > MEASURED_UP_TO * max_bytes:
        return False
    width = sum(
        (F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) for c in df.columns),
        F.lit(0),
    )
    rows, total = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    return rows <= max_rows and total <= max_bytes
