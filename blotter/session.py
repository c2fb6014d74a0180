"""Session helpers: a local session for tests/bench and the shared folder.

Library code never creates a session; it receives one. ``shared_dir`` reads
the cluster's shared folder from ``spark.checkpoint.dir``; ``ensure_shared_dir``
sets one for tests, bench and the driver's entry in local mode.
"""

from __future__ import annotations

import os
import tempfile
import threading
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


#: Settings of every session this project starts: tests, bench and the refresh job alike.
SETTINGS = {
    # HotSpot never JIT-compiles methods over 8000 bytes of bytecode; with this limit Spark
    # falls back to per-expression codegen for such stages instead of running one huge
    # interpreted method (Spark's documented HotSpot advice).
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # many distinct dashboard queries: keep their compiled classes (default 100)
    "spark.sql.codegen.cache.maxEntries": "2000",
    # medians keep a small map for each group: sort only above this many groups in a task
    # (default 128), instead of sorting all rows of a few hundred types
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "8192",
}


def local_session(cores: int | str = "*", app: str = "blotter",
                  shuffle_partitions: int = 8, task_attempts: int = 4,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """A local[N] session configured the way the tests and bench expect.

    ``task_attempts`` (as ``local[N,F]``) lets a failed task be retried like on a
    cluster (default 4), so retry behaviour can be exercised locally; ``extra``
    adds or overrides settings (e.g. another session time zone).
    """
    builder = (
        SparkSession.builder.master(f"local[{cores},{int(task_attempts)}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BLOTTER_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in {**SETTINGS, **(extra or {})}.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def app_id(spark: SparkSession) -> str:
    """Application id (also available on sessions without a local SparkContext)."""
    return spark.conf.get("spark.app.id", None) or spark.sparkContext.applicationId


def shared_dir(spark: SparkSession) -> str:
    """Folder shared by all executors, taken from ``spark.checkpoint.dir``.

    Library code calls this and never invents a folder: without the setting it fails.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not configured:
        raise RuntimeError(
            "spark.checkpoint.dir is not set: point it at a folder shared by the cluster")
    return configured.rstrip("/")


def ensure_shared_dir(spark: SparkSession) -> str:
    """For tests, bench and the driver's entry: in local mode only, set a fresh folder
    where ``spark.checkpoint.dir`` is unset. On a cluster the setting is required."""
    sc = spark.sparkContext
    if not (spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()) \
            and sc.master.startswith("local") and not sc.master.startswith("local-cluster"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="blotter-"))
    return shared_dir(spark)


def ensure_compiled(spark: SparkSession) -> None:
    """For the driver's entry: a session that left Spark's default method limit gets that of
    ``SETTINGS``, so that the wide silver and gold projections are compiled."""
    key = "spark.sql.codegen.hugeMethodLimit"
    if spark.conf.get(key) == "65535":
        spark.conf.set(key, SETTINGS[key])


def rebalanced(df: DataFrame, *columns: str) -> DataFrame:
    """Rows dealt out for a write that is partitioned by the columns: adaptive execution cuts
    large values into files of the advisory size and merges small ones. Without it the hint
    would be a plain hash (one task for each value), so rows stay where they are."""
    aqe = df.sparkSession.conf.get("spark.sql.adaptive.enabled", "true").lower() == "true"
    return df.hint("rebalance", *columns) if aqe else df


#: bytes of input whose rows are shuffled at once by a step that writes a table, and the slices in
#: which a step runs at most: each slice reads the input again
SLICE_BYTES, MOST_SLICES = 512 << 20, 8


def slices_of(size: int) -> int:
    """Slices for an input of so many bytes."""
    return max(1, min(MOST_SLICES, -(-size // SLICE_BYTES)))


def sliced(df: DataFrame, slices: int, number: Column) -> list[DataFrame]:
    """The rows in slices by a whole number of each; rows of equal numbers are in one slice. Work by the
    keys that the number is made of, done slice after slice, gives the same rows, and needs the disk of one
    slice's shuffle only."""
    if slices == 1:
        return [df]
    # the idle coalesce keeps the filter out of the wide projections that follow: where those are too large
    # to be compiled as one, each slice would copy all rows of the table before it drops most of them
    return [df.where(F.pmod(number, F.lit(slices)) == i).coalesce(1_000_000) for i in range(slices)]


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_RELEASING: Counter[int] = Counter()
_RELEASING_LOCK = threading.Lock()


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of the queries run inside are removed as each query ends, not when the driver
    happens to collect its plan. A session with a setting of its own keeps it."""
    key = id(spark)
    with _RELEASING_LOCK:
        ours = _RELEASING[key] > 0 or spark.conf.get(_CLEANUP, None) is None
        if ours:
            spark.conf.set(_CLEANUP, "true")
            _RELEASING[key] += 1
    try:
        yield
    finally:
        with _RELEASING_LOCK:
            if ours:
                _RELEASING[key] -= 1
                if not _RELEASING[key]:
                    spark.conf.unset(_CLEANUP)
