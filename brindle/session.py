"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the results or the skew handling rely on; all may be set at runtime.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A task gets a few megabytes of files or shuffled rows however large the tables are; in its sorts and maps they take twenty times that.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
    "spark.sql.files.maxPartitionBytes": "16m",
    # Split hot join keys even where the next step groups by the same key.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    # Rows go to Python in batches of bounded size, also where texts are long.
    "spark.sql.execution.arrow.maxBytesPerBatch": "16m",
}

INITIAL_PARTS = 200  # of a shuffle before its parts are joined, or the session's own number if that is larger

_local_folder = None
_scratch: set[str] = set()
_scope = threading.local()


def build(app: str = "brindle", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library's settings; `conf` keys use `__` for dots."""
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return tune(builder.getOrCreate())


def tune(spark: SparkSession) -> SparkSession:
    parts = max(INITIAL_PARTS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    for key, value in {**RUNTIME, "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts)}.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def work_folder(spark: SparkSession) -> str:
    """The shared folder named by `spark.checkpoint.dir`, or set on the context.

    A local session without the setting gets a folder of its own, removed when
    Python ends. A cluster session must name one that every executor can reach.
    """
    global _local_folder
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    if _local_folder is None:
        _local_folder = tempfile.TemporaryDirectory(prefix="brindle-", ignore_cleanup_errors=True)
    return _local_folder.name


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new path in the work folder; it counts as scratch."""
    path = f"{work_folder(spark)}/{label}-{uuid.uuid4().hex}"
    _scratch.add(path)
    if (inner := getattr(_scope, "paths", None)) is not None:
        inner.append(path)
    return path


def materialize(df: DataFrame, label: str = "cut") -> DataFrame:
    """Write `df` once and read it back.

    Cuts the lineage and pins values that a second run could change, such as
    the partition a row landed in. Survives lost executors. The copy stays until
    `clear_scratch`, because results that are read from it are lazy.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def hadoop(spark: SparkSession, path: str):
    """A path and the file system that it lies on."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    place, store = hadoop(spark, path)
    return store.exists(place)


def remove(spark: SparkSession, path: str) -> None:
    place, store = hadoop(spark, path)
    store.delete(place, True)


@contextmanager
def scratch_of_its_own(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """What is written to fresh paths inside, by this thread, is deleted at the end.

    It gives a `materialize` whose copies stay, as if they were written outside.
    """
    outer, _scope.paths = getattr(_scope, "paths", None), []

    def keep(df: DataFrame, label: str) -> DataFrame:
        inner, _scope.paths = _scope.paths, outer
        try:
            return materialize(df, label)
        finally:
            _scope.paths = inner

    try:
        yield keep
    finally:
        for path in _scope.paths:
            remove(spark, path)
            _scratch.discard(path)
        _scope.paths = outer


def clear_scratch(spark: SparkSession) -> int:
    """Delete what lies at fresh paths, once no result needs it any more.

    Tables under paths of one's own, and streams with a home, are not touched.
    """
    count = 0
    while _scratch:
        remove(spark, _scratch.pop())
        count += 1
    return count
