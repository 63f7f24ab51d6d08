"""Session settings and the shared work folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import wraps

from pyspark.sql import SparkSession

# Settings the jobs rely on at scale.  AQE re-plans joins from measured sizes,
# splits skewed join partitions and merges small shuffle partitions; RocksDB
# keeps streaming dedup state off the heap.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

# Settings of flows that write many tables in a row.  Shuffle files leave with the write that
# made them; else they lie there until the driver happens to collect its garbage.  A stream that
# writes one batch folder keeps its file open instead of sorting all rows by folder first.
LEAN_CONF = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.maxConcurrentOutputFileWriters": "8",
}


def build_session(app: str = "lakejobs", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the scale settings; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SCALE_CONF.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


@contextmanager
def lean(spark: SparkSession) -> Iterator[None]:
    """Work with ``LEAN_CONF``.  A stream must start and end in here: it takes some of the settings
    when it starts, and its file sink asks the session at each batch."""
    before = {key: spark.conf.get(key, None) for key in LEAN_CONF}
    for key, value in LEAN_CONF.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def leanly(step: Callable) -> Callable:
    """A step, whose first argument is the session, under ``LEAN_CONF``."""

    @wraps(step)
    def run(spark: SparkSession, *args, **kwargs):
        with lean(spark):
            return step(spark, *args, **kwargs)

    return run


def work_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``, else one in the warehouse.

    All executors see both; no folder of a single machine is ever used."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    return (configured or f"{spark.conf.get('spark.sql.warehouse.dir')}/_work").rstrip("/")


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new folder under the work folder, removed when the application ends."""
    app_dir = f"{work_dir(spark)}/lakejobs-{spark.sparkContext.applicationId}"
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(app_dir)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path)
    fs.deleteOnExit(path)
    return f"{app_dir}/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, folders: list[str]) -> None:
    """Delete folders that nothing reads any more."""
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target))
