"""Set a session up for the operators' Python workers: code and batch size."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def ship(spark: SparkSession) -> None:
    """Add the package to the session once, as ``--py-files`` would; Spark hands the archive to
    every executor. It is code only, and built in the driver's own folder, from where Spark's
    file server sends it out.

    Where the session has the default, Arrow batches are cut to 16 MB, as several columns of
    text and their numpy copies are in memory at once."""
    if spark.conf.get(BATCH_BYTES, None) in (None, "64MB", "67108864b"):
        spark.conf.set(BATCH_BYTES, "16m")
    context = spark.sparkContext
    if getattr(context, "_lakejobs_shipped", False):
        return
    archive = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="code-")), "lakejobs_code.zip")
    top = os.path.dirname(PACKAGE)
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(PACKAGE):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, top))
    context.addPyFile(archive)
    context._lakejobs_shipped = True
