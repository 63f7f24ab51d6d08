"""Cleaning, validation and deduplication of streams.

The cleaning functions are those of the batch jobs.  Rules run before the
deduplication, so an invalid copy cannot displace a valid one.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lakejobs.operators.dedup import dedup
from lakejobs.operators.projections import process_audit
from lakejobs.operators.quality import Expectation, apply_expectations
from lakejobs.operators.tables import exists, plain
from lakejobs.session import remove
from lakejobs.streaming.ingest import CORRUPT, start_table
from lakejobs.streaming.keys import EPOCH, KeyStore

ALONE = "_alone"


def cleaned(
    bronze: DataFrame,
    clean: Callable[[DataFrame], DataFrame],
    rules: tuple[Expectation, ...],
    finish: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Clean and valid rows; lines the reader could not fit are left to the quarantine."""
    if CORRUPT in bronze.columns:
        bronze = bronze.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
    valid = apply_expectations(process_audit(clean(bronze)), rules)
    return finish(valid) if finish is not None else valid  # behind the rules: they need raw values


def silver(
    bronze: DataFrame,
    clean: Callable[[DataFrame], DataFrame],
    rules: tuple[Expectation, ...],
    keys: list[str],
    watermark: tuple[str, str] | None = None,
    keep_null_keys: bool = True,
    finish: Callable[[DataFrame], DataFrame] | None = None,
    order_by: list[str | Column] | None = None,
) -> DataFrame:
    """Clean, validate and deduplicate; for batch input, and streams with a watermark.

    With ``(time column, delay)`` a key is forgotten after the delay, so copies
    further apart than that both stay.  A stream that must know the keys of all time goes
    through :func:`stream_silver`.
    """
    valid = cleaned(bronze, clean, rules, finish)
    if not bronze.isStreaming:
        return dedup(valid, keys, order_by, keep_null_keys)
    if watermark is None:
        raise ValueError("a stream without a watermark goes through stream_silver")
    column, delay = watermark
    marked = valid.withColumn(column, F.col(column).cast("timestamp")).withWatermark(column, delay)
    if not keep_null_keys:
        return marked.dropDuplicatesWithinWatermark(keys)
    # A key of its own for a row with a NULL: one read, and no such row is another's copy.
    unset = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    alone = marked.withColumn(ALONE, F.when(unset, F.uuid()))
    return alone.dropDuplicatesWithinWatermark([ALONE, *keys]).drop(ALONE)


def stream_silver(
    bronze: DataFrame,
    target: str,
    checkpoint: str,
    clean: Callable[[DataFrame], DataFrame],
    rules: tuple[Expectation, ...],
    keys: list[str],
    watermark: tuple[str, str] | None = None,
    keep_null_keys: bool = True,
    finish: Callable[[DataFrame], DataFrame] | None = None,
    order_by: list[str | Column] | None = None,
    seen: str | None = None,
) -> StreamingQuery:
    """Run the cleaning on a stream into a table, one copy of each key for all time.

    The copy of the earliest micro-batch stays, and within one the first by ``order_by``.  Keys
    lie in a store at ``seen`` (beside the checkpoint if unset).  A micro-batch writes a
    partition of its own and then its keys; one that runs again replaces the first and meets
    only the keys of earlier ones.  With a watermark, the stream's own state is used.
    """
    if watermark is not None:
        df = silver(bronze, clean, rules, keys, watermark, keep_null_keys, finish)
        return start_table(df, target, checkpoint)
    rows = cleaned(bronze, clean, rules, finish)
    fields = [T.StructField(k, rows.schema[k].dataType) for k in keys]
    store = seen or f"{checkpoint}_keys"

    def take(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        known = KeyStore(spark, store, fields)
        kinds = plain(rows.schema)
        new = dedup(batch, keys, order_by, keep_null_keys)
        part, staged = f"{target}/{EPOCH}={epoch}", f"{checkpoint}_staged"
        if known.knows(epoch):
            # Rows are dealt out by key and digest, then by the buckets of the store.  As files
            # in between they take a quarter of what they take as a second shuffle beside the first.
            new.write.mode("overwrite").parquet(staged)
            new = known.unseen(spark.read.schema(kinds).parquet(staged), epoch)
        new.write.mode("overwrite").parquet(part)
        remove(spark, [staged])
        known.add(spark.read.schema(kinds).parquet(part), epoch)

    return (
        rows.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def epochs(spark: SparkSession, path: str) -> list[int]:
    """The micro-batches that a silver table holds, by its folders."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
    mark = f"{EPOCH}="
    return sorted(int(n[len(mark):]) for n in names if n.startswith(mark))


def read_silver(spark: SparkSession, path: str, after: int | None = None) -> DataFrame:
    """A table written by :func:`stream_silver`; ``after`` an epoch, its later rows alone.

    Columns only grow, so those of the newest micro-batch are those of the table, and no other
    footer is read."""
    for newest in reversed(epochs(spark, path)):
        part = f"{path}/{EPOCH}={newest}"
        if exists(spark, part):
            kinds = plain(spark.read.parquet(part).schema).add(EPOCH, T.LongType())
            df = spark.read.schema(kinds).parquet(path)
            return (df if after is None else df.filter(F.col(EPOCH) > after)).drop(EPOCH)
    return spark.read.parquet(path)


def last_epoch(spark: SparkSession, path: str) -> int | None:
    return max(epochs(spark, path), default=None)
