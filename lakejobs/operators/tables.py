"""Tables as Parquet folders, written and read by Spark's own writers.

Changes are operators from frame to frame; a changed table is written to a folder of
its own, so nothing is read and overwritten at once.  A table that grows by loads is
partitioned by the load, which gives a rerun its own rows to replace and a read up to
a load whole folders to skip.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakejobs.session import path_exists


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a table with at least one file lies at a path."""
    if not path_exists(spark, path):
        return False
    try:
        spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            return False
        raise
    return True


def plain(schema: T.StructType) -> T.StructType:
    """Names and types of a schema, every column nullable."""
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])


def read(spark: SparkSession, path: str, loads: str | None = None) -> DataFrame:
    """A table with the columns of all its files; those a file lacks read as NULL.

    ``loads`` names a partition column whose values are to stay text as written.
    """
    merged = spark.read.option("mergeSchema", True).parquet(path)
    if loads is None:
        return merged
    kinds = [T.StructField(f.name, T.StringType() if f.name == loads else f.dataType)
             for f in merged.schema.fields]
    return spark.read.schema(T.StructType(kinds)).parquet(path)


def write(
    df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None,
    even_files: bool = False, spread: bool = True,
) -> int:
    """Write a frame and return its number of rows, counted in the same pass.

    ``overwrite`` replaces the table, ``append`` adds files, and ``replace`` exchanges
    only the partitions the frame has rows for.  Rows of a partitioned table are
    rebalanced by partition value, which joins small partitions and splits a value too
    large for one task; ``spread=False`` leaves them as they lie, for a frame with one
    partition value.  Other tables are written as their tasks come, without a shuffle;
    ``even_files`` pays for one to get files of even size, for input that arrives in very
    uneven pieces; their number follows the cores of the session, see :func:`compact`.
    """
    if mode not in ("overwrite", "append", "replace"):
        raise ValueError(f"unknown mode {mode}")
    partitions = list(partition_by or [])
    moved = spread and partitions or even_files
    laid = df.hint("rebalance", *partitions) if moved else df
    # Counted behind the last shuffle: a map task that runs again is not counted twice.
    seen = Observation(f"rows-{uuid.uuid4().hex}")
    writer = laid.observe(seen, F.count(F.lit(1)).alias("rows")).write
    writer = writer.mode("append" if mode == "append" else "overwrite").option(
        "partitionOverwriteMode", "dynamic" if mode == "replace" else "static")
    (writer.partitionBy(*partitions) if partitions else writer).parquet(path)
    return int(seen.get.get("rows") or 0)


def compact(df: DataFrame, path: str, file_bytes: int = 128 << 20) -> int:
    """Write the rows of a table into even files of about ``file_bytes`` each.

    Their number comes from the bytes of the files that the frame is read from.  Adaptive
    execution would leave a file for each core instead."""
    files = df.select("_metadata.file_path", "_metadata.file_size").distinct()
    total = files.agg(F.sum("file_size")).first()[0] or 0
    return write(df.repartition(max(1, -(-total // file_bytes))), path)


def append(
    df: DataFrame, path: str, merge_schema: bool = True, partition_by: list[str] | None = None,
    known: T.StructType | None = None,
) -> int:
    """Add rows to a table that may be missing yet; known columns get its types.

    A caller that keeps the table's columns gives them as ``known``; without it the footers of
    all files are read."""
    if known is None and exists(df.sparkSession, path):
        known = read(df.sparkSession, path).schema
    if known is not None:
        df = typed(df, known)
        merged_schema(known, df.schema, merge_schema)
    return write(df, path, "append", partition_by)


def merged_schema(
    table: T.StructType, new: T.StructType, merge_schema: bool = True
) -> T.StructType:
    """Table columns, then new ones; a column may not change its type."""
    for f in new.fields:
        if f.name in table.names and table[f.name].dataType != f.dataType:
            raise ValueError(f"column {f.name} is {table[f.name].dataType.simpleString()}, "
                             f"not {f.dataType.simpleString()}")
    if not merge_schema and set(table.names) != set(new.names):
        raise ValueError("columns differ from the table: "
                         f"{sorted(set(table.names) ^ set(new.names))}")
    return T.StructType(table.fields + [f for f in new.fields if f.name not in table.names])


def typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast the columns that ``schema`` knows to its types."""
    return df.select(*[
        F.col(c).cast(schema[c].dataType).alias(c) if c in schema.names else F.col(c)
        for c in df.columns
    ])


def append_named(df: DataFrame, name: str, path: str | None = None) -> None:
    """Append to a table of the session catalog; ``path`` is its place, else the warehouse."""
    writer = df.write.mode("append").format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(name)


def few_rows(spark: SparkSession, rows: list[dict], schema: T.StructType) -> DataFrame:
    """A few rows of logs from the driver, as literals of a plan: no Python task builds them."""

    def cell(value: object, kind: T.DataType) -> Column:
        if isinstance(value, dict):
            value = F.create_map(*[F.lit(x) for pair in value.items() for x in pair])
        elif isinstance(value, (list, tuple)):
            value = F.array(*[F.lit(x) for x in value])
        return (value if isinstance(value, Column) else F.lit(value)).cast(kind)

    made = [F.struct(*[cell(r.get(f.name), f.dataType).alias(f.name) for f in schema.fields])
            for r in rows]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*made)))


# -- loads and files -------------------------------------------------------


def up_to(df: DataFrame, load: str, last: object) -> DataFrame:
    """The rows of all loads up to one; later folders are not read."""
    return df.filter(F.col(load) <= F.lit(last))


def load_sizes(df: DataFrame, load: str) -> DataFrame:
    """Rows a table holds after each load: (load, num_rows_written, num_rows).

    Rows are counted per load first, so the running total passes one row per load."""
    counts = df.groupBy(load).agg(F.count(F.lit(1)).alias("num_rows_written"))
    running = Window.orderBy(load).rowsBetween(Window.unboundedPreceding, 0)
    return counts.withColumn("num_rows", F.sum("num_rows_written").over(running))


def file_sizes(df: DataFrame) -> DataFrame:
    """Files, bytes and rows of the files a frame is read from, in one row."""
    files = df.select("_metadata.file_path", "_metadata.file_size").groupBy("file_path").agg(
        F.max("file_size").alias("bytes"), F.count(F.lit(1)).alias("n"))
    return files.agg(
        F.count(F.lit(1)).alias("num_files"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("size_bytes"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("num_rows"),
    )


# -- changes ---------------------------------------------------------------


def update(df: DataFrame, condition: Column, assignments: dict[str, Column]) -> DataFrame:
    """Set columns on the rows for which the condition is true, not unknown."""
    hit = F.coalesce(condition, F.lit(False))
    return df.select(*[
        F.when(hit, assignments[f.name].cast(f.dataType)).otherwise(F.col(f.name)).alias(f.name)
        if f.name in assignments else F.col(f.name)
        for f in df.schema.fields
    ])


def require_unique(df: DataFrame, keys: list[str]) -> None:
    """Fail when two rows share a key (NULL keys match nothing and are let through)."""
    known = df.dropna(subset=keys)
    twice = known.groupBy(*keys).count().filter("count > 1").limit(1).collect()
    if twice:
        raise ValueError(f"two updates for one key: {twice[0].asDict()}")


def upsert(target: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``target`` with matching updates laid over them, plus unmatched updates.

    The target keeps its place in the left join, so small updates are broadcast
    and the target is not shuffled.  Columns the updates lack keep their value, and
    those the target lacks are added.  A row with a NULL in its key matches nothing.
    Keys of the updates must be unique; see :func:`require_unique`.
    """
    updates = typed(updates, target.schema)
    new = [c for c in updates.columns if c not in target.columns]
    laid = [c for c in updates.columns if c not in keys]
    hits = updates.select(*keys, F.struct(*laid).alias("_new"), F.lit(True).alias("_hit"))
    joined = target.join(hits, keys, "left")
    old = [
        F.when(F.col("_hit"), F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c)
        if c in laid else F.col(c)
        for c in target.columns
    ]
    changed = joined.select(*old, *[F.col(f"_new.{c}").alias(c) for c in new])
    inserted = updates.join(target.select(*keys), keys, "left_anti")
    return changed.unionByName(inserted, allowMissingColumns=True)


# -- change feed -----------------------------------------------------------


def diff(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Changes between two frames with a unique key.

    Rows carry ``change_type``: insert, delete, update_pre or update_post.  In
    other columns NULL is compared as a value, so a change from or to NULL is
    found.  A row with a NULL in its key has no counterpart: it is a delete on
    the old side and an insert on the new one, one change each.
    """
    columns = list(dict.fromkeys([*old.columns, *new.columns]))

    def side(df: DataFrame, name: str) -> DataFrame:
        cells = [F.col(c) if c in df.columns else F.lit(None).alias(c) for c in columns]
        return df.select(
            *[F.col(k).alias(f"{name}_{i}") for i, k in enumerate(keys)],
            F.struct(*cells).alias(name),
        )

    same_key = reduce(
        lambda a, b: a & b,
        [F.col(f"o_{i}") == F.col(f"n_{i}") for i in range(len(keys))],
    )
    pairs = side(old, "o").join(side(new, "n"), same_key, "full_outer")
    kind = (
        F.when(F.col("o").isNull(), F.array(F.lit("insert")))
        .when(F.col("n").isNull(), F.array(F.lit("delete")))
        .when(~F.col("o").eqNullSafe(F.col("n")),
              F.array(F.lit("update_pre"), F.lit("update_post")))
    )
    return (
        pairs.withColumn("change_type", F.explode(kind))
        .withColumn(
            "_row",
            F.when(F.col("change_type").isin("delete", "update_pre"), F.col("o"))
            .otherwise(F.col("n")),
        )
        .select("change_type", "_row.*")
    )


# Buckets of keys whose checksums are compared, so many rows at most on either side.
DIFF_BUCKETS = 4096
_UNSET = -1


def _sealed(df: DataFrame, keys: list[str], columns: list[str], buckets: int) -> DataFrame:
    """(_bucket, rows, sums): per key bucket, a checksum that no order of rows changes.

    Two sums of 64-bit row hashes, NULL told from values and a column from its neighbours."""
    cells = []
    for name in columns:
        cell = F.col(f"`{name}`") if name in df.columns else F.lit(None)
        kind = df.schema[name].dataType if name in df.columns else T.NullType()
        if isinstance(kind, (T.MapType, T.StructType, T.ArrayType, T.VariantType)):
            cell = F.to_json(F.struct(cell), {"ignoreNullFields": "false"})
        cells += [cell.isNull(), cell]
    sums = [F.sum(F.xxhash64(F.lit(seed), *cells).cast("decimal(38,0)")).alias(f"sum{seed}")
            for seed in (0, 1)]
    return df.groupBy(_key_bucket(keys, buckets).alias("_bucket")).agg(
        F.count(F.lit(1)).alias("rows"), *sums)


def _key_bucket(keys: list[str], buckets: int) -> Column:
    """The bucket of a key; rows with a NULL in it, which have no counterpart, are in one."""
    unset = reduce(lambda a, b: a | b, [F.col(f"`{k}`").isNull() for k in keys])
    bucket = F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(buckets))
    return F.when(unset, F.lit(_UNSET).cast("long")).otherwise(bucket)


def diff_by_buckets(
    old: DataFrame, new: DataFrame, keys: list[str], buckets: int = DIFF_BUCKETS
) -> DataFrame:
    """The result of :func:`diff`, for large tables that differ in few places.

    Keys are dealt to buckets, and one pass over each side sums up every bucket; only rows of
    buckets that differ are shuffled and joined.  The list of those is at most ``buckets``
    numbers, so it is broadcast.  Key columns must have one type on both sides."""
    columns = list(dict.fromkeys([*old.columns, *new.columns]))
    seals = [_sealed(df, keys, columns, buckets) for df in (old, new)]
    marks = [c for c in seals[0].columns if c != "_bucket"]
    right = seals[1].select(F.col("_bucket").alias("_other"),
                            F.struct(*marks).alias("_there"))
    both = seals[0].select("_bucket", F.struct(*marks).alias("_here")).join(
        right, F.col("_bucket") == F.col("_other"), "full_outer")
    changed = both.withColumn("_changed", F.coalesce("_bucket", "_other")).filter(
        ~F.col("_here").eqNullSafe(F.col("_there")) | (F.col("_changed") == _UNSET)
    ).select("_changed")
    hits = F.broadcast(changed)

    def narrowed(df: DataFrame) -> DataFrame:
        return df.join(hits, _key_bucket(keys, buckets) == F.col("_changed"), "left_semi")

    return diff(narrowed(old), narrowed(new), keys)


# -- co-located joins --------------------------------------------------------


def write_bucketed(df: DataFrame, name: str, path: str, keys: list[str], buckets: int) -> DataFrame:
    """Write a table of the session catalog bucketed and sorted by keys, and read it.

    Tables bucketed alike join on their keys without a shuffle of either.  Rows are dealt out
    first, so that a bucket is one file."""
    df.repartition(buckets, *keys).write.mode("overwrite").format("parquet").bucketBy(
        buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)
