"""Deduplication on a business key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _any_null(keys: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def first_per_key(
    df: DataFrame, keys: list[str], order_by: list[str | Column] | None = None
) -> DataFrame:
    """The first row of each key in the given order, or any row without one.

    Spark cuts every key to one row per task before the shuffle (window group
    limit), so a key that holds a third of all rows still sends few rows.  Rows
    are grouped by a hash of the key first: business keys share long prefixes,
    and a number in front makes the sorts about twice as fast.
    """
    hashed = df.withColumn("_hash", F.xxhash64(*keys))
    window = Window.partitionBy("_hash", *keys).orderBy(*(order_by or ["_hash"]))
    first = hashed.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1")
    return first.drop("_rank", "_hash")


def dedup(
    df: DataFrame,
    keys: list[str],
    order_by: list[str | Column] | None = None,
    keep_null_keys: bool = True,
) -> DataFrame:
    """One row per key of a batch: any row, or the first by ``order_by``.

    Rows with a NULL in the key are not the same entity, so they all stay, and the input is
    read once.  Such a row goes where its digest (two 64-bit hashes of all columns) says, so a
    map task that runs again, with its rows in another order, sends it to the same place; the
    copies of one row share the first rank there, and all stay.  Among rows with a key, ties are
    broken at random, which decides between them but not where they go.
    ``keep_null_keys=False`` is for keys already known to be set.
    """
    if not keep_null_keys:
        return first_per_key(df, keys, order_by)
    unset = _any_null(keys)
    cells = [row_cell(f) for f in df.schema.fields]
    tagged = df.withColumns({
        "_digest": F.when(unset, F.xxhash64(*cells)),
        "_second": F.when(unset, F.xxhash64(F.lit(1), *cells)),
        "_tie": F.when(~unset, F.rand(1)), "_tie2": F.when(~unset, F.rand(2)),
    }).withColumn("_hash", F.coalesce("_digest", F.xxhash64(*keys)))
    window = Window.partitionBy("_hash", "_digest", "_second", *keys).orderBy(
        *(order_by or []), "_tie", "_tie2")
    first = tagged.withColumn("_rank", F.rank().over(window)).filter("_rank = 1")
    return first.drop("_digest", "_second", "_tie", "_tie2", "_hash", "_rank")


def row_cell(field: T.StructField) -> Column:
    """A column as the row digest takes it: NULL told from values, maps and variants as text."""
    cell = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.MapType, T.VariantType, T.StructType, T.ArrayType)):
        cell = F.to_json(F.struct(cell), {"ignoreNullFields": "false"})
    return F.coalesce(cell.cast("string"), F.lit("\u0000"))
