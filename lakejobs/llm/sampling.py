"""A bounded, repeatable sample of labelled rows for fitting on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


ROUNDS = (4096, 64)  # groups of a label in the rounds before the last


def first_by_hash(rows: DataFrame, label: str, key: str, per_label: int) -> DataFrame:
    """Up to ``per_label`` rows of each label, those with the smallest hash of the key; of equal
    keys, those with the smallest hash of the row. Rows equal in all columns count once.

    Only label, key and hash are ranked, and the rows chosen are fetched by them. Ranking is a
    tree: keys are dealt to groups by hash, and the first of each group go on to fewer groups,
    so neither a label that holds most rows nor the number of tasks that read makes a large
    group: the last round ranks 64 x ``per_label`` keys. Those chosen are broadcast, so rows
    do not move: ``per_label`` keys a label, less than the sample its caller collects."""
    hashed = rows.withColumn("_row", F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns]))
    keys = hashed.select(F.col(label).alias("_label"), F.col(key).alias("_key"), "_row").distinct()
    for groups in (*ROUNDS, 1):
        part = ["_label"] + ([F.pmod("_row", F.lit(groups))] if groups > 1 else [])
        order = Window.partitionBy(*part).orderBy(F.xxhash64("_key"), "_key", "_row")
        keys = keys.withColumn("_nth", F.row_number().over(order)).where(
            F.col("_nth") <= per_label).drop("_nth")
    chosen = hashed.join(
        F.broadcast(keys.withColumnRenamed("_row", "_chosen")),
        (F.col("_row") == F.col("_chosen")) & F.col(label).eqNullSafe(F.col("_label"))
        & F.col(key).eqNullSafe(F.col("_key")), "left_semi")
    return chosen.dropDuplicates([label, key, "_row"]).drop("_row")


def held_out(key: Column) -> Column:
    """The share of rows no label may be learnt from: CRC-32 of the key's text modulo 4 is 2.

    A null key is not held out."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))
