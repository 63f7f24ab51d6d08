"""Sums and sets that can be added to: what a gold table is made of, kept between runs.

Counts, sums, least and greatest values merge by themselves. A distinct count does not, so the
distinct values of a group are kept as rows: merging is a union without repeats, and no
group's values meet in one task. (Bitmaps over dense ids take 4 kB for each group and range of
ids; here most groups hold a few values.)
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# How each measure of a partial result merges.
MERGES = {"n": F.sum, "amounts": F.sum, "total": F.sum, "low": F.min, "high": F.max,
          "first": F.min, "last": F.max}


def sums(sales: DataFrame, keys: list[str]) -> DataFrame:
    """Measures of the sales of each group."""
    return sales.groupBy(*keys).agg(
        F.count("sale_id").alias("n"), F.count("sale_amount").alias("amounts"),
        F.sum("sale_amount").alias("total"), F.min("sale_amount").alias("low"),
        F.max("sale_amount").alias("high"), F.min("sale_date").alias("first"),
        F.max("sale_date").alias("last"))


def merged_sums(parts: list[DataFrame], keys: list[str]) -> DataFrame:
    """One row per group of several partial results, with the types of the first."""
    kinds = {f.name: f.dataType for f in parts[0].schema.fields}
    every = reduce(DataFrame.unionByName, parts)
    if len(parts) == 1:
        return every
    return every.groupBy(*keys).agg(*[
        how(name).cast(kinds[name]).alias(name) for name, how in MERGES.items()])


def added_sums(sales: DataFrame, parts: list[DataFrame], keys: list[str]) -> DataFrame:
    """Sums of sales and of earlier partial results, for keys that hardly repeat.

    Each sale counts as a partial result of its own, so all rows are grouped in one shuffle;
    grouping the sales first would shuffle nearly as many rows once more."""
    summed = sums(sales, keys)
    if not parts:
        return summed
    one = {"n": F.col("sale_id").isNotNull(), "amounts": F.col("sale_amount").isNotNull(),
           "total": F.col("sale_amount"), "low": F.col("sale_amount"),
           "high": F.col("sale_amount"), "first": F.col("sale_date"), "last": F.col("sale_date")}
    kinds = {f.name: f.dataType for f in summed.schema.fields}
    each = sales.select(*keys, *[one[name].cast(kinds[name]).alias(name) for name in MERGES])
    return merged_sums([each, *parts], keys)


def values(sales: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """The values of some columns in each group, with repeats: (keys, column, value)."""
    cells = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
        for c in columns])
    return sales.select(*keys, F.inline(cells)).dropna(subset=["value"])


def merged_sets(parts: list[DataFrame]) -> DataFrame:
    """Each value of a group once; the parts may hold repeats, which leave in one shuffle."""
    return reduce(DataFrame.unionByName, parts).distinct()


def set_sizes(rows: DataFrame, keys: list[str], names: dict[str, str]) -> DataFrame:
    """How many distinct values each group has, one result column per set."""
    return rows.groupBy(*keys).agg(*[
        F.count_if(F.col("column") == column).alias(name) for column, name in names.items()])


def with_sizes(groups: DataFrame, sizes: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """Groups with their set sizes, NULL keys met by NULL, zero where a group has no values."""
    right = sizes.select(*[F.col(k).alias(f"_{k}") for k in keys], *names)
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    zero = {n: F.coalesce(n, F.lit(0).cast(T.LongType())) for n in names}
    return groups.join(right, same, "left").drop(*[f"_{k}" for k in keys]).withColumns(zero)
