"""Connected components by alternating stars, without any vertex's neighbours in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakejobs.session import fresh_dir


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read again: a cut of the lineage."""
    path = fresh_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _stars(edges: DataFrame) -> DataFrame:
    """One large star and one small star step over edges (u, v)."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    large = both.join(least, "u").where("v > u").select(
        F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    # Every edge of the small star points down: the smallest smaller neighbour takes the others.
    least = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(least, "u").select(
        F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"),
        F.col("m").alias("v"))
    return small.where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that has an edge to another; root is the smallest node of its
    component. ``edges`` has long columns u and v; loops and repeated edges are ignored."""
    down = edges.where("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    now, before = stored(down, "edges"), None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before or mark[0] == 0:
            break
        before, now = mark, stored(_stars(now), "edges")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
