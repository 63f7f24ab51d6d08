"""Show what a correction changed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakejobs.operators import tables


def run(
    before: DataFrame, after: DataFrame, keys: list[str], column: str,
    show: list[str] | None = None,
) -> DataFrame:
    """The rows whose ``column`` changed between two states of a table: was and now."""
    changes = tables.diff(before, after, keys)
    was = changes.filter("change_type = 'update_pre'").select(
        *keys, F.col(column).alias("was"), *(show or [])
    )
    now = changes.filter("change_type = 'update_post'").select(*keys, F.col(column).alias("now"))
    return was.join(now, keys).filter(~F.col("was").eqNullSafe(F.col("now")))


def counts_by(df: DataFrame, column: str) -> DataFrame:
    """Rows per value of a column, fewest first."""
    return df.groupBy(column).count().orderBy("count")
