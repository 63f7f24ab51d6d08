"""The point in time a job runs for.

Jobs take ``as_of`` as text or as a column; without it they use the clock.  The
value takes the type of the column it is compared with, so the comparison needs
no cast on the data and reaches the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def moment(df: DataFrame, column: str, as_of: str | Column | None = None) -> Column:
    """``as_of`` as a timestamp of the same kind as ``df[column]``."""
    kind = df.schema[column].dataType
    target = "timestamp_ntz" if isinstance(kind, T.TimestampNTZType) else "timestamp"
    if as_of is None:
        return F.current_timestamp().cast(target)
    return (F.lit(as_of) if isinstance(as_of, str) else as_of).cast(target)


def day(as_of: str | Column | None = None) -> Column:
    if as_of is None:
        return F.current_date()
    return (F.lit(as_of) if isinstance(as_of, str) else as_of).cast("date")


def hours_before(moment_: Column, hours: int) -> Column:
    return moment_ - F.expr(f"INTERVAL {int(hours)} HOURS")


def seconds_between(start: str | Column, end: Column) -> Column:
    """Whole seconds from ``start`` to ``end``."""
    begin = F.col(start) if isinstance(start, str) else start
    return F.timestamp_diff("SECOND", begin, end)
