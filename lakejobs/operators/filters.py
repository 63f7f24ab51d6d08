"""Row filters.  A row stays only when its rule is true, not when it is unknown."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakejobs.functions import clock, text


def valid_sales(df: DataFrame) -> DataFrame:
    return df.filter((F.col("sale_amount") > 0) & F.col("customer_id").isNotNull())


def valid_products(df: DataFrame) -> DataFrame:
    return df.filter("product_id IS NOT NULL AND product_name IS NOT NULL AND price >= 0")


def with_valid_email(df: DataFrame, column: str = "email") -> DataFrame:
    return df.filter(text.is_email(column))


def with_contact(df: DataFrame) -> DataFrame:
    return df.filter("email IS NOT NULL OR phone IS NOT NULL")


def within_hours(
    df: DataFrame, ts_col: str, hours: int, as_of: str | Column | None = None
) -> DataFrame:
    """Rows later than ``hours`` before ``as_of``, and not after it."""
    now = clock.moment(df, ts_col, as_of)
    return df.filter((F.col(ts_col) > clock.hours_before(now, hours)) & (F.col(ts_col) <= now))


def on_day(df: DataFrame, ts_col: str, as_of: str | Column | None = None) -> DataFrame:
    """Rows of the calendar day of ``as_of``, as a range the scan can prune by."""
    now = clock.moment(df, ts_col, as_of)
    start = F.date_trunc("day", now).cast(df.schema[ts_col].dataType)
    return df.filter(
        (F.col(ts_col) >= start) & (F.col(ts_col) < start + F.expr("INTERVAL 1 DAY"))
    )


def mark_of(df: DataFrame, column: str) -> Column:
    """The largest value of a column as text, free of the session time zone."""
    top = F.max(column)
    if isinstance(df.schema[column].dataType, T.TimestampType):
        top = F.unix_micros(top)
    return top.cast("string")


def later_mark(a: str | None, b: str | None, kind: T.DataType) -> str | None:
    """The later of two marks of a column; text of dates and times is in the order of time."""
    if a is None or b is None:
        return a if b is None else b
    number = isinstance(kind, (T.TimestampType, T.NumericType))
    return max(a, b, key=Decimal if number else str)


def newer_than(df: DataFrame, column: str, mark: str | None) -> DataFrame:
    """Rows beyond a mark of :func:`mark_of`; all rows when there is none."""
    if mark is None:
        return df
    kind = df.schema[column].dataType
    if isinstance(kind, T.TimestampType):
        return df.filter(F.col(column) > F.timestamp_micros(F.lit(int(mark))))
    return df.filter(F.col(column) > F.lit(mark).cast(kind))


def incremental(
    source: DataFrame, target: DataFrame | None, src_ts: str, tgt_ts: str | None = None
) -> DataFrame:
    """Source rows newer than the newest row already in the target.

    Both sides must be the same clock (ingestion time).  One value is read from
    the target; the filter then reaches the source scan.
    """
    if target is None:
        return source
    mark = target.agg(mark_of(target, tgt_ts or src_ts)).first()[0]
    return newer_than(source, src_ts, mark)


# Buckets of a key filter, and the bits of each: 2 MB in all, whatever the number of keys.
_BUCKETS, _BITS = 512, 32768


def key_filter(df: DataFrame, keys: list[str]) -> DataFrame:
    """A Bloom filter of keys with one hash: (bucket, bits) of at most ``_BUCKETS`` rows.

    Its size is fixed; more keys make it let more through, never lose one."""
    spot = F.pmod(_key_hash(keys), F.lit(_BUCKETS * _BITS))
    return df.groupBy((spot / _BITS).cast("int").alias("bucket")).agg(
        F.bitmap_construct_agg(F.pmod(spot, F.lit(_BITS))).alias("bits"))


def perhaps_among(df: DataFrame, keys: list[str], known: DataFrame) -> DataFrame:
    """Rows with ``_perhaps``: false where the key is not among those of the filter ``known``."""
    spot = F.pmod(_key_hash(keys), F.lit(_BUCKETS * _BITS))
    marked = df.withColumn("_spot", spot).join(
        F.broadcast(known), (F.col("_spot") / _BITS).cast("int") == F.col("bucket"), "left")
    within = F.pmod("_spot", F.lit(_BITS))
    byte = F.conv(F.hex(F.substring("bits", (within / 8).cast("int") + 1, F.lit(1))), 16, 10)
    bit = F.getbit(byte.cast("long"), F.pmod(within, F.lit(8)).cast("int")) == 1
    return marked.withColumn("_perhaps", F.coalesce(bit, F.lit(False))).drop(
        "_spot", "bucket", "bits")


def _key_hash(keys: list[str]) -> Column:
    return F.xxhash64(*[F.col(k).cast("string") for k in keys])


@dataclass(frozen=True)
class Late:
    """Which rows behind the mark may still be new: those at most ``hours`` behind it, told from
    loaded ones by ``keys`` (column names of the source) and their time."""

    keys: tuple[str, ...]
    hours: int

    def rows(self, source: DataFrame, ts_col: str, mark: str, loaded: DataFrame | None) -> DataFrame:
        """Rows of the window behind the mark that are not among the loaded ones.

        A row with a NULL key cannot be told apart and is not taken again.  Most rows
        of the window were loaded, so those whose key the filter does not hold skip the anti
        join; the others are compared exactly."""
        from lakejobs.operators.projections import normalize_names

        kind = source.schema[ts_col].dataType
        end = F.timestamp_micros(F.lit(int(mark))) if isinstance(kind, T.TimestampType) \
            else F.lit(mark).cast(kind)
        begin = (end - F.expr(f"INTERVAL {int(self.hours)} HOUR")).cast(kind)
        behind = source.filter((F.col(ts_col) <= end) & (F.col(ts_col) > begin)).dropna(
            subset=list(self.keys))
        if loaded is None:
            return behind
        wanted = [*self.keys, ts_col]
        names = normalize_names(source.select(*wanted)).columns
        types = [source.schema[c].dataType for c in wanted]
        cells = [F.col(n).cast(t).alias(f"_k{i}") for i, (n, t) in enumerate(zip(names, types))]
        held = loaded.select(*cells)
        time = F.col(f"_k{len(self.keys)}")
        held = held.filter((time <= end) & (time > begin))
        at = [f"_k{i}" for i in range(len(wanted))]
        keyed = behind.select("*", *[F.col(f"`{c}`").alias(a) for c, a in zip(wanted, at)])
        marked = perhaps_among(keyed, at, key_filter(held, at))
        unsure = marked.filter("_perhaps").join(held, at, "left_anti")
        new = marked.filter("NOT _perhaps").unionByName(unsure)
        return new.select(*[F.col(f"`{c}`") for c in source.columns])
