"""Exact quantiles per group without gathering a group in one task.

Spark's exact ``percentile`` keeps every distinct value of a group in one
buffer.  Here a sketch first tells two values of the group between which a quantile must
lie: ``percentile_approx`` is off by at most ``1 / ACCURACY`` of the group's rows, and the two are
asked for ``MARGIN`` to both sides.  A second pass counts what lies below and puts only the values
in between in order, a few thousandths of a group.  Infinities are values like others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ACCURACY = 10_000
MARGIN = 8 / ACCURACY
# Groups of so many rows are put in order whole; beyond it, the sketch's error and the one rank to
# interpolate with are within the margin (1 / ACCURACY + 2 / SMALL < MARGIN).
SMALL = 5_000


def exact_quantiles(
    df: DataFrame, group: str, value: str, probs: tuple[float, ...],
) -> DataFrame:
    """Quantiles with linear interpolation: one row (g, q) per group, q an array like ``probs``.

    Rows without group or value, and NaN, are left out.  Groups may be as many as there are
    rows; nothing passes through the driver.
    """
    v = F.col(value).cast("double")
    base = df.filter(F.col(group).isNotNull() & F.col(value).isNotNull() & ~F.isnan(v)).select(
        F.col(group).cast("string").alias("g"), v.alias("v"))
    cuts = [c for p in probs for c in (max(p - MARGIN, 0.0), min(p + MARGIN, 1.0))]
    sketch = base.groupBy("g").agg(
        F.percentile_approx("v", cuts, ACCURACY).alias("edges"),
        F.count(F.lit(1)).alias("total"))
    sketch = sketch.withColumn("edges", F.when(F.col("total") > SMALL, F.col("edges")))

    def side(i: int):
        """A row's part in the i-th quantile: its value, NULL below, none above."""
        low = F.element_at("edges", 2 * i + 1) if probs[i] > MARGIN else F.lit(None)
        high = F.element_at("edges", 2 * i + 2) if probs[i] < 1 - MARGIN else F.lit(None)
        below = F.coalesce(F.col("v") < low, F.lit(False))
        return F.struct(
            F.lit(i).alias("i"), F.when(~below, F.col("v")).alias("v"),
            F.coalesce(F.col("v") <= high, F.lit(True)).alias("kept"))

    sides = F.filter(F.array(*[side(i) for i in range(len(probs))]), lambda x: x["kept"])
    counted = base.join(sketch, "g").select("g", "total", F.inline(sides)).groupBy(
        "g", "total", "i", "v").agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.partitionBy("g", "i").orderBy(F.asc_nulls_first("v")).rowsBetween(
        Window.unboundedPreceding, Window.currentRow))
    place = F.element_at(F.array(*[F.lit(float(p)) for p in probs]), F.col("i") + 1) * (
        F.col("total") - 1)
    rank = F.floor(place)
    ranked = counted.withColumns({"upto": upto, "rank": rank, "part": place - rank})

    def at(rank):
        return (F.col("upto") - F.col("n") <= rank) & (rank < F.col("upto"))

    after = F.least(F.col("rank") + 1, F.col("total") - 1)
    near = ranked.filter(at(F.col("rank")) | at(after))
    cells = []
    for i in range(len(probs)):
        own = F.col("i") == i
        cells += [F.max(F.when(own & at(F.col("rank")), F.col("v"))).alias(f"a{i}"),
                  F.max(F.when(own & at(after), F.col("v"))).alias(f"b{i}"),
                  F.max(F.when(own, F.col("part"))).alias(f"p{i}")]
    ends = near.groupBy("g").agg(*cells)

    def between(i: int):
        a, b, part = F.col(f"a{i}"), F.col(f"b{i}"), F.col(f"p{i}")
        missed = F.raise_error(F.lit("a quantile lies outside the range its sketch gave"))
        exact = F.when((a == b) | (part == 0), a).otherwise(a + (b - a) * part)
        return F.coalesce(exact, missed.cast("double"))

    return ends.select("g", F.array(*[between(i) for i in range(len(probs))]).alias("q"))
