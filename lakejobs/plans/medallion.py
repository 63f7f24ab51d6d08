"""Batch flow: raw sales to bronze, silver, quarantine and three gold tables."""

from __future__ import annotations

from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakejobs.functions import text
from lakejobs.operators import gold, projections, quality, tables
from lakejobs.paths import LakePaths
from lakejobs.plans.together import together

GOLD_TABLES = {
    "by_segment": gold.by_segment,
    "by_region": gold.by_region,
    "monthly_trend": gold.monthly_trend,
}


def silver_sales(valid: DataFrame) -> DataFrame:
    """Types and audit columns of valid sales."""
    typed = valid.withColumns({
        "sale_amount": text.money("sale_amount", 12, 2),
        "sale_date": projections.as_date(valid, "sale_date"),
    })
    return projections.process_audit(typed, record_status="VALID").drop("_bad_reason")


def run(raw: DataFrame, lake: LakePaths, batch_id: str, source: str = "pos_system_v2") -> DataFrame:
    """Run the flow and return its one-row summary.

    Every table is written once and read back by the next step.  Row counts come
    from the writes, not from extra counting jobs.
    """
    spark = raw.sparkSession
    bronze = projections.ingest_audit(raw, batch_id, source, "bronze", source_file=False)
    bronze_rows = tables.write(bronze, lake.bronze("sales"))
    valid, rejected = quality.split_quarantine(
        tables.read(spark, lake.bronze("sales")), quality.SALES_REJECTS
    )
    rejected = rejected.withColumn("quarantine_timestamp", F.current_timestamp())
    silver_rows, quarantine_rows = together(
        lambda: tables.write(silver_sales(valid), lake.silver("sales")),
        lambda: tables.write(rejected, lake.quarantine("sales")),
    )
    silver = tables.read(spark, lake.silver("sales"))
    together(*[
        partial(tables.write, build(silver), lake.gold(name))
        for name, build in GOLD_TABLES.items()
    ])
    return summary(spark, lake, bronze_rows, silver_rows, quarantine_rows)


def summary(
    spark: SparkSession, lake: LakePaths, bronze_rows: int, silver_rows: int, quarantine_rows: int
) -> DataFrame:
    """Rows per layer, quality rate and the total of every gold table."""
    rate = round(silver_rows * 100 / bronze_rows, 1) if bronze_rows else None
    parts = [spark.createDataFrame(
        [(bronze_rows, silver_rows, quarantine_rows, rate)],
        "bronze_rows bigint, silver_rows bigint, quarantine_rows bigint, quality_rate double",
    )]
    for name, column in (
        ("by_segment", "total_revenue"), ("by_region", "total_revenue"),
        ("monthly_trend", "monthly_revenue"),
    ):
        table = tables.read(spark, lake.gold(name))
        parts.append(table.agg(F.sum(column).cast("double").alias(f"{name}_revenue")))
    # one-row frames become one row by union and max, without a join
    both = reduce(partial(DataFrame.unionByName, allowMissingColumns=True), parts)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])
