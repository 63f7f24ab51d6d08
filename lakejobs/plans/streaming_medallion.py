"""Streaming flow: three file sources to bronze and silver, then gold in batch.

Distinct counts are not possible on a stream, so gold is made in batch, from the new sales
and what earlier runs have summed up.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakejobs.operators import gold, projections, quality, tables
from lakejobs.paths import LakePaths
from lakejobs.plans import incremental_gold
from lakejobs.plans.together import together
from lakejobs.session import leanly
from lakejobs.streaming.ingest import (
    CORRUPT, RECORDS, drawn, ingest_stream, misfits, read_records, register_records, start_table,
)
from lakejobs.streaming.silver import last_epoch, read_silver, stream_silver

SOURCES = {"sales": "json", "customers": "csv", "products": "parquet"}


@leanly
def ingest(spark: SparkSession, landing: dict[str, str], lake: LakePaths, batch_id: str) -> dict:
    """Load the new files of every source into bronze; the sources run side by side.

    Returns the columns of each source.  JSON lines are kept whole in bronze, and their columns
    are looked up there once they have arrived, so none can be missed."""
    streams = {
        name: ingest_stream(spark, landing[name], fmt, lake.schema(name), batch_id)
        for name, fmt in SOURCES.items() if name in landing
    }
    running = [
        start_table(df, lake.bronze(name), lake.checkpoint(f"bronze_{name}"),
                    ["batch_id"] if SOURCES[name] == "json" else None)
        for name, df in streams.items()
    ]
    for query in running:
        query.awaitTermination()
    return {
        name: register_records(spark, lake.bronze(name), lake.schema(name))
        if SOURCES[name] == "json" else df.schema
        for name, df in streams.items()
    }


@leanly
def refine(
    spark: SparkSession, schemas: dict, lake: LakePaths,
    as_of: str | None = None, watermark: tuple[str, str] | None = None, env: str = "dev",
    sale_order: list[str] | None = None,
) -> None:
    """Clean, validate and deduplicate new bronze rows into silver.

    Outside production silver customers have masked addresses only.  Lines that do
    not fit the schema go to quarantine instead.  Of the copies of a sale, the first that
    arrived stays, and of those that arrive together, the first by ``sale_order``.
    """

    def customers(df: DataFrame) -> DataFrame:
        return projections.clean_customers(df, as_of)

    steps = {
        "sales": (projections.clean_sales, quality.SALES_RULES, ["sale_id", "sale_date"], True),
        "customers": (customers, quality.CUSTOMER_RULES, ["customer_id"], False),
        "products": (
            projections.clean_products, quality.PRODUCT_RULES, ["product_id"], False,
        ),
    }
    running = []
    for name in schemas:
        clean, rules, keys, keep = steps[name]
        records = SOURCES[name] == "json"
        bronze = landed = spark.readStream.schema(RECORDS if records else schemas[name]).parquet(
            lake.bronze(name))
        if records:
            bronze = drawn(landed, schemas[name])
        running.append(stream_silver(
            bronze, lake.silver(name), lake.checkpoint(f"silver_{name}"), clean, rules, keys,
            watermark if name == "sales" else None, keep,
            partial(projections.mask_email, env=env) if name == "customers" else None,
            sale_order if name == "sales" else None,
        ))
        if records:
            landed = misfits(spark, landed, lake.schema(name))
            running.append(start_table(
                drawn(landed, schemas[name]).filter(F.col(CORRUPT).isNotNull()),
                lake.quarantine(name), lake.checkpoint(f"quarantine_{name}"),
            ))
    for query in running:
        query.awaitTermination()


@leanly
def build_gold(
    spark: SparkSession, lake: LakePaths, as_of: str | None = None,
    high: float = 1000, medium: float = 500,
) -> None:
    """Bring the gold tables up to date: new sales are added to what earlier runs summed up."""
    sales_path = lake.silver("sales")
    until = last_epoch(spark, sales_path)
    customers = read_silver(spark, lake.silver("customers"))
    products = read_silver(spark, lake.silver("products"))
    if until is None:  # a table without epochs is read whole
        sales = read_silver(spark, sales_path)
        results = {
            "sales_analytics": gold.sales_analytics(sales, customers, products),
            "customer_360": gold.customer_360(sales, customers, high, medium),
            "product_performance": gold.product_performance(sales, products, as_of),
        }
    else:
        results = incremental_gold.refresh(
            spark, lake, lambda after: read_silver(spark, sales_path, after), until,
            customers, products, as_of, high, medium)
    together(*[
        partial(tables.write, projections.process_audit(df), lake.gold(name))
        for name, df in results.items()
    ])


def quality_table(spark: SparkSession, lake: LakePaths) -> DataFrame:
    """Rows, NULL share and status of one table per layer; ERROR for one that cannot be read."""

    def at(path: str):
        return lambda: spark.read.parquet(path)

    def bronze() -> DataFrame:
        return read_records(spark, lake.bronze("sales"), lake.schema("sales"))

    return quality.all_table_metrics(spark, [
        (bronze, "bronze_sales_raw", "bronze", None),
        (lambda: read_silver(spark, lake.silver("sales")), "silver_sales_cleaned", "silver", None),
        (at(lake.gold("sales_analytics")), "gold_sales_analytics", "gold", None),
    ])


def run(
    spark: SparkSession, landing: dict[str, str], lake: LakePaths, batch_id: str,
    env: str = "dev", as_of: str | None = None, high: float = 1000, medium: float = 500,
    watermark: tuple[str, str] | None = None, sale_order: list[str] | None = None,
) -> DataFrame:
    """Take in what has landed, refine it, bring gold up to date and measure quality."""
    schemas = ingest(spark, landing, lake, batch_id)
    refine(spark, schemas, lake, as_of, watermark, env, sale_order)
    build_gold(spark, lake, as_of, high, medium)
    return quality_table(spark, lake)
