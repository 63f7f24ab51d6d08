"""Silver entities of the star tables, as the queries use them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakejobs.operators import dedup, projections, quality
from lakejobs.plans.medallion import silver_sales as typed_sales
from lakejobs.registry.case import TYPE_SYNONYMS
from lakejobs.sources import star_tables as star

# A total order of the copies of one sale.
SALE_ORDER = ["product_id", "store_id", "quantity", "sale_amount"]
CUSTOMER_ORDER = ["registration_date", "email", "phone", "first_name", "last_name"]
PRODUCT_ORDER = ["product_name", "category", "price"]
HIGH_VALUE, MEDIUM_VALUE = 2_500_000, 1_500_000


def valid_sales(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """Sales that pass the quarantine rules, with silver types."""
    raw = star.sales_raw(spark, folder, *columns)
    valid, _ = quality.split_quarantine(raw, quality.SALES_REJECTS)
    return typed_sales(valid).drop("processed_timestamp", "record_status")


def silver_sales(spark: SparkSession, folder: str) -> DataFrame:
    """Clean, valid sales, one row per (sale, day).

    The parts of a sale id are never NULL here, so no row needs to bypass the
    deduplication and the joins behind it run once.
    """
    raw = star.sales_raw(
        spark, folder, "sale_id", "sale_date", "customer_id", "product_id", "sale_amount",
        "store_id", "quantity",
    )
    clean = quality.apply_expectations(projections.clean_sales(raw), quality.SALES_RULES)
    return dedup.dedup(clean, ["sale_id", "sale_date"], SALE_ORDER, keep_null_keys=False)


def silver_customers(spark: SparkSession, folder: str) -> DataFrame:
    clean = projections.clean_customers(star.customers_raw(spark, folder), star.SALES_AS_OF)
    valid = quality.apply_expectations(clean, quality.CUSTOMER_RULES)
    return dedup.dedup(valid, ["customer_id"], CUSTOMER_ORDER, keep_null_keys=False)


def silver_products(spark: SparkSession, folder: str) -> DataFrame:
    clean = projections.clean_products(star.products_raw(spark, folder), TYPE_SYNONYMS)
    valid = quality.apply_expectations(clean, quality.PRODUCT_RULES)
    return dedup.dedup(valid, ["product_id"], PRODUCT_ORDER, keep_null_keys=False)
