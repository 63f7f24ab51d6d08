"""Reproducible synthetic sales, generated on the executors.

Every choice is read from an MD5 digest of (row id, seed).  A row therefore
does not depend on how rows are spread over tasks, and a lost task can be
computed again with the same result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Domain lists, weights and price ranges of the sample data.
SEGMENTS = ("Premium", "Standard", "Budget")
SEGMENT_WEIGHTS = (0.20, 0.50, 0.30)
SEGMENT_MULTIPLIER = {"Premium": 1.8, "Standard": 1.0, "Budget": 0.6}
REGIONS = ("Metro Manila", "Cebu", "Davao", "Clark", "Iloilo")
PAYMENT_METHODS = ("Credit Card", "GCash", "Cash", "Bank Transfer")
CATEGORY_PRICES = {
    "Electronics": (3000, 80000),
    "Apparel": (500, 8000),
    "Food & Bev": (150, 2000),
    "Sports": (800, 25000),
    "Home & Living": (400, 15000),
}
SOURCE_SYSTEM = "pos_system_v2"


def _draws(row_id: Column, seed: int) -> dict[str, Column]:
    """Independent whole numbers, 16 bits each (32 bits for the amounts)."""
    digest = F.md5(F.concat_ws(":", row_id.cast("string"), F.lit(str(seed))))
    names = ("segment", "category", "day", "customer", "product", "quantity", "store", "region")
    second = F.md5(F.concat_ws(":", row_id.cast("string"), F.lit(str(seed)), F.lit("b")))
    draws = {
        name: F.conv(F.substring(digest, 1 + 4 * i, 4), 16, 10).cast("long")
        for i, name in enumerate(names)
    }
    draws["amount"] = F.conv(F.substring(second, 1, 8), 16, 10).cast("long")
    draws["payment"] = F.conv(F.substring(second, 9, 4), 16, 10).cast("long")
    draws["bad_amount"] = F.conv(F.substring(second, 13, 8), 16, 10).cast("long")
    return draws


def _pick(values: tuple[str, ...], draw: Column) -> Column:
    options = F.array(*[F.lit(v) for v in values])
    return F.element_at(options, (draw % len(values) + 1).cast("int"))


def _by_name(table: dict[str, float], name: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), name)


def good_sales(ids: DataFrame, seed: int, start: str, end: str) -> DataFrame:
    """One valid sale per row of ``ids`` (a single long column ``id``)."""
    draws = _draws(F.col("id"), seed)
    low, mid = (int(65536 * sum(SEGMENT_WEIGHTS[: i + 1])) for i in range(2))
    segment = (
        F.when(draws["segment"] < low, SEGMENTS[0])
        .when(draws["segment"] < mid, SEGMENTS[1])
        .otherwise(SEGMENTS[2])
    )
    days = F.datediff(F.lit(end).cast("date"), F.lit(start).cast("date")) + 1
    lows = {c: float(lo) for c, (lo, _) in CATEGORY_PRICES.items()}
    spans = {c: float(hi - lo) for c, (lo, hi) in CATEGORY_PRICES.items()}
    staged = ids.select(
        "id",
        segment.alias("customer_segment"),
        _pick(tuple(CATEGORY_PRICES), draws["category"]).alias("product_category"),
        F.date_add(F.lit(start).cast("date"), (draws["day"] % days).cast("int")).alias("sale_date"),
        *[draws[n].alias(f"_{n}") for n in
          ("customer", "product", "quantity", "store", "region", "payment", "amount",
           "bad_amount")],
    )
    price = (
        _by_name(lows, F.col("product_category"))
        + _by_name(spans, F.col("product_category")) * (F.col("_amount") / 4294967296.0)
    ) * _by_name(SEGMENT_MULTIPLIER, F.col("customer_segment"))
    return staged.select(
        "id",
        F.concat(F.lit("SALE-"), 100000 + F.col("id")).alias("sale_id"),
        "sale_date",
        F.concat(F.lit("CUST-"), 1000 + F.col("_customer") % 9000).alias("customer_id"),
        "customer_segment",
        F.format_string("PROD-%04d", F.col("_product") % 200 + 1).alias("product_id"),
        "product_category",
        (F.floor(price * 100) / 100.0).alias("sale_amount"),
        (F.col("_quantity") % 5 + 1).cast("int").alias("quantity"),
        F.format_string("STR-%03d", F.col("_store") % 20 + 1).alias("store_id"),
        _pick(REGIONS, F.col("_region")).alias("region"),
        _pick(PAYMENT_METHODS, F.col("_payment")).alias("payment_method"),
        F.lit(SOURCE_SYSTEM).alias("ingestion_source"),
        F.lit(None).cast("string").alias("_bad_reason"),
        (-(F.col("_bad_amount") % 500000 + 1) / 100.0).alias("_negative"),
    )


def bad_copies(good: DataFrame) -> DataFrame:
    """Copies under a new id: even ids get a negative amount, odd ids lose the customer."""
    even = F.col("id") % 2 == 0
    return good.withColumns({
        "sale_id": F.format_string("BAD-%04d", F.col("id")),
        "sale_amount": F.when(even, F.col("_negative")).otherwise(F.col("sale_amount")),
        "customer_id": F.when(even, F.col("customer_id")),
        "_bad_reason": F.when(even, "negative_sale_amount").otherwise("null_customer_id"),
    })


def synth_sales(
    spark: SparkSession,
    n_good: int = 500,
    n_bad: int = 25,
    seed: int = 42,
    start: str = "2025-01-01",
    end: str = "2025-05-31",
) -> DataFrame:
    """``n_good`` valid sales and ``n_bad`` broken copies of the first of them."""
    good = good_sales(spark.range(n_good).toDF("id"), seed, start, end)
    bad = bad_copies(good_sales(spark.range(n_bad).toDF("id"), seed, start, end))
    return good.unionByName(bad).drop("id", "_negative")


def write_batches(df: DataFrame, path: str, batches: int = 3) -> None:
    """Write CSV files with headers, as batches landing over time."""
    df.repartition(batches).write.mode("overwrite").option("header", True).csv(path)
