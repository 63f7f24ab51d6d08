"""Business aggregates.

Distinct counts are aggregated per (group, value) before the final grouping, so
a group that holds a third of the sales is reduced on many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakejobs.functions import classes, clock
from lakejobs.operators.joins import enrich_sales


def by_segment(sales: DataFrame) -> DataFrame:
    """Revenue, order value and customers per customer segment, largest first."""
    return (
        sales.groupBy("customer_segment")
        .agg(
            F.round(F.sum("sale_amount"), 2).alias("total_revenue"),
            F.round(F.avg("sale_amount"), 2).alias("avg_order_value"),
            F.count("sale_id").alias("total_orders"),
            F.countDistinct("customer_id").alias("unique_customers"),
        )
        .withColumn(
            "revenue_per_customer",
            F.round(F.try_divide(F.col("total_revenue"), F.col("unique_customers")), 2),
        )
        .orderBy(F.desc("total_revenue"))
    )


def by_region(sales: DataFrame) -> DataFrame:
    return (
        sales.groupBy("region")
        .agg(
            F.round(F.sum("sale_amount"), 2).alias("total_revenue"),
            F.count("sale_id").alias("total_orders"),
            F.countDistinct("customer_id").alias("unique_customers"),
            F.round(F.avg("sale_amount"), 2).alias("avg_order_value"),
        )
        .orderBy(F.desc("total_revenue"))
    )


def monthly_trend(sales: DataFrame) -> DataFrame:
    return (
        sales.groupBy(F.date_format("sale_date", "yyyy-MM").alias("month"))
        .agg(
            F.round(F.sum("sale_amount"), 2).alias("monthly_revenue"),
            F.count("sale_id").alias("orders"),
            F.countDistinct("customer_id").alias("unique_customers"),
        )
        .orderBy("month")
    )


def daily_store(sales: DataFrame, store: str = "store_id", sale: str = "sale_id") -> DataFrame:
    return sales.groupBy("sale_date", store).agg(
        F.count(sale).alias("transaction_count"),
        F.sum("sale_amount").alias("total_sales"),
        classes.ratio(F.sum("sale_amount"), F.count("sale_amount")).alias("avg_transaction_value"),
        F.countDistinct("customer_id").alias("unique_customers"),
    )


def sales_analytics(sales: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Sales by day, standard category and customer segment.

    ``sales`` keeps only the columns the result needs before the joins.
    """
    facts = sales.select("sale_id", "sale_date", "customer_id", "product_id", "sale_amount")
    return (
        enrich_sales(facts, customers, products)
        .groupBy("sale_date", "category_standardized", "customer_segment")
        .agg(
            F.count("sale_id").alias("transaction_count"),
            F.sum("sale_amount").alias("total_sales"),
            classes.ratio(F.sum("sale_amount"), F.count("sale_amount"))
            .alias("avg_transaction_value"),
            F.min("sale_amount").alias("min_transaction_value"),
            F.max("sale_amount").alias("max_transaction_value"),
            F.countDistinct("customer_id").alias("unique_customers"),
            F.countDistinct("product_id").alias("unique_products"),
        )
        .transform(with_analytics_ratios)
    )


def with_analytics_ratios(groups: DataFrame) -> DataFrame:
    return groups.withColumns({
        "sales_per_customer": classes.ratio("total_sales", "unique_customers"),
        "products_per_transaction": classes.ratio("unique_products", "transaction_count"),
    })


def customer_360(
    sales: DataFrame, customers: DataFrame, high: float = 1000, medium: float = 500
) -> DataFrame:
    """Every customer with purchase totals, tenure, frequency and value segment."""
    metrics = (
        sales.groupBy("customer_id")
        .agg(
            F.count("sale_id").alias("total_transactions"),
            F.sum("sale_amount").alias("lifetime_value"),
            classes.ratio(F.sum("sale_amount"), F.count("sale_amount")).alias("avg_order_value"),
            F.min("sale_date").alias("first_purchase_date"),
            F.max("sale_date").alias("last_purchase_date"),
            F.countDistinct("product_id").alias("unique_products_purchased"),
        )
    )
    return with_purchases(customers, metrics, high, medium)


def with_purchases(
    customers: DataFrame, metrics: DataFrame, high: float = 1000, medium: float = 500
) -> DataFrame:
    """Every customer with the totals of those that bought, tenure, frequency and segment."""
    metrics = metrics.withColumn(
        "customer_tenure_days", F.datediff("last_purchase_date", "first_purchase_date")
    ).withColumn(
        "purchase_frequency",
        classes.ratio("total_transactions", F.col("customer_tenure_days") + 1),
    )
    return customers.join(metrics, "customer_id", "left").withColumn(
        "customer_value_segment", classes.value_segment("lifetime_value", high, medium)
    )


def product_performance(
    sales: DataFrame,
    products: DataFrame,
    as_of: str | Column | None = None,
    w_rev: float = 0.6,
    w_cust: float = 0.4,
) -> DataFrame:
    """Every product with sales totals, performance score and recency status."""
    metrics = (
        sales.groupBy("product_id")
        .agg(
            F.count("sale_id").alias("total_sales_count"),
            F.sum("sale_amount").alias("total_revenue"),
            classes.ratio(F.sum("sale_amount"), F.count("sale_amount")).alias("avg_sale_price"),
            F.countDistinct("customer_id").alias("unique_customers"),
            F.min("sale_date").alias("first_sale_date"),
            F.max("sale_date").alias("last_sale_date"),
        )
    )
    return with_performance(products, metrics, as_of, w_rev, w_cust)


def with_performance(
    products: DataFrame, metrics: DataFrame, as_of: str | Column | None = None,
    w_rev: float = 0.6, w_cust: float = 0.4,
) -> DataFrame:
    """Every product with the totals of those sold, score and recency status."""
    metrics = metrics.withColumn(
        "revenue_per_customer", classes.ratio("total_revenue", "unique_customers"))
    return products.join(metrics, "product_id", "left").withColumns({
        "performance_score": classes.performance_score(
            "total_revenue", "unique_customers", w_rev, w_cust
        ),
        "product_status": classes.recency_status("last_sale_date", clock.day(as_of)),
    })


def processing_summary(
    df: DataFrame, table_name: str, batch_id: str, ts_col: str = "processed_timestamp",
    as_of: str | Column | None = None,
) -> DataFrame:
    """Rows, newest processing time and batches of the day of ``as_of``."""
    from lakejobs.operators.filters import on_day

    return on_day(df, ts_col, as_of).agg(
        F.lit(table_name).alias("table_name"),
        F.lit(batch_id).alias("batch_id"),
        F.count(F.lit(1)).alias("record_count"),
        F.max(ts_col).alias("last_processed"),
        F.countDistinct("batch_id").alias("batch_count"),
    )
