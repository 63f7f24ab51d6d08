"""Queries: business aggregates."""

from __future__ import annotations

from lakejobs.operators import gold, quality
from lakejobs.registry import entities
from lakejobs.registry.case import case
from lakejobs.sources import star_tables as star

# Decimal columns reach the comparison as doubles (see case.flat).


@case("gold_by_segment", """
    SELECT customer_segment, CAST(sum(sale_amount) AS DOUBLE) AS total_revenue,
           round(CAST(sum(sale_amount) AS DOUBLE) / count(*), 2) AS avg_order_value,
           count(sale_id) AS total_orders, count(DISTINCT customer_id) AS unique_customers,
           round(CAST(sum(sale_amount) AS DOUBLE) / count(DISTINCT customer_id), 2)
             AS revenue_per_customer
    FROM valid_sales GROUP BY 1""", "valid_sales")
def _(spark, d):
    return gold.by_segment(entities.valid_sales(
        spark, d, "sale_id", "sale_date", "customer_id", "customer_segment", "sale_amount"
    ))


@case("gold_by_region", """
    SELECT region, CAST(sum(sale_amount) AS DOUBLE) AS total_revenue,
           count(sale_id) AS total_orders, count(DISTINCT customer_id) AS unique_customers,
           round(CAST(sum(sale_amount) AS DOUBLE) / count(*), 2) AS avg_order_value
    FROM valid_sales GROUP BY 1""", "valid_sales")
def by_region(spark, d):
    return gold.by_region(entities.valid_sales(
        spark, d, "sale_id", "sale_date", "customer_id", "region", "sale_amount"
    ))


@case("gold_monthly_trend", """
    SELECT strftime(sale_date, '%Y-%m') AS month,
           CAST(sum(sale_amount) AS DOUBLE) AS monthly_revenue,
           count(sale_id) AS orders, count(DISTINCT customer_id) AS unique_customers
    FROM valid_sales GROUP BY 1""", "valid_sales")
def _(spark, d):
    return gold.monthly_trend(entities.valid_sales(
        spark, d, "sale_id", "sale_date", "customer_id", "sale_amount"
    ))


@case("gold_daily_store", """
    SELECT sale_date::VARCHAR AS sale_date, store_id, count(sale_id) AS transaction_count,
           CAST(sum(sale_amount) AS DOUBLE) AS total_sales,
           CAST(sum(sale_amount) AS DOUBLE) / count(sale_amount) AS avg_transaction_value,
           count(DISTINCT customer_id) AS unique_customers
    FROM valid_sales GROUP BY ALL""", "valid_sales")
def _(spark, d):
    return gold.daily_store(entities.valid_sales(
        spark, d, "sale_id", "sale_date", "customer_id", "store_id", "sale_amount"
    ))


@case("gold_sales_analytics", """
    SELECT s.sale_date::VARCHAR AS sale_date, p.category_standardized, c.customer_segment,
           count(sale_id) AS transaction_count, CAST(sum(sale_amount) AS DOUBLE) AS total_sales,
           CAST(sum(sale_amount) AS DOUBLE) / count(sale_amount) AS avg_transaction_value,
           CAST(min(sale_amount) AS DOUBLE) AS min_transaction_value,
           CAST(max(sale_amount) AS DOUBLE) AS max_transaction_value,
           count(DISTINCT s.customer_id) AS unique_customers,
           count(DISTINCT s.product_id) AS unique_products,
           CAST(sum(sale_amount) AS DOUBLE) / count(DISTINCT s.customer_id) AS sales_per_customer,
           CAST(count(DISTINCT s.product_id) AS DOUBLE) / count(sale_id)
             AS products_per_transaction
    FROM silver_sales s
    LEFT JOIN silver_customers c ON s.customer_id = c.customer_id
    LEFT JOIN silver_products p ON s.product_id = p.product_id
    GROUP BY s.sale_date, p.category_standardized, c.customer_segment""",
      "silver_sales silver_customers silver_products")
def _(spark, d):
    return gold.sales_analytics(
        entities.silver_sales(spark, d), entities.silver_customers(spark, d),
        entities.silver_products(spark, d),
    )


@case("gold_customer_360", """
    SELECT c.customer_id, first_name, last_name, email, phone,
           registration_date::VARCHAR AS registration_date, customer_age_days, full_name,
           customer_segment, total_transactions,
           CAST(lifetime_value AS DOUBLE) AS lifetime_value, avg_order_value,
           first_purchase_date::VARCHAR AS first_purchase_date,
           last_purchase_date::VARCHAR AS last_purchase_date, unique_products_purchased,
           CAST(customer_tenure_days AS INTEGER) AS customer_tenure_days,
           CAST(total_transactions AS DOUBLE) / (customer_tenure_days + 1) AS purchase_frequency,
           CASE WHEN lifetime_value >= 2500000 THEN 'High Value'
                WHEN lifetime_value >= 1500000 THEN 'Medium Value'
                WHEN lifetime_value IS NOT NULL THEN 'Low Value'
                ELSE 'No Purchases' END AS customer_value_segment
    FROM (SELECT *, concat_ws(' ', first_name, last_name) AS full_name FROM silver_customers) c
    LEFT JOIN (
        SELECT customer_id, count(sale_id) AS total_transactions,
               sum(sale_amount) AS lifetime_value,
               CAST(sum(sale_amount) AS DOUBLE) / count(sale_amount) AS avg_order_value,
               min(sale_date) AS first_purchase_date, max(sale_date) AS last_purchase_date,
               count(DISTINCT product_id) AS unique_products_purchased,
               date_diff('day', min(sale_date), max(sale_date)) AS customer_tenure_days
        FROM silver_sales GROUP BY 1) m ON c.customer_id = m.customer_id""",
      "silver_customers silver_sales")
def _(spark, d):
    return gold.customer_360(
        entities.silver_sales(spark, d), entities.silver_customers(spark, d),
        entities.HIGH_VALUE, entities.MEDIUM_VALUE,
    )


@case("gold_product_performance", """
    SELECT p.product_id, product_name, category_standardized, total_sales_count,
           CAST(total_revenue AS DOUBLE) AS total_revenue, avg_sale_price, unique_customers,
           first_sale_date::VARCHAR AS first_sale_date, last_sale_date::VARCHAR AS last_sale_date,
           CAST(total_revenue AS DOUBLE) / unique_customers AS revenue_per_customer,
           coalesce(CAST(total_revenue AS DOUBLE), CAST(0 AS DOUBLE)) * CAST(0.6 AS DOUBLE)
             + coalesce(CAST(unique_customers AS DOUBLE), CAST(0 AS DOUBLE)) * CAST(0.4 AS DOUBLE)
             AS performance_score,
           CASE WHEN last_sale_date >= DATE '2001-08-02' - 30 THEN 'Active'
                WHEN last_sale_date >= DATE '2001-08-02' - 90 THEN 'Slow Moving'
                WHEN last_sale_date IS NOT NULL THEN 'Inactive'
                ELSE 'Never Sold' END AS product_status
    FROM silver_products p
    LEFT JOIN (
        SELECT product_id, count(sale_id) AS total_sales_count, sum(sale_amount) AS total_revenue,
               CAST(sum(sale_amount) AS DOUBLE) / count(sale_amount) AS avg_sale_price,
               count(DISTINCT customer_id) AS unique_customers,
               min(sale_date) AS first_sale_date, max(sale_date) AS last_sale_date
        FROM silver_sales GROUP BY 1) m ON p.product_id = m.product_id""",
      "silver_products silver_sales")
def _(spark, d):
    products = entities.silver_products(spark, d).select(
        "product_id", "product_name", "category_standardized"
    )
    return gold.product_performance(
        entities.silver_sales(spark, d), products, star.SALES_AS_OF
    )


@case("quarantine_breakdown", """
    SELECT quarantine_reason, count(*) AS "count" FROM rejected_sales GROUP BY 1""",
      "rejected_sales")
def _(spark, d):
    raw = star.sales_raw(spark, d, "sale_amount", "customer_id")
    _, rejected = quality.split_quarantine(raw, quality.SALES_REJECTS)
    return quality.quarantine_breakdown(rejected)


@case("quality_rate", """
    SELECT count(*) AS total_rows,
           count(*) FILTER (sale_amount > 0 AND customer_id IS NOT NULL) AS valid_rows,
           count(*) - count(*) FILTER (sale_amount > 0 AND customer_id IS NOT NULL)
             AS rejected_rows,
           round(count(*) FILTER (sale_amount > 0 AND customer_id IS NOT NULL) * 100.0
                 / count(*), 1) AS quality_rate
    FROM sales_raw""", "sales_raw")
def _(spark, d):
    raw = star.sales_raw(spark, d, "sale_amount", "customer_id")
    return quality.quality_rate(raw, quality.SALES_REJECTS)


@case("processing_summary", """
    SELECT 'events' AS table_name, 'run-1' AS batch_id, count(*) AS record_count,
           strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS last_processed,
           count(DISTINCT event_type) AS batch_count
    FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-30'""")
def _(spark, d):
    log = star.table(spark, d, "events").selectExpr(
        "ts as processed_timestamp", "event_type as batch_id"
    )
    return gold.processing_summary(log, "events", "run-1", as_of="2024-01-30 12:00:00")
