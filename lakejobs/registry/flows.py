"""Queries: composed flows, each writing its tables below the work folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakejobs.operators import filters, quality, tables
from lakejobs.paths import LakePaths
from lakejobs.plans import audit, bronze_to_silver, medallion, streaming_medallion
from lakejobs.plans.together import together
from lakejobs.registry import entities
from lakejobs.registry.case import case
from lakejobs.session import fresh_dir, lean
from lakejobs.sources import star_tables as star
from lakejobs.streaming.ingest import ingest_stream, read_records, start_table
from lakejobs.streaming.silver import read_silver as read_streamed


@case("flow_medallion_summary", """
    SELECT (SELECT count(*) FROM sales_raw) AS bronze_rows,
           (SELECT count(*) FROM valid_sales) AS silver_rows,
           (SELECT count(*) FROM rejected_sales) AS quarantine_rows,
           round((SELECT count(*) FROM valid_sales) * 100.0 / (SELECT count(*) FROM sales_raw), 1)
             AS quality_rate,
           CAST((SELECT sum(sale_amount) FROM valid_sales) AS DOUBLE) AS by_segment_revenue,
           CAST((SELECT sum(sale_amount) FROM valid_sales) AS DOUBLE) AS by_region_revenue,
           CAST((SELECT sum(sale_amount) FROM valid_sales) AS DOUBLE) AS monthly_trend_revenue""",
      "valid_sales rejected_sales")
def medallion_summary(spark, d):
    lake = LakePaths(fresh_dir(spark, "medallion"))
    return medallion.run(star.sales_raw(spark, d), lake, "batch-1")


# Copies of each sale as they land in two waves, and the one that silver keeps: the first valid one
# to arrive, and within a wave the first in order.  Every sale of a quantity that ends in 0
# also lands in the second wave with a higher amount.  The flow takes the usual category synonyms, none of
# which occurs among the part types.
_STREAMED = """
    , landed AS (
        SELECT sale_id, sale_date, customer_id, product_id, sale_amount, quantity % 2 AS wave
        FROM sales_raw
        UNION ALL
        SELECT sale_id, sale_date, customer_id, product_id, sale_amount + 1, 1
        FROM sales_raw WHERE quantity % 10 = 0),
    typed AS (SELECT * REPLACE (CAST(sale_amount AS DECIMAL(10,2)) AS sale_amount) FROM landed),
    kept AS (
        SELECT * FROM typed WHERE sale_amount > 0 AND customer_id IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY sale_id, sale_date
                                   ORDER BY wave, product_id, sale_amount, customer_id) = 1)"""
_SALE_ORDER = ["product_id", "sale_amount", "customer_id"]


def _stream(spark, d, name, gold=True):
    """Landing files in three formats in two waves, streamed to silver, then gold and metrics."""
    root = fresh_dir(spark, name)
    landing = {name: f"{root}/landing/{name}" for name in streaming_medallion.SOURCES}
    camel = {"sale_id": "saleId", "customer_id": "customerId", "product_id": "productId",
             "sale_amount": "saleAmount", "sale_date": "saleDate"}
    raw = star.sales_raw(spark, d, *camel, "quantity")
    wave = F.col("quantity") % 2
    second = raw.withColumn(
        "sale_amount", F.when(wave == 0, F.col("sale_amount") + 1).otherwise(F.col("sale_amount")))
    second = second.filter((wave == 1) | (F.col("quantity") % 10 == 0))
    waves = [df.select(*camel).withColumnsRenamed(camel) for df in (raw.filter(wave == 0), second)]
    customers = star.customers_raw(spark, d).withColumnsRenamed({
        "customer_id": "customerId", "first_name": "firstName", "last_name": "lastName",
        "email": "emailAddress", "phone": "phoneNumber", "registration_date": "registrationDate",
    })
    products = star.products_raw(spark, d).withColumnsRenamed({
        "product_id": "productId", "product_name": "productName", "category": "categoryName",
        "price": "productPrice",
    })
    if gold:
        together(
            lambda: customers.write.option("header", True).csv(
                landing["customers"], compression="gzip"),
            lambda: products.write.parquet(landing["products"]),
        )
    lake = LakePaths(f"{root}/lake")
    for number, sales in enumerate(waves):
        with lean(spark):
            sales.write.mode("append").json(landing["sales"], compression="gzip")
        if gold:
            metrics = streaming_medallion.run(
                spark, landing, lake, f"batch-{number}", as_of=star.SALES_AS_OF,
                high=entities.HIGH_VALUE, medium=entities.MEDIUM_VALUE, sale_order=_SALE_ORDER)
        else:
            schemas = streaming_medallion.ingest(
                spark, {"sales": landing["sales"]}, lake, f"batch-{number}")
            streaming_medallion.refine(spark, schemas, lake, sale_order=_SALE_ORDER)
            metrics = None
    return lake, metrics


@case("flow_streaming_medallion", _STREAMED + """,
    gold AS (
        SELECT s.sale_date, p.category, c.customer_segment FROM kept s
        LEFT JOIN silver_customers c ON s.customer_id = c.customer_id
        LEFT JOIN silver_products p ON s.product_id = p.product_id GROUP BY ALL),
    counted AS (
        -- 5 data and 3 audit columns in bronze, 13 in gold; the others are never NULL
        SELECT 'bronze_sales_raw' AS table_name, 'bronze' AS layer, count(*) AS total_rows,
               (5 * count(*) - count(sale_id) - count(sale_date) - count(customer_id)
                - count(product_id) - count(sale_amount)) * 100.0 / (8 * count(*)) AS share
        FROM landed
        UNION ALL
        SELECT 'silver_sales_cleaned', 'silver', count(*),
               (count(*) - count(product_id)) * 100.0 / count(*) FROM kept
        UNION ALL
        SELECT 'gold_sales_analytics', 'gold', count(*),
               (2 * count(*) - count(category) - count(customer_segment)) * 100.0 / (13 * count(*))
        FROM gold)
    SELECT table_name, layer, total_rows, CAST(share AS DOUBLE) AS null_percentage,
           CASE WHEN total_rows > 0 AND share <= 5 THEN 'PASSED' ELSE 'FAILED' END AS status
    FROM counted""", "sales_raw silver_customers silver_products")
def _(spark, d):
    _, metrics = _stream(spark, d, "streaming")
    return metrics.drop("check_timestamp", "error_message")


@case("flow_streaming_dedup", _STREAMED + """
    SELECT sale_id, sale_date::VARCHAR AS sale_date, customer_id, product_id,
           CAST(sale_amount AS DOUBLE) AS sale_amount, concat('batch-', wave) AS batch_id
    FROM kept""", "sales_raw")
def _(spark, d):
    """Silver sales of two runs: which of differing copies stays."""
    lake, _ = _stream(spark, d, "streaming_dedup", gold=False)
    return read_streamed(spark, lake.silver("sales")).select(
        "sale_id", "sale_date", "customer_id", "product_id", "sale_amount", "batch_id")


@case("flow_stream_late_column", """
    SELECT event_id, CASE WHEN event_id % 2 = 1 THEN user_id END AS user_id,
           CASE WHEN event_id % 2 = 1 THEN event_type END AS event_type, value,
           CAST(NULL AS VARCHAR) AS _corrupt_record FROM events""")
def _(spark, d):
    """Columns of files that land once the stream is set up, but before it runs."""
    root = fresh_dir(spark, "late_column")
    lake = LakePaths(f"{root}/lake")
    events = star.table(spark, d, "events")
    events.filter("event_id % 2 = 0").select("event_id", "value").write.json(f"{root}/in")
    stream = ingest_stream(spark, f"{root}/in", "json", lake.schema("events"), "batch-1")
    events.filter("event_id % 2 = 1").select("event_id", "user_id", "event_type", "value") \
        .write.mode("append").json(f"{root}/in")
    start_table(stream, lake.bronze("events"), lake.checkpoint("events"),
                ["batch_id"]).awaitTermination()
    return read_records(spark, lake.bronze("events"), lake.schema("events")).select(
        "event_id", "user_id", "event_type", "value", "_corrupt_record")


def _streamed_gold(name, sql, uses, columns):
    """A query for one gold table over streamed silver, all of its columns."""

    @case(f"flow_streaming_{name}", _STREAMED + sql, uses)
    def _(spark, d):
        lake, _ = _stream(spark, d, f"streaming_{name}")
        return spark.read.parquet(lake.gold(name)).select(*columns)


_streamed_gold("sales_analytics", """
    SELECT s.sale_date::VARCHAR AS sale_date, p.category AS category_standardized, c.customer_segment,
           count(sale_id) AS transaction_count, CAST(sum(sale_amount) AS DOUBLE) AS total_sales,
           CAST(sum(sale_amount) AS DOUBLE) / count(sale_amount) AS avg_transaction_value,
           CAST(min(sale_amount) AS DOUBLE) AS min_transaction_value,
           CAST(max(sale_amount) AS DOUBLE) AS max_transaction_value,
           count(DISTINCT s.customer_id) AS unique_customers,
           count(DISTINCT s.product_id) AS unique_products,
           CAST(sum(sale_amount) AS DOUBLE) / count(DISTINCT s.customer_id) AS sales_per_customer,
           CAST(count(DISTINCT s.product_id) AS DOUBLE) / count(sale_id) AS products_per_transaction
    FROM kept s
    LEFT JOIN silver_customers c ON s.customer_id = c.customer_id
    LEFT JOIN silver_products p ON s.product_id = p.product_id GROUP BY ALL""",
    "sales_raw silver_customers silver_products",
    ["sale_date", "category_standardized", "customer_segment", "transaction_count",
     "total_sales", "avg_transaction_value", "min_transaction_value", "max_transaction_value",
     "unique_customers", "unique_products", "sales_per_customer", "products_per_transaction"])

_streamed_gold("customer_360", """
    SELECT c.customer_id, first_name, last_name, CASE WHEN strpos(email, '@') BETWEEN 1 AND 4 THEN '***@***.com'
                ELSE left(email, 3) || '***@***.com' END AS email_masked, phone, total_transactions,
           CAST(lifetime_value AS DOUBLE) AS lifetime_value, avg_order_value,
           first_purchase_date::VARCHAR AS first_purchase_date,
           last_purchase_date::VARCHAR AS last_purchase_date, unique_products_purchased,
           CAST(last_purchase_date - first_purchase_date AS INTEGER) AS customer_tenure_days,
           CAST(total_transactions AS DOUBLE) / (last_purchase_date - first_purchase_date + 1)
             AS purchase_frequency,
           CASE WHEN lifetime_value >= 2500000 THEN 'High Value'
                WHEN lifetime_value >= 1500000 THEN 'Medium Value'
                WHEN lifetime_value IS NOT NULL THEN 'Low Value'
                ELSE 'No Purchases' END AS customer_value_segment
    FROM silver_customers c
    LEFT JOIN (
        SELECT customer_id, count(sale_id) AS total_transactions,
               sum(sale_amount) AS lifetime_value,
               CAST(sum(sale_amount) AS DOUBLE) / count(sale_amount) AS avg_order_value,
               min(sale_date) AS first_purchase_date, max(sale_date) AS last_purchase_date,
               count(DISTINCT product_id) AS unique_products_purchased
        FROM kept GROUP BY 1) m ON c.customer_id = m.customer_id""",
    "sales_raw silver_customers",
    ["customer_id", "first_name", "last_name", "email_masked", "phone", "total_transactions",
     "lifetime_value", "avg_order_value", "first_purchase_date", "last_purchase_date",
     "unique_products_purchased", "customer_tenure_days", "purchase_frequency",
     "customer_value_segment"])

_streamed_gold("product_performance", """
    SELECT p.product_id, product_name, category AS category_standardized,
           CAST(price AS DOUBLE) AS price, total_sales_count,
           CAST(total_revenue AS DOUBLE) AS total_revenue, avg_sale_price, unique_customers,
           first_sale_date::VARCHAR AS first_sale_date, last_sale_date::VARCHAR AS last_sale_date,
           CAST(total_revenue AS DOUBLE) / unique_customers AS revenue_per_customer,
           coalesce(CAST(total_revenue AS DOUBLE), 0) * 0.6
             + coalesce(CAST(unique_customers AS DOUBLE), 0) * 0.4 AS performance_score,
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
        FROM kept GROUP BY 1) m ON p.product_id = m.product_id""",
    "sales_raw silver_products",
    ["product_id", "product_name", "category_standardized", "price", "total_sales_count",
     "total_revenue", "avg_sale_price", "unique_customers", "first_sale_date", "last_sale_date",
     "revenue_per_customer", "performance_score", "product_status"])


_LOADED = """
    SELECT event_id, user_id, trim(event_type) AS event_type, value,
           CASE WHEN ts <= TIMESTAMP '2024-01-20 00:00:00' THEN 'batch-1' ELSE 'batch-2' END
             AS batch_id, ts
    FROM events WHERE event_id % 11 {} 0"""


def _load_events(spark, d, name):
    """Two incremental loads: events up to a day, then the whole table again."""
    lake = LakePaths(fresh_dir(spark, name))
    bronze = star.table(spark, d, "events").selectExpr(
        "event_id as `Event-ID`", "case when event_id % 11 = 0 then null else user_id end"
        " as `User ID`", "concat(' ', event_type) as `Event Type`", "value",
        "ts as ingestion_timestamp",
    )
    first = bronze.filter("ingestion_timestamp <= timestamp_ntz'2024-01-20 00:00:00'")
    bronze_to_silver.run(first, lake, "events", "batch-1")
    bronze_to_silver.run(bronze, lake, "events", "batch-2")
    return lake


@case("flow_bronze_to_silver", "SELECT * EXCLUDE (ts) FROM (" + _LOADED.format("<>") + ")")
def _(spark, d):
    lake = _load_events(spark, d, "bronze_to_silver")
    return bronze_to_silver.read_silver(spark, lake, "events").select(
        "event_id", "user_id", "event_type", "value", "batch_id"
    )


@case("flow_load_rerun", """
    SELECT event_id, CASE WHEN ts <= TIMESTAMP '2024-01-10 00:00:00' THEN 'batch-1'
                          WHEN ts <= TIMESTAMP '2024-01-20 00:00:00' THEN 'batch-2'
                          ELSE 'batch-3' END AS batch_id,
           event_id % 11 = 0 AS rejected, CAST(1 AS BIGINT) AS refused
    FROM events""")
def _(spark, d):
    """Loads that are given a finished batch id again, and that stop once they are staged."""
    lake = LakePaths(fresh_dir(spark, "load_rerun"))
    bronze = star.table(spark, d, "events").selectExpr(
        "event_id", "case when event_id % 11 = 0 then null else user_id end as user_id",
        "ts as ingestion_timestamp")

    def until(day):
        return bronze.filter(f"ingestion_timestamp <= timestamp_ntz'2024-01-{day} 00:00:00'")

    bronze_to_silver.run(until(10), lake, "events", "batch-1")
    refused = 0
    try:
        bronze_to_silver.run(bronze, lake, "events", "batch-1")
    except bronze_to_silver.LoadFinished:
        refused = 1
    standing = bronze_to_silver.ledger_of(spark, lake, "events").standing("batch-2")
    bronze_to_silver.stage(until(20), lake, "events", "batch-2", standing)
    bronze_to_silver.run(bronze, lake, "events", "batch-3")
    silver = bronze_to_silver.read_silver(spark, lake, "events")
    bad = bronze_to_silver.read_batches(spark, lake.quarantine("events"))
    return silver.select("event_id", "batch_id", F.lit(False).alias("rejected")).union(
        bad.select("event_id", "batch_id", F.lit(True))).withColumn(
        "refused", F.lit(refused).cast("long"))


@case("flow_load_late", """
    SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 'batch-2' ELSE 'batch-1' END AS batch_id
    FROM events WHERE event_id % 5 <> 0 OR ts > (SELECT max(ts) FROM events WHERE event_id % 5 <> 0)
                                                - INTERVAL 240 HOUR""")
def _(spark, d):
    """A fifth of the events arrives behind the others; those at most ten days late are loaded."""
    lake = LakePaths(fresh_dir(spark, "load_late"))
    bronze = star.table(spark, d, "events").selectExpr("event_id", "ts as ingestion_timestamp")
    late = filters.Late(("event_id",), hours=240)
    for batch, rows in (("batch-1", bronze.filter("event_id % 5 <> 0")), ("batch-2", bronze),
                        ("batch-3", bronze)):
        bronze_to_silver.run(rows, lake, "events", batch, late=late)
    return bronze_to_silver.read_silver(spark, lake, "events").select("event_id", "batch_id")


@case("flow_load_quarantine", "SELECT event_id, event_type, batch_id, 'user_id_set' AS failed_rules,"
      " 'Validation failed' AS quarantine_reason FROM (" + _LOADED.format("=") + ")")
def _(spark, d):
    """The rejected rows of both loads."""
    lake = _load_events(spark, d, "load_quarantine")
    rejected = bronze_to_silver.read_batches(spark, lake.quarantine("events"))
    return rejected.select(
        "event_id", "event_type", "batch_id", "quarantine_reason",
        F.array_join("failed_rules", ",").alias("failed_rules"),
    )


@case("flow_load_events", """
    , rows AS (SELECT CASE WHEN ts <= TIMESTAMP '2024-01-20 00:00:00' THEN 'batch-1'
                           ELSE 'batch-2' END AS batch_id,
                      count(*) FILTER (event_id % 11 <> 0) AS good,
                      count(*) FILTER (event_id % 11 = 0) AS bad FROM events GROUP BY 1)
    SELECT batch_id, 'INFO' AS event_type, 'Load begins' AS message, NULL AS processed,
           NULL AS quarantined FROM rows
    UNION ALL SELECT batch_id, 'WARNING', 'Rows were quarantined', NULL, CAST(bad AS VARCHAR)
    FROM rows WHERE bad > 0
    UNION ALL SELECT batch_id, 'SUCCESS', 'Load complete', CAST(good AS VARCHAR),
                     CAST(bad AS VARCHAR) FROM rows""".replace(", rows", "WITH rows", 1))
def _(spark, d):
    """The event log of both loads."""
    lake = _load_events(spark, d, "load_events")
    log = spark.read.parquet(lake.monitoring("processing_events"))
    return log.select(
        "batch_id", "event_type", "message",
        F.col("details")["records_processed"].alias("processed"),
        F.coalesce(F.col("details")["records"], F.col("details")["records_quarantined"])
        .alias("quarantined"),
    )


@case("flow_load_summary", """
    SELECT 'events' AS table_name, batch_id, record_count, batch_count FROM (
        SELECT 'batch-1' AS batch_id, count(*) AS record_count, CAST(1 AS BIGINT) AS batch_count
        FROM events WHERE event_id % 11 <> 0 AND ts <= TIMESTAMP '2024-01-20 00:00:00'
        UNION ALL
        SELECT 'batch-2', count(*), CAST(2 AS BIGINT) FROM events WHERE event_id % 11 <> 0)""")
def _(spark, d):
    """The summary each load adds; both loads are of one day."""
    lake = _load_events(spark, d, "load_summary")
    return spark.read.parquet(lake.monitoring("processing_summary")).select(
        "table_name", "batch_id", "record_count", "batch_count")


@case("flow_load_lineage", """
    SELECT batch_id AS lineage_id, 'bronze.events' AS source_table,
           'silver.events' AS target_table, 'bronze_to_silver' AS transformation_type,
           'Event-ID' AS event_id_from,
           CAST(100 AS DOUBLE) * count(*) FILTER (event_id % 11 <> 0) / count(*) AS quality_score
    FROM (SELECT event_id, CASE WHEN ts <= TIMESTAMP '2024-01-20 00:00:00' THEN 'events-batch-1'
                                ELSE 'events-batch-2' END AS batch_id FROM events) GROUP BY 1""")
def _(spark, d):
    """The lineage each load records."""
    lake = _load_events(spark, d, "load_lineage")
    return spark.read.parquet(lake.monitoring("data_lineage")).select(
        "lineage_id", "source_table", "target_table", "transformation_type",
        F.col("column_mapping")["event_id"].alias("event_id_from"), "quality_score")


@case("flow_load_gate", """
    SELECT 'ERROR' AS event_type, count(*) FILTER (event_id % 7 = 0) * 100.0 / count(*) > 1
             AS stopped, CAST(0 AS BIGINT) AS published FROM events""")
def _(spark, d):
    """A critical load whose rows lack too many values publishes nothing."""
    lake = LakePaths(fresh_dir(spark, "load_gate"))
    bronze = star.table(spark, d, "events").selectExpr(
        "event_id", "case when event_id % 7 <> 0 then event_type end as event_type",
        "ts as ingestion_timestamp")
    try:
        bronze_to_silver.run(bronze, lake, "events", "batch-1", quality.Checks("critical"))
    except quality.QualityGateError:
        pass
    log = spark.read.parquet(lake.monitoring("processing_events"))
    there = sum(tables.exists(spark, p) for p in (lake.silver("events"), lake.quarantine("events")))
    return log.filter("event_type = 'ERROR'").select(
        "event_type", F.contains("message", F.lit("completeness of event_type")).alias("stopped"),
        F.lit(there).cast("long").alias("published"))


@case("flow_audit_diff", """
    SELECT o_orderkey AS order_id, o_orderpriority AS priority, o_orderstatus AS was, 'VIP' AS now
    FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'""")
def _(spark, d):
    """A correction written as a new state of the table, and what it changed."""
    path = fresh_dir(spark, "audit")
    before = star.orders_ledger(spark, d)
    urgent = (F.col("status") == "F") & (F.col("priority") == "1-URGENT")
    tables.write(tables.update(before, urgent, {"status": F.lit("VIP")}), path)
    return audit.run(before, tables.read(spark, path), ["order_id"], "status", ["priority"])
