"""Queries: column transforms, filters, deduplication, generated sales."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakejobs.functions import classes, clock, text
from lakejobs.operators import dedup, filters, projections, tables
from lakejobs.operators.joins import enrich_sales
from lakejobs.registry import entities
from lakejobs.registry.case import TYPE_SYNONYMS, case
from lakejobs.schemas import SALES_CSV
from lakejobs.session import fresh_dir
from lakejobs.sources import star_tables as star


@case("prj_rename", """
    SELECT concat('SALE-', l_orderkey, '-', l_linenumber) AS sale_id,
           concat('PROD-', l_partkey) AS product_id, l_extendedprice AS sale_amount
    FROM lineitem""")
def _(spark, d):
    source = star.table(spark, d, "lineitem").selectExpr(
        "concat('SALE-', l_orderkey, '-', l_linenumber) as saleId",
        "concat('PROD-', l_partkey) as productId", "l_extendedprice as saleAmount",
    )
    return source.withColumnsRenamed(projections.SALES_NAMES)


@case("prj_normalize_names", """
    SELECT o_orderkey AS "order_id", o_custkey AS "customer_key", o_orderstatus AS "order_status"
    FROM orders""")
def _(spark, d):
    source = star.table(spark, d, "orders").selectExpr(
        "o_orderkey as `Order-ID`", "o_custkey as `customer key`", "o_orderstatus as `Order STATUS`"
    )
    return projections.normalize_names(source)


@case("prj_audit_columns", """
    SELECT o_orderkey, 'batch-7' AS batch_id, 'pos' AS source_system, 'bronze' AS layer,
           'VALID' AS record_status, 1 AS has_ingestion_time, 1 AS has_processed_time,
           1 AS has_source_file
    FROM orders""")
def _(spark, d):
    df = star.table(spark, d, "orders").select("o_orderkey", "_metadata")
    df = projections.process_audit(
        projections.ingest_audit(df, "batch-7", "pos", "bronze"), "VALID"
    )
    return df.select(
        "o_orderkey", "batch_id", "source_system", "layer", "record_status",
        F.col("ingestion_timestamp").isNotNull().cast("int").alias("has_ingestion_time"),
        F.col("processed_timestamp").isNotNull().cast("int").alias("has_processed_time"),
        F.col("source_file").endswith(".parquet").cast("int").alias("has_source_file"),
    )


@case("prj_cast", """
    SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
           CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_totalprice END AS amount,
           CASE WHEN o_orderkey % 7 = 0 THEN NULL
                ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS order_date
    FROM orders""")
def _(spark, d):
    texts = star.table(spark, d, "orders").selectExpr(
        "o_orderkey as order_id",
        "case when o_orderkey % 10 = 0 then 'n/a' else cast(o_totalprice as string) end as amount",
        "case when o_orderkey % 7 = 0 then '1995-02-31'"
        " else cast(cast(o_orderdate as date) as string) end as order_date",
    )
    return projections.cast_columns(
        texts, {"order_id": "string", "amount": "decimal(12,2)", "order_date": "date"}
    )


@case("prj_clean_ids", """
    SELECT upper(trim(product_id)) AS product_id, price FROM products_raw""", "products_raw")
def _(spark, d):
    return projections.clean_ids(star.products_raw(spark, d), "product_id").select(
        "product_id", "price"
    )


@case("prj_initcap", """
    SELECT customer_id, first_name, last_name FROM clean_customers""", "clean_customers")
def _(spark, d):
    return star.customers_raw(spark, d).select(
        "customer_id", text.title_case("first_name").alias("first_name"),
        text.title_case("last_name").alias("last_name"),
    )


@case("prj_email_clean", """
    SELECT customer_id, lower(trim(email)) AS email FROM customers_raw""", "customers_raw")
def _(spark, d):
    return star.customers_raw(spark, d).select(
        "customer_id", text.clean_email("email").alias("email")
    )


@case("prj_phone_digits", """
    SELECT customer_id, nullif(regexp_replace(phone, '[^0-9]', '', 'g'), '') AS phone
    FROM customers_raw""", "customers_raw")
def _(spark, d):
    return star.customers_raw(spark, d).select(
        "customer_id", text.phone_digits("phone").alias("phone")
    )


@case("prj_full_name", """
    SELECT customer_id, concat_ws(' ', first_name, last_name) AS full_name
    FROM clean_customers""", "clean_customers")
def _(spark, d):
    return projections.clean_customers(star.customers_raw(spark, d), star.SALES_AS_OF).select(
        "customer_id", "full_name"
    )


@case("prj_tenure_days", """
    SELECT customer_id, CAST(customer_age_days AS INTEGER) AS customer_age_days
    FROM clean_customers""", "clean_customers")
def _(spark, d):
    return projections.clean_customers(star.customers_raw(spark, d), star.SALES_AS_OF).select(
        "customer_id", "customer_age_days"
    )


@case("prj_tenure_segment", """
    SELECT customer_segment, count(*) AS customers FROM clean_customers GROUP BY 1""",
      "clean_customers")
def _(spark, d):
    clean = projections.clean_customers(star.customers_raw(spark, d), star.SALES_AS_OF)
    return clean.groupBy("customer_segment").agg(F.count(F.lit(1)).alias("customers"))


@case("pii_mask_email", """
    SELECT customer_id,
           CASE WHEN email IS NULL THEN NULL
                WHEN strpos(email, '@') BETWEEN 1 AND 4 THEN '***@***.com'
                ELSE left(email, 3) || '***@***.com' END AS email_masked
    FROM clean_customers""", "clean_customers")
def _(spark, d):
    clean = projections.clean_customers(star.customers_raw(spark, d), star.SALES_AS_OF)
    return projections.mask_email(clean, "dev").select("customer_id", "email_masked")


@case("prj_category_std", """
    SELECT category, category_standardized, count(*) AS products
    FROM clean_products GROUP BY 1, 2""", "clean_products")
def _(spark, d):
    clean = projections.clean_products(star.products_raw(spark, d), TYPE_SYNONYMS)
    return clean.groupBy("category", "category_standardized").agg(
        F.count(F.lit(1)).alias("products")
    )


@case("prj_clean_strings", """
    SELECT o_orderkey, nullif(trim(o_orderpriority), '') AS priority,
           CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderstatus END AS status
    FROM orders""")
def _(spark, d):
    padded = star.table(spark, d, "orders").selectExpr(
        "o_orderkey", "concat('  ', o_orderpriority, ' ') as priority",
        "case when o_orderkey % 5 = 0 then '   ' else o_orderstatus end as status",
    )
    return projections.clean_strings(padded)


@case("prj_align_schema", """
    SELECT sale_id, sale_date::VARCHAR AS sale_date, customer_id, customer_segment, product_id,
           product_category, sale_amount, quantity, store_id, region, payment_method,
           CAST(NULL AS VARCHAR) AS ingestion_source, CAST(NULL AS VARCHAR) AS _bad_reason,
           quantity * 2 AS doubled
    FROM sales_raw""", "sales_raw")
def _(spark, d):
    newer = star.sales_raw(spark, d).withColumn("doubled", F.col("quantity") * 2)
    return projections.align(newer, SALES_CSV)


@case("dq_row_score", """
    SELECT sale_id, product_id,
           CASE WHEN sale_amount > 0 AND sale_date IS NOT NULL AND customer_id IS NOT NULL
                THEN CAST(100 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS data_quality_score,
           (CASE WHEN sale_amount > 0 THEN 1 ELSE 0 END
            + CASE WHEN sale_date IS NOT NULL THEN 1 ELSE 0 END
            + CASE WHEN customer_id IS NOT NULL THEN 1 ELSE 0 END
            + CASE WHEN sale_id IS NOT NULL THEN 1 ELSE 0 END)::DOUBLE
              / CAST(4 AS DOUBLE) * CAST(100 AS DOUBLE) AS rule_share
    FROM sales_raw""", "sales_raw")
def _(spark, d):
    raw = star.sales_raw(
        spark, d, "sale_id", "sale_date", "customer_id", "product_id", "sale_amount"
    )
    clean = projections.clean_sales(raw)
    share = projections.rule_share(
        F.col("sale_amount") > 0, F.col("sale_date").isNotNull(),
        F.col("customer_id").isNotNull(), F.col("sale_id").isNotNull(),
    )
    return clean.select("sale_id", "product_id", "data_quality_score", share.alias("rule_share"))


@case("customer_value_segment", """
    SELECT CASE WHEN v >= 2500000 THEN 'High Value' WHEN v >= 1500000 THEN 'Medium Value'
                WHEN v IS NOT NULL THEN 'Low Value' ELSE 'No Purchases' END
             AS customer_value_segment, count(*) AS customers
    FROM customers_raw LEFT JOIN (
        SELECT customer_id, sum(sale_amount) AS v FROM valid_sales GROUP BY 1) USING (customer_id)
    GROUP BY 1""", "customers_raw valid_sales")
def _(spark, d):
    value = entities.valid_sales(spark, d, "sale_date", "customer_id", "sale_amount").groupBy(
        "customer_id"
    ).agg(F.sum("sale_amount").alias("v"))
    joined = star.customers_raw(spark, d).select("customer_id").join(value, "customer_id", "left")
    segment = classes.value_segment("v", entities.HIGH_VALUE, entities.MEDIUM_VALUE)
    return joined.groupBy(segment.alias("customer_value_segment")).agg(
        F.count(F.lit(1)).alias("customers")
    )


@case("product_recency_status", """
    SELECT CASE WHEN last >= DATE '2001-08-02' - 30 THEN 'Active'
                WHEN last >= DATE '2001-08-02' - 90 THEN 'Slow Moving'
                WHEN last IS NOT NULL THEN 'Inactive' ELSE 'Never Sold' END AS product_status,
           count(*) AS products
    FROM silver_products LEFT JOIN (
        SELECT product_id, max(sale_date) AS last FROM valid_sales GROUP BY 1) USING (product_id)
    GROUP BY 1""", "silver_products valid_sales")
def _(spark, d):
    last = entities.valid_sales(
        spark, d, "sale_date", "customer_id", "product_id", "sale_amount"
    ).groupBy("product_id").agg(F.max("sale_date").alias("last"))
    joined = entities.silver_products(spark, d).join(last, "product_id", "left")
    status = classes.recency_status("last", clock.day(star.SALES_AS_OF))
    return joined.groupBy(status.alias("product_status")).agg(F.count(F.lit(1)).alias("products"))


@case("flt_valid_sales", """
    SELECT sale_id, product_id, customer_id, CAST(sale_amount AS DOUBLE) AS sale_amount
    FROM valid_sales""", "valid_sales")
def _(spark, d):
    raw = star.sales_raw(spark, d, "sale_id", "product_id", "customer_id", "sale_amount")
    return filters.valid_sales(raw)


@case("flt_email_regex", """
    SELECT customer_id, email FROM silver_customers""", "silver_customers")
def _(spark, d):
    clean = projections.clean_customers(star.customers_raw(spark, d), star.SALES_AS_OF)
    return filters.with_valid_email(clean).select("customer_id", "email")


@case("flt_valid_products", """
    SELECT product_id, product_name, price FROM products_raw
    WHERE product_id IS NOT NULL AND product_name IS NOT NULL AND price >= 0""", "products_raw")
def _(spark, d):
    return filters.valid_products(star.products_raw(spark, d)).select(
        "product_id", "product_name", "price"
    )


@case("dq_has_contact", """
    SELECT customer_id, email, phone FROM clean_customers
    WHERE email IS NOT NULL OR phone IS NOT NULL""", "clean_customers")
def _(spark, d):
    clean = projections.clean_customers(star.customers_raw(spark, d), star.SALES_AS_OF)
    return filters.with_contact(clean).select("customer_id", "email", "phone")


@case("flt_incremental", """
    SELECT event_id, event_type FROM events
    WHERE ts > (SELECT max(ts) FROM events WHERE event_type = 'signup' AND user_id % 2 = 0)""")
def _(spark, d):
    events = star.table(spark, d, "events")
    target = events.filter("event_type = 'signup' AND user_id % 2 = 0").withColumnRenamed(
        "ts", "loaded_ts"
    )
    return filters.incremental(events, target, "ts", "loaded_ts").select("event_id", "event_type")


@case("flt_time_window", """
    SELECT event_id, event_type FROM events
    WHERE ts > TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 24 HOUR
      AND ts <= TIMESTAMP '2024-01-31 00:00:00'""")
def _(spark, d):
    events = star.table(spark, d, "events")
    return filters.within_hours(events, "ts", 24, star.EVENTS_AS_OF).select(
        "event_id", "event_type"
    )


@case("join_star_enrich", """
    SELECT sale_id, sales.product_id, sales.customer_id, CAST(sale_amount AS DOUBLE) AS sale_amount,
           c.customer_segment, p.category_standardized
    FROM valid_sales sales
    LEFT JOIN silver_customers c ON sales.customer_id = c.customer_id
    LEFT JOIN silver_products p ON sales.product_id = p.product_id""",
      "valid_sales silver_customers silver_products")
def _(spark, d):
    sales = entities.valid_sales(
        spark, d, "sale_id", "sale_date", "product_id", "customer_id", "sale_amount"
    ).drop("sale_date")
    return enrich_sales(
        sales, entities.silver_customers(spark, d), entities.silver_products(spark, d)
    )


@case("join_colocated", """
    SELECT sale_id, sales.customer_id, CAST(sale_amount AS DOUBLE) AS sale_amount,
           c.customer_segment, CAST(total AS DOUBLE) AS customer_total
    FROM valid_sales sales
    LEFT JOIN silver_customers c ON sales.customer_id = c.customer_id
    LEFT JOIN (SELECT customer_id, sum(sale_amount) AS total FROM valid_sales GROUP BY 1) t
        ON sales.customer_id = t.customer_id""",
      "valid_sales silver_customers")
def colocated(spark, d):
    """Sales and customers in buckets of the customer: joins and sums without a shuffle."""
    root = fresh_dir(spark, "colocated")
    number = root.rpartition("-")[2]
    sales = tables.write_bucketed(
        entities.valid_sales(
            spark, d, "sale_id", "sale_date", "customer_id", "sale_amount").drop("sale_date"),
        f"sales_{number}", f"{root}/sales", ["customer_id"], 16)
    customers = tables.write_bucketed(
        entities.silver_customers(spark, d).select("customer_id", "customer_segment"),
        f"customers_{number}", f"{root}/customers", ["customer_id"], 16)
    totals = sales.groupBy("customer_id").agg(F.sum("sale_amount").alias("customer_total"))
    # The sides are co-located by their buckets, so none has to be broadcast.
    return sales.join(customers.hint("merge"), "customer_id", "left").join(
        totals.hint("merge"), "customer_id", "left")


@case("dedup_sales", """
    SELECT DISTINCT sale_id, sale_date::VARCHAR AS sale_date FROM sales_raw""", "sales_raw")
def _(spark, d):
    raw = star.sales_raw(spark, d, "sale_id", "sale_date", "sale_amount")
    return dedup.dedup(raw, ["sale_id", "sale_date"]).select("sale_id", "sale_date")


@case("dedup_latest", """
    SELECT sale_id, sale_date::VARCHAR AS sale_date, customer_id, product_id, store_id, quantity,
           CAST(sale_amount AS DOUBLE) AS sale_amount
    FROM silver_sales""", "silver_sales")
def _(spark, d):
    return entities.silver_sales(spark, d).select(
        "sale_id", "sale_date", "customer_id", "product_id", "store_id", "quantity", "sale_amount"
    )
