"""Queries: data-quality operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakejobs.operators import projections, quality
from lakejobs.registry import entities
from lakejobs.registry.case import case
from lakejobs.sources import star_tables as star

_SALES = ("sale_id", "sale_date", "customer_id", "product_id", "sale_amount")


def _clean(spark, d):
    return projections.clean_sales(star.sales_raw(spark, d, *_SALES))


@case("dq_null_profile", """
    SELECT unnest(['customer_id', 'email', 'phone', 'first_name', 'last_name',
                   'registration_date']) AS column_name, n AS total_rows,
           unnest([a, b, c, d, e, f]) AS null_count,
           CAST(unnest([a, b, c, d, e, f]) * 100 AS DOUBLE) / n AS null_percentage
    FROM (SELECT count(*) AS n, count(*) - count(customer_id) AS a, count(*) - count(email) AS b,
                 count(*) - count(phone) AS c, count(*) - count(first_name) AS d,
                 count(*) - count(last_name) AS e, count(*) - count(registration_date) AS f
          FROM customers_raw)""", "customers_raw")
def _(spark, d):
    return quality.null_profile(star.customers_raw(spark, d))


@case("dq_duplicate_pct", """
    SELECT count(*) AS total_rows, (SELECT count(*) FROM (
               SELECT DISTINCT customer_id, sale_date FROM sales_raw)) AS distinct_keys,
           CAST((count(*) - (SELECT count(*) FROM (
               SELECT DISTINCT customer_id, sale_date FROM sales_raw))) * 100 AS DOUBLE)
             / count(*) AS duplicate_percentage
    FROM sales_raw""", "sales_raw")
def _(spark, d):
    raw = star.sales_raw(spark, d, "customer_id", "sale_date")
    return quality.duplicate_pct(raw, ["customer_id", "sale_date"])


@case("dq_expectations", """
    SELECT sale_id, product_id, customer_id, CAST(sale_amount AS DOUBLE) AS sale_amount
    FROM valid_sales WHERE sale_date IS NOT NULL""", "valid_sales")
def _(spark, d):
    return quality.apply_expectations(_clean(spark, d), quality.SALES_RULES).select(
        "sale_id", "product_id", "customer_id", "sale_amount"
    )


@case("dq_expectation_metrics", """
    SELECT r.rule, r.action, CAST(r.passed AS BIGINT) AS passed, n - r.passed AS failed
    FROM (SELECT count(*) AS n, count(*) FILTER (sale_amount > 0) AS a,
                 count(sale_date) AS b, count(customer_id) AS c, count(sale_id) AS d
          FROM sales_raw),
         LATERAL (VALUES ('valid_sale_amount', 'drop', a), ('valid_sale_date', 'drop', b),
                         ('valid_customer_id', 'drop', c), ('valid_sale_id', 'warn', d))
           AS r(rule, action, passed)""", "sales_raw")
def _(spark, d):
    return quality.expectation_metrics(_clean(spark, d), quality.SALES_RULES)


@case("dq_quarantine_split", """
    SELECT 'valid' AS side, count(*) AS "rows", count(sale_amount) AS with_amount FROM valid_sales
    UNION ALL
    SELECT 'rejected', count(*), count(sale_amount) FROM rejected_sales""",
      "valid_sales rejected_sales")
def _(spark, d):
    raw = star.sales_raw(spark, d, "sale_amount", "customer_id")
    rejected = F.col("quarantine_reason").isNotNull()
    known = F.col("sale_amount").isNotNull()
    sides = F.array(*[
        F.struct(F.lit(name).alias("side"), F.count_if(side).alias("rows"),
                 F.count_if(side & known).alias("with_amount"))
        for name, side in (("valid", ~rejected), ("rejected", rejected))
    ])
    both = quality.tagged(raw, quality.SALES_REJECTS).agg(sides.alias("sides"))
    return both.select(F.inline("sides"))


@case("dq_quarantine_rows", """
    SELECT sale_id, product_id, customer_id, sale_amount, quarantine_reason,
           concat_ws(',', CASE WHEN sale_amount <= 0 THEN 'negative_sale_amount' END,
                     CASE WHEN customer_id IS NULL THEN 'null_customer_id' END,
                     CASE WHEN sale_amount IS NULL THEN 'null_sale_amount' END) AS failed_rules
    FROM rejected_sales""", "rejected_sales")
def _(spark, d):
    raw = star.sales_raw(spark, d, "sale_id", "product_id", "customer_id", "sale_amount")
    _, rejected = quality.split_quarantine(raw, quality.SALES_REJECTS)
    return rejected.withColumn("failed_rules", F.concat_ws(",", "failed_rules"))


@case("dq_convention_split", """
    SELECT customer_id, trim(email) AS contact_email,
           CASE WHEN regexp_full_match(trim(email),
                    '[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\\.[a-zA-Z]{2,}')
                THEN NULL ELSE 'Validation failed' END AS quarantine_reason
    FROM customers_raw""", "customers_raw")
def _(spark, d):
    df = projections.clean_strings(
        star.customers_raw(spark, d).selectExpr("customer_id", "email as contact_email")
    )
    rules = quality.convention_rules(df.columns)
    return quality.tagged(df, rules, quality.CONVENTION_REASON).drop("failed_rules")


@case("dq_freshness", """
    SELECT strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS latest,
           CAST(date_sub('second', max(ts), TIMESTAMP '2024-01-31 00:00:00') AS DOUBLE)
             / CAST(3600 AS DOUBLE) AS age_hours,
           CAST(24 AS DOUBLE) AS threshold,
           date_sub('second', max(ts), TIMESTAMP '2024-01-31 00:00:00') <= 24 * 3600 AS passed
    FROM events""")
def _(spark, d):
    return quality.freshness(star.table(spark, d, "events"), "ts", star.EVENTS_AS_OF)


@case("dq_check_report", """
    SELECT 'not_empty' AS check_name, NULL AS column_name, CAST(count(*) AS DOUBLE) AS value,
           CAST(1 AS DOUBLE) AS threshold, count(*) >= 1 AS passed FROM sales_raw
    UNION ALL
    SELECT 'completeness', c.name, CAST(c.nulls * 100 AS DOUBLE) / n, CAST(5 AS DOUBLE),
           CAST(c.nulls * 100 AS DOUBLE) / n <= 5
    FROM (SELECT count(*) AS n, count(sale_id) AS a, count(sale_date) AS b,
                 count(customer_id) AS c, count(product_id) AS d, count(sale_amount) AS e
          FROM sales_raw),
         LATERAL (VALUES ('sale_id', n - a), ('sale_date', n - b), ('customer_id', n - c),
                         ('product_id', n - d), ('sale_amount', n - e)) AS c(name, nulls)
    UNION ALL
    SELECT 'business_rule', 'sale_amount', CAST(count(*) FILTER (sale_amount < 0) AS DOUBLE),
           CAST(0 AS DOUBLE), count(*) FILTER (sale_amount < 0) = 0 FROM sales_raw
    UNION ALL
    SELECT 'freshness', 'sale_date',
           CAST(date_sub('second', CAST(max(sale_date) AS TIMESTAMP),
                         TIMESTAMP '2001-08-02 00:00:00') AS DOUBLE) / CAST(3600 AS DOUBLE),
           CAST(24 AS DOUBLE),
           date_sub('second', CAST(max(sale_date) AS TIMESTAMP),
                    TIMESTAMP '2001-08-02 00:00:00') <= 24 * 3600 FROM sales_raw
    UNION ALL
    SELECT 'uniqueness', 'sale_id', CAST((count(*) - count(DISTINCT sale_id)) * 100 AS DOUBLE)
             / count(*), CAST(2 AS DOUBLE),
           CAST((count(*) - count(DISTINCT sale_id)) * 100 AS DOUBLE) / count(*) <= 2
    FROM sales_raw""", "sales_raw")
def _(spark, d):
    checks = quality.Checks("strict", ("sale_id",), "sale_date", star.SALES_AS_OF)
    return quality.check(star.sales_raw(spark, d, *_SALES), checks)


@case("dq_schema_diff", """
    WITH fields AS (SELECT event_type, unnest(json_keys(props)) AS column_name, props FROM events),
    typed AS (SELECT event_type, column_name,
                     json_type(json_extract(props, '$.' || column_name)) AS kind FROM fields),
    new AS (SELECT event_type, column_name,
                   CASE WHEN bool_and(kind IN ('UBIGINT', 'BIGINT')) THEN 'bigint'
                        WHEN bool_and(kind = 'VARCHAR') THEN 'string'
                        WHEN bool_and(kind = 'BOOLEAN') THEN 'boolean'
                        ELSE 'other' END AS data_type FROM typed GROUP BY 1, 2),
    old AS (SELECT DISTINCT event_type,
                   unnest(CASE WHEN event_type = 'click' THEN ['k', 'page']
                               WHEN event_type = 'view' THEN ['page'] ELSE ['k'] END) AS column_name
            FROM events)
    SELECT CASE WHEN old.column_name IS NULL THEN 'column_added'
                WHEN new.column_name IS NULL THEN 'column_removed'
                ELSE 'type_changed' END AS change,
           coalesce(new.event_type || '.' || new.column_name,
                    old.event_type || '.' || old.column_name) AS column_name,
           CASE WHEN old.column_name IS NOT NULL THEN 'string' END AS old_type,
           new.data_type AS new_type
    FROM new FULL JOIN old ON new.event_type = old.event_type
                          AND new.column_name = old.column_name""")
def _(spark, d):
    """Drift of the JSON fields of every event type against an expected schema."""
    events = star.table(spark, d, "events")
    seen = quality.json_fields(events, "props", "event_type").select(
        F.concat_ws(".", "event_type", "column_name").alias("column_name"), "data_type"
    )
    expected = F.when(F.col("event_type") == "click", F.array(F.lit("k"), F.lit("page"))).when(
        F.col("event_type") == "view", F.array(F.lit("page"))
    ).otherwise(F.array(F.lit("k")))
    old = events.select("event_type").distinct().select(
        "event_type", F.explode(expected).alias("name")
    ).select(F.concat_ws(".", "event_type", "name").alias("column_name"),
             F.lit("string").alias("data_type"))
    return quality.schema_diff(seen, old)


@case("dq_table_metrics", """
    , measured AS (
    SELECT 'sales_raw' AS table_name, 'bronze' AS layer, count(*) AS total_rows,
           CAST((5 * count(*) - count(sale_id) - count(sale_date) - count(customer_id)
                 - count(product_id) - count(sale_amount)) * 100 AS DOUBLE)
             / (count(*) * 5) AS null_percentage,
           CASE WHEN CAST((count(*) - count(DISTINCT sale_id)) * 100 AS DOUBLE) / count(*) <= 2
                 AND CAST((5 * count(*) - count(sale_id) - count(sale_date) - count(customer_id)
                 - count(product_id) - count(sale_amount)) * 100 AS DOUBLE) / (count(*) * 5) <= 5
                THEN 'PASSED' ELSE 'FAILED' END AS status
    FROM sales_raw
    UNION ALL
    SELECT 'silver_sales', 'silver', count(*), CAST(0 AS DOUBLE), 'PASSED'
    FROM (SELECT DISTINCT sale_id, sale_date FROM valid_sales WHERE sale_date IS NOT NULL)
    UNION ALL
    SELECT 'by_region', 'gold', count(DISTINCT region), CAST(0 AS DOUBLE), 'PASSED'
    FROM valid_sales)
    SELECT *, true AS timed, CAST(NULL AS BOOLEAN) AS not_found FROM measured
    UNION ALL SELECT 'missing', 'gold', 0, 100.0, 'ERROR', true, true""", "sales_raw valid_sales")
def _(spark, d):
    from lakejobs.registry.gold import by_region

    silver = entities.silver_sales(spark, d)
    return quality.all_table_metrics(spark, [
        (star.sales_raw(spark, d, *_SALES), "sales_raw", "bronze", ["sale_id"]),
        (silver, "silver_sales", "silver", ["sale_id", "sale_date"]),
        (by_region(spark, d), "by_region", "gold", ["region"]),
        (lambda: spark.read.parquet(f"{d}/no_such_table.parquet"), "missing", "gold", None),
    ]).select(
        "table_name", "layer", "total_rows", "null_percentage", "status",
        F.col("check_timestamp").isNotNull().alias("timed"),
        F.col("error_message").contains("PATH_NOT_FOUND").alias("not_found"),
    )
