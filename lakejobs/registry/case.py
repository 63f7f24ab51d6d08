"""Registration of queries and the SQL fragments they share."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Case:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


CASES: dict[str, Case] = {}


def case(name: str, sql: str | None = None, uses: str = ""):
    """Register a query; ``uses`` names the shared fragments its SQL reads."""

    def add(fn):
        if name in CASES:
            raise ValueError(f"query {name} is registered twice")
        text = with_fragments(sql, uses) if sql else None
        CASES[name] = Case(lambda spark, folder: flat(fn(spark, folder)), text)
        return fn

    return add


def flat(df: DataFrame) -> DataFrame:
    """Dates and times as text, decimals as double, so engines can be compared."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        out.append(c.alias(f.name))
    return df.select(*out)


# Fragments are written out for DuckDB, apart from the Spark code.
FRAGMENTS = {
    "sales_raw": """
        SELECT concat('SALE-', l_orderkey, '-', l_linenumber) AS sale_id,
               CAST(o_orderdate AS DATE) AS sale_date,
               CASE WHEN l_orderkey % 43 = 0 THEN NULL
                    ELSE concat('CUST-', o_custkey) END AS customer_id,
               c_mktsegment AS customer_segment,
               concat('PROD-', l_partkey) AS product_id,
               p_type AS product_category,
               CASE WHEN l_orderkey % 47 = 0 THEN NULL
                    WHEN l_orderkey % 41 = 0 THEN -l_extendedprice
                    ELSE l_extendedprice END AS sale_amount,
               CAST(l_quantity AS INTEGER) AS quantity,
               concat('STR-', l_suppkey) AS store_id,
               r_name AS region,
               o_orderpriority AS payment_method
        FROM lineitem
        JOIN orders ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey = c_custkey
        JOIN part ON l_partkey = p_partkey
        JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey""",
    "customers_raw": """
        SELECT concat('CUST-', c_custkey) AS customer_id,
               CASE WHEN c_custkey % 29 = 0 THEN NULL
                    WHEN c_custkey % 37 = 0 THEN 'not-an-email'
                    ELSE concat('  User.', c_custkey, '@Mail.Example.COM ') END AS email,
               CASE WHEN c_custkey % 31 = 0 THEN NULL
                    WHEN c_custkey % 53 = 0 THEN 'n/a'
                    ELSE concat('+1 (555) ', c_custkey) END AS phone,
               split_part(c_name, '#', 1) AS first_name,
               split_part(c_name, '#', 2) AS last_name,
               DATE '1999-01-01' + CAST(c_custkey % 940 AS INTEGER) AS registration_date
        FROM customer
        UNION ALL
        SELECT concat('CUST-N', n_nationkey), 'new@example.com', NULL, 'New', n_name,
               DATE '2001-01-01'
        FROM nation""",
    "products_raw": """
        SELECT CASE WHEN p_partkey % 97 = 0 THEN NULL
                    ELSE concat(' prod-', p_partkey) END AS product_id,
               CASE WHEN p_partkey % 89 = 0 THEN NULL ELSE p_name END AS product_name,
               p_type AS category,
               CASE WHEN p_partkey % 83 = 0 THEN -p_retailprice ELSE p_retailprice END AS price
        FROM part
        UNION ALL
        SELECT concat(' prod-n', n_nationkey), n_name, 'PROMO', CAST(1.0 AS DOUBLE) FROM nation""",
    "valid_sales": """
        SELECT * EXCLUDE (sale_amount), CAST(sale_amount AS DECIMAL(12,2)) AS sale_amount
        FROM sales_raw WHERE sale_amount > 0 AND customer_id IS NOT NULL""",
    "rejected_sales": """
        SELECT *, CASE WHEN sale_amount <= 0 THEN 'negative_sale_amount'
                       WHEN customer_id IS NULL THEN 'null_customer_id'
                       ELSE 'null_sale_amount' END AS quarantine_reason
        FROM sales_raw
        WHERE sale_amount IS NULL OR sale_amount <= 0 OR customer_id IS NULL""",
    "silver_sales": """
        SELECT * EXCLUDE (pick) FROM (
            SELECT *, row_number() OVER (
                PARTITION BY sale_id, sale_date
                ORDER BY product_id, store_id, quantity, sale_amount) AS pick
            FROM valid_sales WHERE sale_date IS NOT NULL)
        WHERE pick = 1""",
    "clean_customers": """
        SELECT upper(trim(customer_id)) AS customer_id,
               upper(left(first_name, 1)) || lower(substr(first_name, 2)) AS first_name,
               array_to_string(list_transform(string_split(last_name, ' '),
                   lambda w: upper(left(w, 1)) || lower(substr(w, 2))), ' ') AS last_name,
               lower(trim(email)) AS email,
               nullif(regexp_replace(phone, '[^0-9]', '', 'g'), '') AS phone,
               registration_date,
               date_diff('day', registration_date, DATE '2001-08-02') AS customer_age_days,
               CASE WHEN date_diff('day', registration_date, DATE '2001-08-02') > 365 THEN 'Loyal'
                    WHEN date_diff('day', registration_date, DATE '2001-08-02') > 90 THEN 'Regular'
                    ELSE 'New' END AS customer_segment
        FROM customers_raw""",
    "silver_customers": """
        SELECT * FROM clean_customers
        WHERE customer_id IS NOT NULL AND regexp_full_match(
            email, '[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\\.[a-zA-Z]{2,}')""",
    "clean_products": """
        SELECT upper(trim(product_id)) AS product_id, trim(product_name) AS product_name,
               upper(left(category, 1)) || lower(substr(category, 2)) AS category,
               CAST(price AS DECIMAL(10,2)) AS price,
               CASE upper(left(category, 1)) || lower(substr(category, 2))
                    WHEN 'Promo' THEN 'Deals' WHEN 'Economy' THEN 'Deals'
                    WHEN 'Large' THEN 'Sized' WHEN 'Medium' THEN 'Sized'
                    WHEN 'Small' THEN 'Sized'
                    ELSE upper(left(category, 1)) || lower(substr(category, 2))
               END AS category_standardized
        FROM products_raw""",
    "silver_products": """
        SELECT * FROM clean_products
        WHERE product_id IS NOT NULL AND product_name IS NOT NULL AND price >= 0""",
    "runs": """
        SELECT event_id AS run_id, concat('pipe_', event_type) AS pipeline_name, ts AS run_start,
               CASE WHEN event_type = 'error' THEN 'Failed'
                    WHEN event_id % 50 = 0 THEN 'InProgress' ELSE 'Succeeded' END AS status,
               CASE event_id % 3 WHEN 0 THEN 'bronze' WHEN 1 THEN 'silver' ELSE 'gold' END AS layer,
               concat('table_', user_id) AS table_name
        FROM events""",
    "files": """
        SELECT CASE WHEN doc_id % 10 = 0 THEN 'quarantine' WHEN doc_id % 3 = 0 THEN 'gold'
                    ELSE 'bronze' END AS layer, n_chars AS file_size
        FROM documents""",
}

_NEEDS = {
    "valid_sales": ["sales_raw"], "rejected_sales": ["sales_raw"],
    "silver_sales": ["valid_sales"], "clean_customers": ["customers_raw"],
    "silver_customers": ["clean_customers"], "clean_products": ["products_raw"],
    "silver_products": ["clean_products"],
}

# Synonyms used with the part types, in place of the retail categories.
TYPE_SYNONYMS = {"Deals": ("Promo", "Economy"), "Sized": ("Large", "Medium", "Small")}


def with_fragments(sql: str, uses: str) -> str:
    """Put the needed fragments in front of a query, each after those it reads."""
    order: list[str] = []

    def need(name: str) -> None:
        for other in _NEEDS.get(name, []):
            need(other)
        if name not in order:
            order.append(name)

    for name in uses.split():
        need(name)
    if not order:
        return sql.strip()
    parts = [f"{name} AS ({FRAGMENTS[name]}\n)" for name in order]
    return "WITH " + ",\n".join(parts) + "\n" + sql.strip()
