"""Sales, customer, product and log entities built from a star schema.

The star tables hold no defects, so NULLs, negative amounts, malformed e-mails
and rejected products are placed by key modulus.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SALES_AS_OF = "2001-08-02"
EVENTS_AS_OF = "2024-01-31 00:00:00"

_SALES_COLUMNS = {
    "sale_id": "concat('SALE-', l_orderkey, '-', l_linenumber)",
    "sale_date": "cast(o_orderdate as date)",
    "customer_id": "case when l_orderkey % 43 = 0 then null else concat('CUST-', o_custkey) end",
    "customer_segment": "c_mktsegment",
    "product_id": "concat('PROD-', l_partkey)",
    "product_category": "p_type",
    "sale_amount": (
        "case when l_orderkey % 47 = 0 then null"
        " when l_orderkey % 41 = 0 then -l_extendedprice else l_extendedprice end"
    ),
    "quantity": "cast(l_quantity as int)",
    "store_id": "concat('STR-', l_suppkey)",
    "region": "r_name",
    "payment_method": "o_orderpriority",
}
SALES_RAW = tuple(_SALES_COLUMNS)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def sales_raw(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """Order lines as raw sales; all columns unless some are named.

    All six tables are joined whatever the columns, so the rows never depend on them: a line
    whose order, customer, part, nation or region is unknown is no sale."""
    orders = table(spark, folder, "orders")
    # Orders meet their customers before their lines: several lines share an order.  Lines meet the
    # orders last, so those of an order come together, which makes files of them small.
    # 25 nations and 5 regions by definition of the schema
    places = table(spark, folder, "nation").join(
        F.broadcast(table(spark, folder, "region")), F.expr("n_regionkey = r_regionkey")
    )
    bought = (
        orders.join(table(spark, folder, "customer"), F.expr("o_custkey = c_custkey"))
        .join(F.broadcast(places), F.expr("c_nationkey = n_nationkey"))
    )
    df = (
        table(spark, folder, "lineitem")
        .join(table(spark, folder, "part"), F.expr("l_partkey = p_partkey"))
        .join(bought, F.expr("l_orderkey = o_orderkey"))
    )
    return df.selectExpr(*[f"{_SALES_COLUMNS[c]} as {c}" for c in columns or SALES_RAW])


def customers_raw(spark: SparkSession, folder: str) -> DataFrame:
    """Customers with mixed-case e-mails, plus one order-less customer per nation."""
    known = table(spark, folder, "customer").selectExpr(
        "concat('CUST-', c_custkey) as customer_id",
        "case when c_custkey % 29 = 0 then null when c_custkey % 37 = 0 then 'not-an-email'"
        " else concat('  User.', c_custkey, '@Mail.Example.COM ') end as email",
        "case when c_custkey % 31 = 0 then null when c_custkey % 53 = 0 then 'n/a'"
        " else concat('+1 (555) ', c_custkey) end as phone",
        "split_part(c_name, '#', 1) as first_name",
        "split_part(c_name, '#', 2) as last_name",
        "date'1999-01-01' + cast(c_custkey % 940 as int) as registration_date",
    )
    new = table(spark, folder, "nation").selectExpr(
        "concat('CUST-N', n_nationkey) as customer_id",
        "'new@example.com' as email",
        "cast(null as string) as phone",
        "'New' as first_name",
        "n_name as last_name",
        "date'2001-01-01' as registration_date",
    )
    return known.unionByName(new)


def products_raw(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as products with defects, plus one unsold product per nation."""
    known = table(spark, folder, "part").selectExpr(
        "case when p_partkey % 97 = 0 then null else concat(' prod-', p_partkey) end"
        " as product_id",
        "case when p_partkey % 89 = 0 then null else p_name end as product_name",
        "p_type as category",
        "case when p_partkey % 83 = 0 then -p_retailprice else p_retailprice end as price",
    )
    unsold = table(spark, folder, "nation").selectExpr(
        "concat(' prod-n', n_nationkey) as product_id",
        "n_name as product_name",
        "'PROMO' as category",
        "cast(1.0 as double) as price",
    )
    return known.unionByName(unsold)


def pipeline_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Run log: who ran, when, in which layer, with what outcome."""
    return table(spark, folder, "events").selectExpr(
        "event_id as run_id",
        "concat('pipe_', event_type) as pipeline_name",
        "ts as run_start",
        "case when event_type = 'error' then 'Failed'"
        " when event_id % 50 = 0 then 'InProgress' else 'Succeeded' end as status",
        "case event_id % 3 when 0 then 'bronze' when 1 then 'silver' else 'gold' end as layer",
        "concat('table_', user_id) as table_name",
    )


def access_audit(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").selectExpr(
        "ts as access_timestamp",
        "concat('user', user_id) as user_email",
        "case when event_type = 'error' then 'FAILED_ACCESS' else 'READ' end as action_type",
    )


def query_log(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").selectExpr("ts", "value * 1000 as duration_ms")


def quality_log(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").selectExpr(
        "event_type as table_name", "value as quality_score", "ts as check_timestamp"
    )


def cost_log(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").selectExpr(
        "event_type as service", "ts as usage_time", "cast(value as decimal(12,2)) as cost"
    )


def file_listing(spark: SparkSession, folder: str) -> DataFrame:
    """Stored objects by layer; no object lies in silver."""
    return table(spark, folder, "documents").selectExpr(
        "case when doc_id % 10 = 0 then 'quarantine'"
        " when doc_id % 3 = 0 then 'gold' else 'bronze' end as layer",
        "concat(source, '/', doc_id) as file_path",
        "n_chars as file_size",
    )


# Column names used to give every user table of the event log a schema.
CATALOG_COLUMN_NAMES = (
    "event_id", "contact_email", "Phone_Number", "ssn", "billing_address", "amount",
    "account_number", "routing_number", "monthly_revenue", "api_key", "diagnosis_code",
    "created_date", "password_hash", "region", "status", "quantity",
)


def catalog_columns(spark: SparkSession, folder: str) -> DataFrame:
    """(table_name, column_name) rows: every user's table was seen with four columns."""
    names = F.array(*[F.lit(n) for n in CATALOG_COLUMN_NAMES])
    return table(spark, folder, "events").select(
        F.concat(F.lit("table_"), F.col("user_id")).alias("table_name"),
        F.element_at(
            names,
            ((F.col("user_id") + F.col("event_id") % 4) % len(CATALOG_COLUMN_NAMES) + 1)
            .cast("int"),
        ).alias("column_name"),
    )


def orders_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as a keyed table for update, upsert, history and diff."""
    return table(spark, folder, "orders").selectExpr(
        "o_orderkey as order_id", "o_custkey as customer_key", "o_orderstatus as status",
        "o_totalprice as total_price", "o_orderpriority as priority",
    )
