"""Column transforms; every function works on batch and streaming frames."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakejobs.functions import classes, clock, text

# Source field names and the names used from silver on.
SALES_NAMES = {
    "saleId": "sale_id", "customerId": "customer_id", "productId": "product_id",
    "saleAmount": "sale_amount", "saleDate": "sale_date",
}
CUSTOMER_NAMES = {
    "customerId": "customer_id", "firstName": "first_name", "lastName": "last_name",
    "emailAddress": "email", "phoneNumber": "phone", "registrationDate": "registration_date",
}
PRODUCT_NAMES = {
    "productId": "product_id", "productName": "product_name", "categoryName": "category",
    "productPrice": "price", "productDescription": "description",
}


def normalize_names(df: DataFrame, split_camel: bool = False) -> DataFrame:
    """Lower-case names with ``_`` for spaces and hyphens; two names may not meet."""
    names = []
    for name in df.columns:
        if split_camel:
            name = re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", name)
        names.append(name.lower().replace(" ", "_").replace("-", "_"))
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ValueError(f"column names collide after normalising: {', '.join(clashes)}")
    return df.toDF(*names)


def clean_strings(df: DataFrame) -> DataFrame:
    """Trim every string column and turn empty text into NULL, in one projection."""
    return df.select(*[
        text.blank_to_null(_quoted(f.name)).alias(f.name)
        if isinstance(f.dataType, T.StringType) else _quoted(f.name)
        for f in df.schema.fields
    ])


def _quoted(name: str) -> Column:
    return F.col(f"`{name.replace('`', '``')}`")


def as_date(df: DataFrame, column: str) -> Column:
    """A date column; text is parsed as ``yyyy-MM-dd``, times are cut, dates stay."""
    if isinstance(df.schema[column].dataType, T.StringType):
        return text.iso_date(column)
    return F.col(column).cast("date")


def cast_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast named columns; values that do not fit become NULL."""
    return df.withColumns({
        c: as_date(df, c) if kind == "date" else F.col(c).try_cast(kind)
        for c, kind in types.items()
    })


def clean_ids(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: text.clean_id(c) for c in columns})


def align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Add the columns of ``schema`` that are missing as NULL; keep new ones after them."""
    have = set(df.columns)
    known = [
        F.col(f.name).cast(f.dataType) if f.name in have
        else F.lit(None).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ]
    named = [c.alias(f.name) for c, f in zip(known, schema.fields)]
    extra = [c for c in df.columns if c not in set(schema.names)]
    return df.select(*named, *extra)


def ingest_audit(
    df: DataFrame, batch_id: str, source_system: str | None = None, layer: str | None = None,
    source_file: bool = True,
) -> DataFrame:
    """Ingestion time, source file, batch and origin.

    ``source_file`` needs a frame read directly from files.
    """
    extra = {"ingestion_timestamp": F.current_timestamp(), "batch_id": F.lit(batch_id)}
    if source_file:
        extra["source_file"] = F.col("_metadata.file_path")
    if source_system:
        extra["source_system"] = F.lit(source_system)
    if layer:
        extra["layer"] = F.lit(layer)
    return df.withColumns(extra)


def process_audit(
    df: DataFrame, record_status: str | None = None, batch_id: str | None = None
) -> DataFrame:
    extra = {"processed_timestamp": F.current_timestamp()}
    if batch_id:
        extra["batch_id"] = F.lit(batch_id)
    if record_status:
        extra["record_status"] = F.lit(record_status)
    return df.withColumns(extra)


def mask_email(df: DataFrame, env: str, column: str = "email") -> DataFrame:
    """Outside production the raw address is replaced by ``<column>_masked``."""
    if env == "prod":
        return df.withColumn(f"{column}_masked", F.col(column))
    return df.withColumn(f"{column}_masked", text.masked_email(column)).drop(column)


def row_score(*rules: Column) -> Column:
    """100 when every rule holds, else 0."""
    passed = F.lit(True)
    for rule in rules:
        passed = passed & F.coalesce(rule, F.lit(False))
    return F.when(passed, 100.0).otherwise(0.0)


def rule_share(*rules: Column) -> Column:
    """Share of rules that hold on the row, in percent."""
    passed = sum((F.coalesce(r, F.lit(False)).cast("int") for r in rules), F.lit(0))
    return passed.cast("double") / float(len(rules)) * 100.0


def clean_sales(df: DataFrame) -> DataFrame:
    """Names, types, identifiers and row score of raw sales."""
    df = cast_columns(df.withColumnsRenamed(SALES_NAMES), {
        "sale_id": "string", "customer_id": "string", "product_id": "string",
        "sale_amount": "decimal(10,2)", "sale_date": "date",
    })
    df = clean_ids(df, "sale_id", "customer_id", "product_id")
    return df.withColumn("data_quality_score", row_score(
        F.col("sale_amount") > 0, F.col("sale_date").isNotNull(),
        F.col("customer_id").isNotNull(), F.col("sale_id").isNotNull(),
    ))


def clean_customers(df: DataFrame, as_of: str | Column | None = None) -> DataFrame:
    """Names, contacts, full name and tenure of raw customers."""
    df = df.withColumnsRenamed(CUSTOMER_NAMES)
    return (
        df.withColumns({
            "customer_id": text.clean_id("customer_id"),
            "first_name": text.title_case("first_name"),
            "last_name": text.title_case("last_name"),
            "email": text.clean_email("email"),
            "phone": text.phone_digits("phone"),
            "registration_date": as_date(df, "registration_date"),
        })
        .withColumns({
            "full_name": F.concat_ws(" ", "first_name", "last_name"),
            "customer_age_days": F.datediff(clock.day(as_of), "registration_date"),
        })
        .withColumn("customer_segment", classes.tenure_segment("customer_age_days"))
    )


def clean_products(
    df: DataFrame, synonyms: dict[str, tuple[str, ...]] | None = None
) -> DataFrame:
    """Names, price and standard category of raw products."""
    df = df.withColumnsRenamed(PRODUCT_NAMES)
    tidy = {
        "product_id": text.clean_id("product_id"),
        "product_name": F.trim("product_name"),
        "category": text.title_case("category"),
        "price": text.money("price"),
    }
    if "description" in df.columns:
        tidy["description"] = F.trim("description")
    return df.withColumns(tidy).withColumn(
        "category_standardized", classes.standard_category("category", synonyms)
    )
