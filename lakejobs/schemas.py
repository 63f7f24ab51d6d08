"""Fixed schemas: raw inputs, log tables, issues and reports."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T

_S, _L, _D = T.StringType(), T.LongType(), T.DoubleType()
_TS, _I, _B = T.TimestampType(), T.IntegerType(), T.BooleanType()
_MAP = T.MapType(T.StringType(), T.StringType())
_LIST = T.ArrayType(T.StringType())


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


SALES_CSV = _struct(
    sale_id=_S, sale_date=T.DateType(), customer_id=_S, customer_segment=_S,
    product_id=_S, product_category=_S, sale_amount=_D, quantity=_I, store_id=_S,
    region=_S, payment_method=_S, ingestion_source=_S, _bad_reason=_S,
)

PROCESSING_EVENTS = _struct(
    timestamp=_TS, batch_id=_S, table_name=_S, event_type=_S, message=_S, details=_MAP,
)

LOAD_LEDGER = _struct(
    at=_TS, batch_id=_S, state=_S, mode=_S, folder=_S, rows=_L, mark=_S, written=_L,
    quarantined=_L, issues=_LIST, silver=_S, quarantine=_S, published=_TS,
)

PROCESSING_SUMMARY = _struct(
    table_name=_S, batch_id=_S, record_count=_L, last_processed=_TS, batch_count=_L,
    summary_timestamp=_TS,
)

DATA_QUALITY_METRICS = _struct(
    table_name=_S, layer=_S, total_rows=_L, null_percentage=_D, check_timestamp=_TS,
    status=_S, error_message=_S,
)

DATA_LINEAGE = _struct(
    lineage_id=_S, source_table=_S, target_table=_S, transformation_type=_S,
    pipeline_name=_S, execution_timestamp=_TS, user_email=_S, column_mapping=_MAP,
    quality_score=_D, created_at=_TS,
)

QUALITY_METRICS = _struct(
    table_name=_S, quality_check_name=_S, check_result=_S, quality_score=_D,
    row_count=_L, null_count=_L, duplicate_count=_L, outlier_count=_L,
    check_timestamp=_TS, remediation_action=_S, created_at=_TS,
)

ACCESS_AUDIT = _struct(
    user_email=_S, table_name=_S, action_type=_S, access_timestamp=_TS, ip_address=_S,
    user_agent=_S, query_text=_S, rows_accessed=_L, columns_accessed=_LIST,
    data_classification=_S, compliance_tags=_LIST, created_at=_TS,
)

ISSUES = _struct(type=_S, severity=_S, message=_S, details=_MAP)

# Log tables that exist as named tables; the audit log is split by day.
LOG_TABLES = {
    "data_lineage": (DATA_LINEAGE, None),
    "quality_metrics": (QUALITY_METRICS, None),
    "access_audit": (ACCESS_AUDIT, "access_date"),
}


def create_log_tables(spark: SparkSession, database: str = "default") -> list[str]:
    """Create the lineage, quality and audit tables when they are missing.

    ``created_at`` defaults to the time of the insert.  The audit table has a
    date column of its own because a Parquet table cannot be partitioned by an
    expression.
    """
    names = []
    for name, (schema, partition) in LOG_TABLES.items():
        columns = [
            f"`{f.name}` {f.dataType.simpleString()}"
            + (" DEFAULT current_timestamp()" if f.name == "created_at" else "")
            for f in schema.fields
        ]
        if partition:
            columns.append(f"`{partition}` date")
        ddl = f"CREATE TABLE IF NOT EXISTS {database}.{name} ({', '.join(columns)}) USING parquet"
        if partition:
            ddl += f" PARTITIONED BY ({partition})"
        spark.sql(ddl)
        names.append(f"{database}.{name}")
    return names
