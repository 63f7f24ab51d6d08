"""File and JDBC sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV files with a header; types are inferred only when no schema is given.

    Inference reads every file once more, so large inputs should name a schema.
    """
    reader = spark.read.option("header", True)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).csv(path)


def list_files(spark: SparkSession, path: str | list[str], ext: str = "parquet") -> DataFrame:
    """One row per data file of a format: path, bytes, modification time.

    The content column is never selected, so no file is opened.
    """
    paths = [path] if isinstance(path, str) else path
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", f"*.{ext}")
        .option("recursiveFileLookup", True)
        .load(paths)
        .select(
            F.col("path").alias("file_path"),
            F.col("length").alias("file_size"),
            F.col("modificationTime").alias("modified_at"),
        )
    )


def jdbc_options(
    url: str,
    table: str,
    props: dict[str, str] | None = None,
    partition_col: str | None = None,
    bounds: tuple[object, object] | None = None,
    num_partitions: int | None = None,
) -> dict[str, str]:
    """Options of a JDBC read; a partition column gives a parallel read."""
    options = {"url": url, "dbtable": table, "fetchsize": "10000", **(props or {})}
    if partition_col:
        if bounds is None or not num_partitions:
            raise ValueError("a partitioned read needs bounds and num_partitions")
        options |= {
            "partitionColumn": partition_col,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(num_partitions),
        }
    return options


def read_jdbc(spark: SparkSession, url: str, table: str, **kwargs) -> DataFrame:
    """A relational table over JDBC; see :func:`jdbc_options` for the arguments."""
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **kwargs)).load()
