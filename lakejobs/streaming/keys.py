"""The keys a deduplicated stream has seen, kept in bucketed files instead of stream state.

Each micro-batch is joined with the store on the key. Files are bucketed by it, so the store is
read where it lies and only the micro-batch is shuffled; the store grows on disk, not in the
memory of executors.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakejobs.operators.tables import few_rows
from lakejobs.session import path_exists

EPOCH = "_epoch"
_ABOUT = T.StructType([T.StructField("buckets", T.LongType()), T.StructField("ddl", T.StringType())])


class KeyStore:
    """Keys with the micro-batch that brought them; ``buckets`` holds from the first use on."""

    def __init__(self, spark: SparkSession, path: str, fields: list[T.StructField], buckets: int = 64):
        self.spark, self.path = spark, path
        self.names = [f.name for f in fields]
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
        if path_exists(spark, f"{path}/about"):
            about = spark.read.schema(_ABOUT).parquet(f"{path}/about").first()
            if about.ddl != ddl:
                raise ValueError(f"the store at {path} holds ({about.ddl}), not ({ddl})")
            buckets = about.buckets
        else:
            few_rows(spark, [{"buckets": buckets, "ddl": ddl}], _ABOUT).write.parquet(f"{path}/about")
        self.buckets = int(buckets)
        self.table = "seen_keys_" + hashlib.sha1(path.encode()).hexdigest()[:16]
        quoted = ", ".join(f"`{n}`" for n in self.names)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} ({ddl}, `{EPOCH}` bigint) USING parquet "
            f"CLUSTERED BY ({quoted}) INTO {self.buckets} BUCKETS LOCATION '{path}/keys'")
        spark.catalog.refreshTable(self.table)

    def before(self, epoch: int) -> DataFrame:
        """The keys of earlier micro-batches: a batch that runs again does not meet its own."""
        return self.spark.table(self.table).filter(F.col(EPOCH) < epoch).select(*self.names)

    def knows(self, epoch: int) -> bool:
        """Whether there are keys of earlier micro-batches."""
        return not self.before(epoch).isEmpty()

    def unseen(self, rows: DataFrame, epoch: int) -> DataFrame:
        """Rows whose key no earlier micro-batch had; a NULL in the key meets no other."""
        return rows.join(self.before(epoch), self.names, "left_anti")

    def add(self, rows: DataFrame, epoch: int) -> None:
        """Note the keys of a micro-batch; noting them twice does no harm."""
        keys = rows.select(*self.names).dropna().withColumn(EPOCH, F.lit(epoch).cast("long"))
        keys.repartition(self.buckets, *self.names).write.insertInto(self.table)
        self.spark.catalog.refreshTable(self.table)
