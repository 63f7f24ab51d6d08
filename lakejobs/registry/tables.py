"""Queries: table writes, changes and retention."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakejobs.operators import governance, retention, tables
from lakejobs.registry.case import case
from lakejobs.session import fresh_dir
from lakejobs.sources import files
from lakejobs.sources import star_tables as star

_LEDGER = """SELECT o_orderkey AS order_id, o_custkey AS customer_key, o_orderstatus AS status,
                    o_totalprice AS total_price, o_orderpriority AS priority FROM orders"""
_UPDATED = """SELECT o_orderkey AS order_id, o_custkey AS customer_key,
       CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN 'VIP'
            ELSE o_orderstatus END AS status,
       o_totalprice AS total_price, o_orderpriority AS priority FROM orders"""


def _urgent():
    return (F.col("status") == "F") & (F.col("priority") == "1-URGENT")


def _table(spark, d, name):
    """A table of two loads: the even orders, then the odd ones."""
    path = fresh_dir(spark, name)
    ledger = star.orders_ledger(spark, d)
    for load in (0, 1):
        rows = ledger.filter(F.col("order_id") % 2 == load).withColumn("load", F.lit(load))
        tables.write(rows, path, "replace", ["load"])
    return tables.read(spark, path)


@case("tbl_read_current", _LEDGER)
def _(spark, d):
    return _table(spark, d, "tbl_read_current").drop("load")


@case("tbl_read_version", _LEDGER + " WHERE o_orderkey % 2 = 0")
def _(spark, d):
    """The table as the first load left it."""
    return tables.up_to(_table(spark, d, "tbl_read_version"), "load", 0).drop("load")


@case("snk_overwrite", _LEDGER)
def _(spark, d):
    path = fresh_dir(spark, "snk_overwrite")
    ledger = star.orders_ledger(spark, d)
    for _ in range(2):
        tables.write(ledger, path)
    return tables.read(spark, path)


@case("snk_append_merge_schema", """
    SELECT o_orderkey AS order_id, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END AS status,
           CASE WHEN o_orderkey % 2 <> 0 THEN o_orderpriority END AS priority
    FROM orders""")
def _(spark, d):
    path = fresh_dir(spark, "snk_append")
    ledger = star.orders_ledger(spark, d)
    tables.append(ledger.filter("order_id % 2 = 0").select("order_id", "status"), path)
    tables.append(ledger.filter("order_id % 2 <> 0").select("order_id", "priority"), path)
    return tables.read(spark, path)


@case("snk_partitioned_by_day", """
    SELECT event_id AS rows_id, strftime(ts, '%Y-%m-%d') AS access_date FROM events
    WHERE ts >= TIMESTAMP '2024-01-20 00:00:00' AND ts < TIMESTAMP '2024-01-22 00:00:00'""")
def _(spark, d):
    """Access records written by day; two days are read back."""
    path = fresh_dir(spark, "snk_by_day")
    audit = star.table(spark, d, "events").selectExpr(
        "event_id as rows_id", "ts as access_timestamp")
    tables.write(governance.access_by_day(audit), path, partition_by=["access_date"])
    days = tables.read(spark, path).filter(
        "access_date >= date'2024-01-20' AND access_date < date'2024-01-22'")
    return days.select("rows_id", "access_date")


@case("snk_append_named", _LEDGER)
def _(spark, d):
    """Two appends to a table of the catalog, read by its name."""
    path = fresh_dir(spark, "snk_named")
    name = f"orders_{path.rpartition('-')[2]}"
    ledger = star.orders_ledger(spark, d)
    for part in (0, 1):
        tables.append_named(ledger.filter(f"order_id % 2 = {part}"), name, path)
    return spark.table(name)


@case("src_csv_scan", _LEDGER)
def _(spark, d):
    """Orders written as CSV files with a header and read by a schema."""
    path = fresh_dir(spark, "src_csv")
    ledger = star.orders_ledger(spark, d)
    ledger.write.option("header", True).csv(path)
    return files.read_csv(spark, path, ledger.schema)


@case("tbl_update", _UPDATED)
def _(spark, d):
    return tables.update(star.orders_ledger(spark, d), _urgent(), {"status": F.lit("VIP")})


@case("tbl_upsert", """
    SELECT o_orderkey AS order_id, o_custkey AS customer_key,
           CASE WHEN o_orderkey % 6 = 0 THEN 'X' ELSE o_orderstatus END AS status,
           o_totalprice AS total_price, o_orderpriority AS priority FROM orders
    UNION ALL
    SELECT -1 - o_orderkey, NULL, 'X', NULL, NULL FROM orders WHERE o_orderkey % 6 = 0""")
def _(spark, d):
    """Every sixth order gets a new status, and as many unknown orders come in."""
    ledger = star.orders_ledger(spark, d)
    known = ledger.filter("order_id % 6 = 0").select("order_id", F.lit("X").alias("status"))
    updates = known.unionByName(known.withColumn("order_id", -1 - F.col("order_id")))
    return tables.upsert(ledger, updates, ["order_id"])


@case("tbl_history", """
    SELECT o_orderkey % 2 AS load, count(*) AS num_rows_written,
           CAST(sum(count(*)) OVER (ORDER BY o_orderkey % 2) AS BIGINT) AS num_rows
    FROM orders GROUP BY 1""")
def _(spark, d):
    sizes = tables.load_sizes(_table(spark, d, "tbl_history"), "load")
    return sizes.withColumn("load", F.col("load").cast("long"))


@case("tbl_detail", "SELECT count(*) AS num_rows, true AS has_files FROM orders")
def _(spark, d):
    """Rows of a table by its files; how many files there are is the writer's affair."""
    return tables.file_sizes(_table(spark, d, "tbl_detail")).select(
        "num_rows", ((F.col("num_files") >= 2) & (F.col("size_bytes") > 0)).alias("has_files"))


@case("tbl_compact_files", """
    SELECT count(*) AS num_rows, CAST(16 AS BIGINT) AS files_before, true AS fewer_files,
           true AS same_rows FROM orders""")
def _(spark, d):
    """Files before and behind a compaction: one for each 128 MB, and a few more at most."""
    small, path = fresh_dir(spark, "tbl_16_files"), fresh_dir(spark, "tbl_few_files")
    tables.write(star.orders_ledger(spark, d).repartition(16, "order_id"), small)
    before = spark.read.parquet(small)
    tables.compact(before, path)
    sizes = [tables.file_sizes(df).withColumn("when", F.lit(n))
             for n, df in enumerate((before, spark.read.parquet(path)))]
    sizes = sizes[0].unionByName(sizes[1])

    def at(column, n):
        return F.max(F.when(F.col("when") == n, F.col(column)))

    return sizes.agg(
        at("num_rows", 1).alias("num_rows"), at("num_files", 0).alias("files_before"),
        (at("num_files", 1) <= at("size_bytes", 1) / (128 << 20) + 2).alias("fewer_files"),
        (at("num_rows", 0) == at("num_rows", 1)).alias("same_rows"))


@case("tbl_compact", _LEDGER)
def _(spark, d):
    """Many small files put together in a folder of their own; the rows stay."""
    path = fresh_dir(spark, "tbl_compact")
    tables.compact(_table(spark, d, "tbl_small").drop("load"), path)
    return tables.read(spark, path)


@case("tbl_diff", """
    SELECT 'update_pre' AS change_type, o_orderkey AS order_id, o_custkey AS customer_key,
           o_orderstatus AS status, o_totalprice AS total_price, o_orderpriority AS priority
    FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'
    UNION ALL
    SELECT 'update_post', o_orderkey, o_custkey, 'VIP', o_totalprice, o_orderpriority
    FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'""")
def _(spark, d):
    """Changes an update made."""
    ledger = star.orders_ledger(spark, d)
    after = tables.update(ledger, _urgent(), {"status": F.lit("VIP")})
    return tables.diff(ledger, after, ["order_id"])


@case("tbl_diff_by_buckets", """
    SELECT 'update_pre' AS change_type, o_orderkey AS order_id, o_custkey AS customer_key,
           o_orderstatus AS status, o_totalprice AS total_price, o_orderpriority AS priority
    FROM orders WHERE o_orderkey % 1000 = 7
    UNION ALL
    SELECT 'update_post', o_orderkey, o_custkey, 'VIP', o_totalprice, o_orderpriority
    FROM orders WHERE o_orderkey % 1000 = 7
    UNION ALL
    SELECT 'delete', o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority
    FROM orders WHERE o_orderkey % 1000 = 8
    UNION ALL
    SELECT 'insert', -o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority
    FROM orders WHERE o_orderkey % 1000 = 9""")
def _(spark, d):
    """Few changes in a large table: only the key buckets that hold one are compared."""
    ledger = star.orders_ledger(spark, d)
    left = ledger.filter("order_id % 1000 <> 8")
    after = tables.update(left, F.col("order_id") % 1000 == 7, {"status": F.lit("VIP")}).unionByName(
        ledger.filter("order_id % 1000 = 9").withColumn("order_id", -F.col("order_id")))
    return tables.diff_by_buckets(ledger, after, ["order_id"])


@case("tbl_change_feed", """
    SELECT 'delete' AS change_type, o_orderkey AS order_id, o_orderstatus AS status
    FROM orders WHERE o_orderkey % 3 = 0
    UNION ALL
    SELECT 'insert', -1 - o_orderkey, o_orderstatus FROM orders WHERE o_orderkey % 3 = 0
    UNION ALL
    SELECT 'update_pre', o_orderkey, o_orderstatus FROM orders WHERE o_orderkey % 3 = 1
    UNION ALL
    SELECT 'update_post', o_orderkey, NULL FROM orders WHERE o_orderkey % 3 = 1""")
def _(spark, d):
    """Every kind of change, with a value becoming NULL."""
    old = star.orders_ledger(spark, d).select("order_id", "status")
    new = old.select(
        F.when(F.col("order_id") % 3 == 0, -1 - F.col("order_id"))
        .otherwise(F.col("order_id")).alias("order_id"),
        F.when(F.col("order_id") % 3 != 1, F.col("status")).alias("status"),
    )
    return tables.diff(old, new, ["order_id"])


@case("retention_prune", """
    SELECT event_id, event_type FROM events
    WHERE ts >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 7 DAY""")
def _(spark, d):
    events = star.table(spark, d, "events").select("event_id", "event_type", "ts")
    return retention.prune(events, "ts", "7-days", star.EVENTS_AS_OF).drop("ts")


@case("retention_by_class", """
    SELECT event_id, event_type FROM events
    WHERE CASE event_type WHEN 'click' THEN ts >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 7 DAY
                          WHEN 'view' THEN ts >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 20 DAY
                          ELSE TRUE END""")
def _(spark, d):
    events = star.table(spark, d, "events").select("event_id", "event_type", "ts")
    policy = {"click": "7-days", "view": "20-days", "error": "permanent"}
    return retention.prune(events, "ts", policy, star.EVENTS_AS_OF, "event_type").drop("ts")
