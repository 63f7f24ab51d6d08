import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from lakejobs.registry import flows
from lakejobs.schemas import SALES_CSV
from lakejobs.session import fresh_dir, work_dir
from lakejobs.sources import files, star_tables, synth
from lakejobs.streaming.silver import read_silver


def test_csv_with_and_without_schema(spark, tmp_path):
    path = str(tmp_path / "in")
    synth.write_batches(synth.synth_sales(spark, 30, 4), path)
    assert len(list((tmp_path / "in").glob("*.csv"))) == 3
    inferred, given = files.read_csv(spark, path), files.read_csv(spark, path, SALES_CSV)
    assert inferred.schema["sale_date"].dataType.simpleString() == "date"
    assert inferred.schema["quantity"].dataType.simpleString() == "int"
    assert rows(inferred) == rows(given) and given.count() == 34


def test_list_files(spark, tmp_path):
    spark.range(10).repartition(3).write.parquet(str(tmp_path / "t"))
    (tmp_path / "t" / "note.txt").write_text("x")
    got = files.list_files(spark, str(tmp_path / "t")).collect()
    assert len(got) == 3 and all(r.file_size > 0 and r.modified_at for r in got)
    assert files.list_files(spark, str(tmp_path / "t"), "txt").first().file_size == 1


def test_jdbc_options():
    plain = files.jdbc_options("jdbc:x", "t", {"user": "u"})
    assert plain["dbtable"] == "t" and plain["user"] == "u" and "partitionColumn" not in plain
    split = files.jdbc_options("jdbc:x", "t", None, "id", (0, 99), 8)
    assert (split["partitionColumn"], split["upperBound"], split["numPartitions"]) == ("id", "99", "8")
    with pytest.raises(ValueError, match="bounds"):
        files.jdbc_options("jdbc:x", "t", None, "id")


def test_synth_shape(spark):
    df = synth.synth_sales(spark)
    assert df.count() == 525
    assert rows(df) == rows(synth.synth_sales(spark).repartition(7))
    bad = df.filter("_bad_reason IS NOT NULL").groupBy("_bad_reason").count()
    assert rows(bad) == [("negative_sale_amount", 13), ("null_customer_id", 12)]
    assert df.filter("sale_amount < 0").count() == 13 and df.filter("customer_id IS NULL").count() == 12
    assert df.filter("sale_date < '2025-01-01' OR sale_date > '2025-05-31'").count() == 0
    assert rows(df) != rows(synth.synth_sales(spark, seed=7))


def test_synth_weights(spark):
    share = {r.customer_segment: r["count"] / 20000 for r in
             synth.synth_sales(spark, 20000, 0).groupBy("customer_segment").count().collect()}
    assert share["Premium"] == pytest.approx(0.2, abs=0.02)
    assert share["Standard"] == pytest.approx(0.5, abs=0.02)


def test_synth_prices_stay_in_range(spark):
    df = synth.synth_sales(spark, 5000, 0)
    for r in df.groupBy("product_category", "customer_segment").agg(
        F.min("sale_amount").alias("lo"), F.max("sale_amount").alias("hi")
    ).collect():
        lo, hi = synth.CATEGORY_PRICES[r.product_category]
        factor = synth.SEGMENT_MULTIPLIER[r.customer_segment]
        assert lo * factor - 0.01 <= r.lo and r.hi <= hi * factor


def test_narrow_sales_are_the_same_rows(spark, small):
    wide = star_tables.sales_raw(spark, small).select("sale_id", "sale_amount")
    narrow = star_tables.sales_raw(spark, small, "sale_id", "sale_amount")
    assert rows(wide) == rows(narrow)
    assert "l_shipdate" not in narrow._jdf.queryExecution().executedPlan().toString()


def test_rows_of_sales_do_not_depend_on_the_columns(spark, small, tmp_path):
    """A line whose order, customer or part is unknown is no sale, whatever is asked for."""
    for name in ("orders", "customer", "part", "nation", "region"):
        table = star_tables.table(spark, small, name)
        key = {"orders": "o_orderkey", "customer": "c_custkey", "part": "p_partkey"}.get(name)
        (table.filter(f"{key} % 5 <> 0") if key else table).write.parquet(f"{tmp_path}/{name}.parquet")
    star_tables.table(spark, small, "lineitem").write.parquet(f"{tmp_path}/lineitem.parquet")
    wide = star_tables.sales_raw(spark, str(tmp_path)).select("sale_id")
    assert 0 < wide.count() < star_tables.sales_raw(spark, small).count()
    for column in ("sale_id", "quantity", "region", "product_category", "customer_id"):
        assert star_tables.sales_raw(spark, str(tmp_path), column).count() == wide.count()


def test_work_folder_is_the_configured_one(spark):
    assert work_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert fresh_dir(spark, "x").startswith(work_dir(spark))
    assert fresh_dir(spark, "x") != fresh_dir(spark, "x")


def test_sample_relational_rows(spark):
    """Store and day totals of five literal sales."""
    from lakejobs.operators import gold

    data = [("TXN001", "CUST001", 299.99, "2024-01-15", "New York"),
            ("TXN002", "CUST002", 149.99, "2024-01-15", "California"),
            ("TXN003", "CUST001", 599.99, "2024-01-16", "New York"),
            ("TXN004", "CUST003", 299.99, "2024-01-16", "Texas"),
            ("TXN005", "CUST002", 89.99, "2024-01-17", "California")]
    df = spark.createDataFrame(
        data, "transaction_id string, customer_id string, sale_amount double, sale_date string,"
        " store_location string")
    daily = gold.daily_store(df, "store_location", "transaction_id")
    assert daily.count() == 5
    assert daily.agg(F.round(F.sum("total_sales"), 2)).first()[0] == 1439.95


def put_star(spark, folder):
    """A star schema of a few rows, with keys that meet nothing."""
    tables = {
        "region": "select 0L as r_regionkey, 'R' as r_name",
        "nation": "select 0L as n_nationkey, 'N' as n_name, 0L as n_regionkey",
        "customer": "select id as c_custkey, id div 3 as c_nationkey, 'S' as c_mktsegment, 'C#1' as c_name from range(4)",
        "part": "select id as p_partkey, 'T' as p_type, 'n' as p_name, 1.5D as p_retailprice from range(3)",
        "orders": """select id as o_orderkey, nullif(id % 6, 5) as o_custkey, timestamp'2024-01-01' as o_orderdate,
            'P' as o_orderpriority from range(12)""",
        "lineitem": """select id % 14 as l_orderkey, cast(id as int) as l_linenumber, id % 5 as l_partkey,
            1L as l_suppkey, cast(id as double) as l_quantity, cast(id as double) as l_extendedprice from range(60)""",
    }
    for name, text in tables.items():
        spark.sql(text).write.parquet(f"{folder}/{name}.parquet")


def test_order_lines_are_shuffled_once_per_table_they_name(spark, tmp_path):
    """Orders meet their customers before their lines, so lines do not move for the customer."""
    put_star(spark, tmp_path)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = star_tables.sales_raw(spark, str(tmp_path), "sale_id", "customer_id", "product_id")
        moved = [x for x in plan(df).splitlines() if "Exchange hashpartitioning(" in x]
        assert sorted(x.split("hashpartitioning(")[1].split("#")[0] for x in moved) == [
            "c_custkey", "l_orderkey", "l_partkey", "o_custkey", "o_orderkey", "p_partkey"]
        # Lines below 14 orders and 5 parts, of which 12 and 3 are known; customers 3 and above,
        # and none, are of no known nation or unknown.
        want = sorted(f"SALE-{i % 14}-{i}" for i in range(60)
                      if i % 14 < 12 and i % 5 < 3 and i % 14 % 6 < 3)
        assert sorted(r.sale_id for r in df.collect()) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_landed_sales_are_compressed(spark, tmp_path):
    put_star(spark, tmp_path)
    lake, _ = flows._stream(spark, str(tmp_path), "compressed", gold=False)
    root = lake.root.removesuffix("/lake")
    assert files.list_files(spark, f"{root}/landing/sales", "json.gz").count() > 0
    assert files.list_files(spark, f"{root}/landing/sales", "json").count() == 0
    assert read_silver(spark, lake.silver("sales")).count() > 0
