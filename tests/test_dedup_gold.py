import random
from decimal import Decimal

import pytest
from conftest import plan, rows
from hypothesis import given, settings
from hypothesis import strategies as st

from lakejobs.operators import gold
from lakejobs.operators.dedup import dedup
from lakejobs.operators.joins import enrich_sales


def test_null_keys_are_not_merged(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (None, "d")], "k int, v string")
    got = rows(dedup(df, ["k"], ["v"]))
    assert got == [(None, "c"), (None, "d"), (1, "a")]
    assert dedup(df, ["k"]).count() == 3


def test_first_per_key_cuts_before_the_shuffle(spark):
    """A key with a third of all rows leaves every task as one row."""
    df = spark.range(3000).selectExpr("if(id % 3 = 0, 0, id) as k", "id as v")
    out = dedup(df, ["k"], ["v"], keep_null_keys=False)
    text = plan(out)
    assert "WindowGroupLimit" in text and text.count("WindowGroupLimit") == 2
    assert out.count() == 2001 and out.filter("k = 0").first().v == 0


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.one_of(st.none(), st.integers(0, 5))), max_size=12))
def test_dedup_matches_brute_force(spark, data):
    df = spark.createDataFrame(data, "k int, v int")
    want = {}
    for k, v in data:
        rank = (v is not None, v or 0)
        if k not in want or rank < want[k][0]:
            want[k] = (rank, v)
    got = {r.k: r.v for r in dedup(df, ["k"], ["v"], keep_null_keys=False).collect()}
    assert got == {k: v for k, (_, v) in want.items()}


@pytest.fixture(scope="module")
def sales(spark):
    draw = random.Random(7)
    data = [
        (f"S{i}", f"2024-0{draw.randint(1, 3)}-1{draw.randint(0, 9)}", f"C{draw.randint(0, 6)}",
         f"P{draw.randint(0, 4)}", Decimal(draw.randint(1, 9999)) / 100,
         draw.choice(["A", "B"]), draw.choice(["X", "Y", "Z"]), f"ST{draw.randint(0, 2)}")
        for i in range(200)
    ]
    return spark.createDataFrame(
        data, "sale_id string, sale_date string, customer_id string, product_id string,"
        " sale_amount decimal(10,2), customer_segment string, region string, store_id string",
    ).selectExpr("* EXCEPT (sale_date)", "cast(sale_date as date) sale_date").cache()


def test_all_gold_tables_share_one_total(sales):
    total = sum(r.sale_amount for r in sales.collect())
    for frame, column, orders in (
        (gold.by_segment(sales), "total_revenue", "total_orders"),
        (gold.by_region(sales), "total_revenue", "total_orders"),
        (gold.monthly_trend(sales), "monthly_revenue", "orders"),
        (gold.daily_store(sales), "total_sales", "transaction_count"),
    ):
        got = frame.collect()
        assert sum(r[column] for r in got) == total
        assert sum(r[orders] for r in got) == 200


def test_order_of_reports(sales):
    revenue = [r.total_revenue for r in gold.by_region(sales).collect()]
    assert revenue == sorted(revenue, reverse=True)
    months = [r.month for r in gold.monthly_trend(sales).collect()]
    assert months == sorted(months)


def test_customer_360_keeps_customers_without_sales(spark, sales):
    customers = spark.createDataFrame([("C1", "New"), ("none", "New")],
                                      "customer_id string, customer_segment string")
    got = {r.customer_id: r for r in gold.customer_360(sales, customers, 100, 50).collect()}
    assert got["none"].customer_value_segment == "No Purchases"
    assert got["none"].lifetime_value is None
    mine = [r for r in sales.collect() if r.customer_id == "C1"]
    assert got["C1"].total_transactions == len(mine)
    assert got["C1"].unique_products_purchased == len({r.product_id for r in mine})
    days = (max(r.sale_date for r in mine) - min(r.sale_date for r in mine)).days
    assert got["C1"].customer_tenure_days == days
    assert got["C1"].purchase_frequency == pytest.approx(len(mine) / (days + 1))


def test_product_performance(spark, sales):
    products = spark.createDataFrame([("P0", "n"), ("P9", "n")], "product_id string, product_name string")
    got = {r.product_id: r for r in gold.product_performance(sales, products, "2024-03-25").collect()}
    mine = [r for r in sales.collect() if r.product_id == "P0"]
    revenue, buyers = float(sum(r.sale_amount for r in mine)), len({r.customer_id for r in mine})
    assert got["P0"].performance_score == pytest.approx(0.6 * revenue + 0.4 * buyers)
    assert (got["P9"].performance_score, got["P9"].product_status) == (0.0, "Never Sold")


def test_sales_analytics_brute_force(spark, sales):
    customers = spark.createDataFrame([(f"C{i}", "Loyal") for i in range(3)],
                                      "customer_id string, customer_segment string")
    products = spark.createDataFrame([(f"P{i}", f"cat{i % 2}") for i in range(4)],
                                     "product_id string, category_standardized string")
    want = {}
    for r in sales.collect():
        seg = "Loyal" if int(r.customer_id[1:]) < 3 else None
        cat = f"cat{int(r.product_id[1:]) % 2}" if int(r.product_id[1:]) < 4 else None
        want.setdefault((r.sale_date, cat, seg), []).append(r)
    got = gold.sales_analytics(sales, customers, products).collect()
    assert len(got) == len(want)
    for r in got:
        mine = want[r.sale_date, r.category_standardized, r.customer_segment]
        assert r.transaction_count == len(mine)
        assert r.total_sales == sum(m.sale_amount for m in mine)
        assert r.unique_customers == len({m.customer_id for m in mine})
        assert r.unique_products == len({m.product_id for m in mine})


def test_enrich_does_not_multiply_or_cross(spark, sales):
    customers = spark.createDataFrame([("C1", "Loyal")], "customer_id string, customer_segment string")
    products = spark.createDataFrame([("P1", "cat")], "product_id string, category_standardized string")
    out = enrich_sales(sales, customers, products)
    assert out.count() == 200
    assert "Cartesian" not in plan(out) and "NestedLoop" not in plan(out)


def test_enrich_broadcasts_no_growing_table(spark, sales):
    customers = spark.sql("SELECT * FROM VALUES ('C1', 'Loyal'), ('C8', 'New') AS c(customer_id, customer_segment)")
    products = spark.sql("SELECT * FROM VALUES ('P1', 'cat'), ('P8', 'dog') AS p(product_id, category_standardized)")
    out = enrich_sales(sales, customers, products)
    assert "BroadcastHashJoin" not in plan(out) and plan(out).count("SortMergeJoin") == 2
    assert out.filter("customer_segment = 'Loyal'").count() == sales.filter("customer_id = 'C1'").count()


def test_processing_summary(spark):
    df = spark.createDataFrame(
        [("2024-01-02 01:00:00", "a"), ("2024-01-02 02:00:00", "b"), ("2024-01-01 02:00:00", "c")],
        "t string, batch_id string").selectExpr("cast(t as timestamp) processed_timestamp", "batch_id")
    got = gold.processing_summary(df, "t", "b9", as_of="2024-01-02 09:00:00").first()
    assert (got.table_name, got.batch_id, got.record_count, got.batch_count) == ("t", "b9", 2, 2)
