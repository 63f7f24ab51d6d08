import pytest
from conftest import rows
from pyspark.sql import functions as F

from lakejobs.operators import filters, quality
from lakejobs.operators.quality import Checks, Expectation

SALES = [(1, 10.0, "c"), (2, -1.0, "c"), (3, 5.0, None), (4, None, "c"), (5, None, None), (6, 0.0, None)]


@pytest.fixture
def sales(spark):
    return spark.createDataFrame(SALES, "id int, sale_amount double, customer_id string")


def test_split_loses_no_row(sales):
    valid, rejected = quality.split_quarantine(sales, quality.SALES_REJECTS)
    assert rows(valid) == [(1, 10.0, "c")]
    got = {r.id: (r.quarantine_reason, r.failed_rules) for r in rejected.collect()}
    assert got == {
        2: ("negative_sale_amount", ["negative_sale_amount"]),
        3: ("null_customer_id", ["null_customer_id"]),
        4: ("null_sale_amount", ["null_sale_amount"]),
        5: ("null_customer_id", ["null_customer_id", "null_sale_amount"]),
        6: ("negative_sale_amount", ["negative_sale_amount", "null_customer_id"]),
    }


def test_two_plain_filters_would_lose_the_null_amount(sales):
    """The rule departed from: keeping > 0 and rejecting <= 0 misses unknown amounts."""
    kept = filters.valid_sales(sales).count()
    bad = sales.filter("sale_amount <= 0 OR customer_id IS NULL").count()
    assert kept + bad == len(SALES) - 1


def test_convention_split_rejects_unknown_email(spark):
    df = spark.createDataFrame(
        [("1", "a@b.com"), ("2", None), (None, "a@b.com"), ("4", "x")],
        "user_id string, contact_email string",
    )
    valid, rejected = quality.convention_split(df)
    assert rows(valid) == [("1", "a@b.com")]
    assert rejected.count() == 3
    assert {r.quarantine_reason for r in rejected.collect()} == {"Validation failed"}


def test_no_rules_keep_everything(spark):
    df = spark.range(3).toDF("n")
    valid, rejected = quality.convention_split(df)
    assert valid.count() == 3 and rejected.count() == 0


def test_expectations_and_metrics(sales):
    rules = (Expectation("amount", "sale_amount > 0"),
             Expectation("customer", lambda: F.col("customer_id").isNotNull(), "warn"))
    assert [r[0] for r in rows(quality.apply_expectations(sales, rules))] == [1, 3]
    assert rows(quality.expectation_metrics(sales, rules)) == [
        ("amount", "drop", 2, 4), ("customer", "warn", 3, 3)]
    kept, seen = quality.observe_expectations(sales, rules, "t-expectations")
    assert kept.count() == 2
    assert seen.get == {"rows": 6, "amount": 2, "customer": 3}


def test_quality_rate(sales, spark):
    assert tuple(quality.quality_rate(sales, quality.SALES_REJECTS).first()) == (6, 1, 5, 16.7)
    empty = quality.quality_rate(sales.limit(0), quality.SALES_REJECTS).first()
    assert tuple(empty) == (0, 0, 0, None)


def test_duplicates_count_null_keys_as_one(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,)], "k int")
    assert tuple(quality.duplicate_pct(df, ["k"]).first()) == (4, 2, 50.0)


def test_null_profile(sales):
    assert rows(quality.null_profile(sales)) == [
        ("customer_id", 6, 3, 50.0), ("id", 6, 0, 0.0),
        ("sale_amount", 6, 2, pytest.approx(100 / 3))]


def test_check_reports_every_column(spark):
    df = spark.createDataFrame(
        [(1, None, 5, "2024-01-01 00:00:00"), (1, None, -5, "2024-01-01 06:00:00")],
        "id int, note string, list_price bigint, at string",
    ).withColumn("at", F.col("at").cast("timestamp"))
    checks = Checks("strict", ("id",), "at", "2024-01-02 05:00:00")
    got = {(r.check_name, r.column_name): (r.value, r.passed)
           for r in quality.check(df, checks).collect()}
    assert got == {
        ("not_empty", None): (2.0, True), ("completeness", "id"): (0.0, True),
        ("completeness", "note"): (100.0, False), ("completeness", "list_price"): (0.0, True),
        ("completeness", "at"): (0.0, True),
        # long columns are checked too, unlike a check of int and double only
        ("business_rule", "list_price"): (1.0, False), ("freshness", "at"): (23.0, True),
        ("uniqueness", "id"): (50.0, False),
    }


def test_check_of_nothing_fails_without_error(spark):
    report = quality.check(spark.createDataFrame([], "id int"), Checks(keys=("id",)))
    assert all(not r.passed for r in report.collect())


def test_gate(spark):
    df = spark.createDataFrame([(None,), (1,)], "n int")
    report = quality.check(df, Checks("lenient"))
    assert len(quality.gate(report, "lenient")) == 1
    with pytest.raises(quality.QualityGateError, match="completeness of n"):
        quality.gate(report, "critical")


@pytest.mark.parametrize("level, share, passed", [
    ("lenient", 20, True), ("strict", 6, False), ("strict", 5, True), ("critical", 2, False),
])
def test_levels(spark, level, share, passed):
    df = spark.range(100).select(F.when(F.col("id") >= share, F.col("id")).alias("v"))
    row = quality.check(df, Checks(level)).filter("check_name = 'completeness'").first()
    assert row.passed is passed


def test_freshness_of_dates(spark):
    df = spark.createDataFrame([("2024-01-01",), (None,)], "d string").selectExpr("cast(d as date) d")
    got = quality.freshness(df, "d", "2024-01-02 12:00:00").first()
    assert (got.age_hours, got.passed) == (36.0, False)
    assert quality.freshness(df.limit(0), "d", "2024-01-02").first().passed is False


def test_table_metrics(spark):
    df = spark.createDataFrame([(1, None), (1, "x")], "a int, b string")
    row = quality.table_metrics(df, "t", "silver").first()
    assert (row.table_name, row.layer, row.total_rows, row.null_percentage, row.status, row.error_message) == (
        "t", "silver", 2, 25.0, "FAILED", None)
    assert row.check_timestamp is not None
    clean = df.filter("b IS NOT NULL")
    assert quality.table_metrics(clean, "t", "silver", ["a"]).first().status == "PASSED"
    twice = df.select("a")
    assert quality.table_metrics(twice, "t", "silver", ["a"]).first().status == "FAILED"
    empty = quality.table_metrics(df.limit(0), "t", "gold").first()
    assert (empty.total_rows, empty.null_percentage, empty.status) == (0, 100.0, "FAILED")


def test_schema_diff(spark):
    old = spark.createDataFrame([], "a int, b string, c date")
    new = spark.createDataFrame([], "a bigint, c date, d string")
    got = quality.schema_diff(quality.schema_frame(new), quality.schema_frame(old))
    assert rows(got) == [("column_added", "d", None, "string"),
                         ("column_removed", "b", "string", None),
                         ("type_changed", "a", "int", "bigint")]


def test_json_fields_take_the_widest_type(spark):
    df = spark.createDataFrame(
        [("x", '{"a": 1, "b": null}'), ("x", '{"a": 1e3}'), ("y", '{"a": "t"}'), ("y", None),
         ("y", '{"f": true, "i": 123456789012345678901234, "o": {"K": 1}, "m": 1, "l": [1]}'),
         ("y", '{"m": "text"}'), ("y", "no object"), ("y", "[1]"), ("z", '{"n": 1}'), ("z", '{"n": 2.5}')],
        "kind string, props string")
    assert rows(quality.json_fields(df, "props", "kind")) == [
        ("x", "a", "double"), ("x", "b", "void"), ("y", "a", "string"), ("y", "f", "boolean"),
        ("y", "i", "decimal(24,0)"), ("y", "l", "ARRAY<BIGINT>"), ("y", "m", "variant"),
        ("y", "o", "OBJECT<K: BIGINT>"), ("z", "n", "decimal(21,1)")]


def test_incremental_takes_only_newer_rows(spark):
    src = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02"), (3, None)], "id int, ts string")
    src = src.withColumn("ts", F.col("ts").cast("timestamp"))
    assert filters.incremental(src, None, "ts").count() == 3
    assert filters.incremental(src, src.limit(0), "ts").count() == 3
    loaded = src.filter("id = 1")
    assert [r.id for r in filters.incremental(src, loaded, "ts").collect()] == [2]
    ntz = src.withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    assert [r.id for r in filters.incremental(ntz, ntz.filter("id = 1"), "ts").collect()] == [2]


def test_on_day(spark):
    df = spark.createDataFrame([("2024-01-01 23:59:59",), ("2024-01-02 00:00:00",)], "ts string")
    df = df.withColumn("ts", F.col("ts").cast("timestamp"))
    assert filters.on_day(df, "ts", "2024-01-02 08:00:00").count() == 1
