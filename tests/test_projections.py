import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakejobs.functions import classes, clock, text
from lakejobs.operators import projections


def one(spark, value, fn, kind="string"):
    df = spark.createDataFrame([(value,)], f"c {kind}")
    return df.select(fn("c")).first()[0]


@pytest.mark.parametrize("value, want", [
    ("+1 (555) 010", "1555010"), ("n/a", None), ("", None), (None, None),
])
def test_phone_without_digits_is_no_contact(spark, value, want):
    assert one(spark, value, text.phone_digits) == want


@pytest.mark.parametrize("value, want", [
    ("a@b.com", True), ("a@bxcom", False), ("not-an-email", False), (None, None),
    ("a@b.c", False), ("x@y.com trailing", False),
])
def test_email_pattern_keeps_the_dot_literal(spark, value, want):
    assert one(spark, value, text.is_email) is want


@pytest.mark.parametrize("value, want", [
    ("2024-02-29", "2024-02-29"), ("2023-02-29", None), ("junk", None), (None, None),
])
def test_bad_dates_become_null(spark, value, want):
    assert one(spark, value, lambda c: text.iso_date(c).cast("string")) == want


def test_bad_amounts_become_null(spark):
    got = [one(spark, v, lambda c: text.money(c).cast("string")) for v in ("1.5", "x", None)]
    assert got == ["1.50", None, None]
    assert one(spark, "123456789012", text.money) is None


@pytest.mark.parametrize("value, want", [
    ("john.doe@mail.com", "joh***@***.com"), ("ab@mail.com", "***@***.com"),
    ("abc@mail.com", "***@***.com"), (None, None),
])
def test_masking_hides_short_names_whole(spark, value, want):
    assert one(spark, value, text.masked_email) == want


def test_mask_drops_the_raw_address_outside_prod(spark):
    df = spark.createDataFrame([("john@mail.com",)], "email string")
    assert projections.mask_email(df, "dev").columns == ["email_masked"]
    assert projections.mask_email(df, "prod").first().email_masked == "john@mail.com"


def test_normalize_names(spark):
    df = spark.createDataFrame([(1, 2)], ["Sale-ID", "Store Name"])
    assert projections.normalize_names(df).columns == ["sale_id", "store_name"]
    camel = spark.createDataFrame([(1,)], ["saleId"])
    assert projections.normalize_names(camel).columns == ["saleid"]
    assert projections.normalize_names(camel, split_camel=True).columns == ["sale_id"]
    with pytest.raises(ValueError, match="sale_id"):
        projections.normalize_names(spark.createDataFrame([(1, 2)], ["Sale-ID", "sale id"]))


def test_clean_strings_trims_and_blanks(spark):
    df = spark.createDataFrame([(" a ", "  ", 1), (None, "b", 2)], "x string, `y.z` string, n int")
    assert rows(projections.clean_strings(df)) == [(None, "b", 2), ("a", None, 1)]


def test_align_adds_missing_and_keeps_new(spark):
    df = spark.createDataFrame([(1, "x")], "n int, extra string")
    target = T.StructType().add("n", "long").add("gone", "string")
    got = projections.align(df, target)
    assert got.columns == ["n", "gone", "extra"] and got.first() == (1, None, "x")
    assert got.schema["n"].dataType == T.LongType()


def test_clean_customers(spark):
    df = spark.createDataFrame(
        [(" c1", "jOHN", "doe smith", " J@X.Com ", "none", "2024-01-01"),
         ("c2", None, None, None, "1-2", "bad")],
        "customerId string, firstName string, lastName string, emailAddress string,"
        " phoneNumber string, registrationDate string",
    )
    got = {r.customer_id: r for r in projections.clean_customers(df, "2024-04-20").collect()}
    a, b = got["C1"], got["C2"]
    assert (a.full_name, a.email, a.phone, a.customer_age_days, a.customer_segment) == (
        "John Doe Smith", "j@x.com", None, 110, "Regular")
    assert (b.full_name, b.phone, b.customer_age_days, b.customer_segment) == ("", "12", None, "New")


@pytest.mark.parametrize("days, want", [
    (366, "Loyal"), (365, "Regular"), (91, "Regular"), (90, "New"), (None, "New"),
])
def test_tenure_bounds_are_strict(spark, days, want):
    assert one(spark, days, classes.tenure_segment, "int") == want


@pytest.mark.parametrize("value, want", [
    (1000.0, "High Value"), (999.0, "Medium Value"), (500.0, "Medium Value"), (1.0, "Low Value"),
    (None, "No Purchases"),
])
def test_value_segment(spark, value, want):
    assert one(spark, value, classes.value_segment, "double") == want


@pytest.mark.parametrize("last, want", [
    ("2024-01-31", "Active"), ("2024-01-01", "Active"), ("2023-12-31", "Slow Moving"),
    ("2023-11-02", "Slow Moving"), ("2023-11-01", "Inactive"), (None, "Never Sold"),
])
def test_recency_status(spark, last, want):
    df = spark.createDataFrame([(last,)], "d string").select(F.col("d").cast("date").alias("d"))
    status = classes.recency_status("d", clock.day("2024-01-31"))
    assert df.select(status).first()[0] == want


def test_standard_category_keeps_unknown_and_null(spark):
    df = spark.createDataFrame([("Gadgets",), ("Fashion",), ("Home",), ("Toys",), (None,)], "c string")
    got = [r[0] for r in df.select(classes.standard_category("c")).collect()]
    assert got == ["Electronics", "Apparel", "Home & Garden", "Toys", None]


def test_ratio_by_zero_is_null(spark):
    assert spark.range(1).select(classes.ratio(F.lit(1), F.lit(0))).first()[0] is None


def test_row_score_treats_unknown_as_failed(spark):
    df = spark.createDataFrame([(1.0, "a"), (None, "a"), (1.0, None)], "x double, y string")
    rules = [F.col("x") > 0, F.col("y").isNotNull()]
    got = df.select(projections.row_score(*rules), projections.rule_share(*rules)).collect()
    assert [tuple(r) for r in got] == [(100.0, 100.0), (0.0, 50.0), (0.0, 50.0)]


def test_audit_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path)
    got = projections.ingest_audit(spark.read.parquet(path), "b1", "pos", "bronze").collect()
    assert {r.batch_id for r in got} == {"b1"} and all(path in r.source_file for r in got)
    assert all(r.ingestion_timestamp and r.layer == "bronze" for r in got)
