import numpy as np
import pytest
from conftest import plan, rows
from hypothesis import given, settings
from hypothesis import strategies as st

from lakejobs import schemas
from lakejobs.operators import governance
from lakejobs.operators.quantiles import exact_quantiles


def classes_of(spark, **columns):
    data = [(t, c) for t, names in columns.items() for c in names]
    out = governance.classify(spark.createDataFrame(data, "table_name string, column_name string"))
    return {r.table_name: r.classification for r in out.collect()}


def test_classes_and_their_order(spark):
    assert classes_of(
        spark, a=["Email", "PHONE_NO"], b=["email"], c=["home_email", "work_email"],
        d=["patient_id", "email", "phone"], e=["salary", "revenue"], f=["salary"],
        g=["api_key"], h=["email", "phone", "salary", "revenue"], i=["id"],
    ) == {"a": "PII", "b": None, "c": None, "d": "PHI", "e": "FINANCIAL", "f": None,
          "g": "CONFIDENTIAL", "h": "PII", "i": None}


def test_classification_needs_no_join(spark):
    df = spark.createDataFrame([("t", "email")], "table_name string, column_name string")
    assert "Join" not in plan(governance.classify(df))


def test_tags(spark):
    df = spark.createDataFrame(
        [("p", "PHI"), ("f", "FINANCIAL"), ("n", None)], "table_name string, classification string")
    got = {r.table_name: r.tags for r in governance.classification_tags(df, "2024-01-31").collect()}
    assert set(got) == {"p", "f"}
    assert got["p"]["retention_policy"] == "7_YEARS" and got["p"]["encryption_required"] == "true"
    assert got["f"]["retention_policy"] == "10_YEARS" and got["f"]["compliance_required"] == "false"
    assert got["p"]["classification_date"] == "2024-01-31"


def test_summary_lists_every_class(spark):
    df = spark.createDataFrame(
        [("a", "PII"), ("b", "PII"), ("c", None)], "table_name string, classification string")
    assert rows(governance.classification_summary(df)) == sorted([
        ("CONFIDENTIAL", 0, None), ("FINANCIAL", 0, None), ("PHI", 0, None),
        ("PII", 2, "a"), ("PII", 2, "b")])


def test_value_scan(spark):
    df = spark.createDataFrame(
        [("write to a.b@c.org now",), ("123-45-6789 and 10.0.0.1",), ("4111 1111 1111 1111",),
         (None,), ("nothing",)], "text string")
    got = {r.pattern: (r.value_count, r.match_count, r.flagged)
           for r in governance.pii_value_scan({"t": (df, ["text"])}, min_share=20.0).collect()}
    assert got == {"email": (4, 1, True), "ssn": (4, 1, True), "phone": (4, 0, False),
                   "credit_card": (4, 1, True), "ip_address": (4, 1, True)}


def test_value_scan_finds_text_late_in_a_value(spark):
    df = spark.createDataFrame([("x " * 50_000 + "me@mail.com",)], "text string")
    hit = governance.pii_value_scan({"t": (df, ["text"])}).filter("pattern = 'email'").first()
    assert hit.match_count == 1


def quantiles(df, probs):
    return {r.g: tuple(r.q) for r in exact_quantiles(df, "g", "v", probs).collect()}


def test_quantiles_of_many_groups(spark):
    df = spark.range(36_000).selectExpr("id % 12000 as g", "cast(id as double) as v")
    got = exact_quantiles(df, "g", "v", (0.5,)).selectExpr("cast(g as long) as g", "q[0] as q")
    assert got.filter("q = g + 12000").count() == 12_000
    assert governance.outlier_counts(df, "g", "v").agg({"row_count": "sum"}).first()[0] == 36_000


def test_quantiles_of_infinite_and_extreme_values(spark):
    inf = float("inf")
    draw = np.random.default_rng(1)
    groups = {"inf": [1.0, 2.0, 3.0, inf, inf], "both": [-inf, 0.0, inf], "all": [inf, inf],
              "wide": np.exp(draw.normal(0, 60, 300)).tolist()}
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs], "g string, v double")
    got = quantiles(df, (0.25, 0.5))
    assert got["inf"] == (2.0, 3.0) and got["both"][1] == 0.0 and got["all"] == (inf, inf)
    assert got["wide"] == pytest.approx(tuple(np.quantile(groups["wide"], [0.25, 0.5])), rel=1e-12)
    counted = {r.g: r.outlier_count for r in governance.outlier_counts(df, "g", "v").collect()}
    assert counted["all"] == 0


def test_quantiles_match_numpy(spark):
    draw = np.random.default_rng(3)
    groups = {
        "flat": draw.uniform(0, 1, 501), "heavy": np.exp(draw.normal(0, 8, 400)),
        "hot": np.concatenate([np.full(900, 5.0), draw.uniform(0, 1e9, 100)]),
        "same": np.full(10, 2.5), "one": np.array([7.0]),
        # Beyond the rows that are put in order whole: one in many values, one in few, one by a row.
        "many": draw.normal(size=60_000), "tied": draw.integers(0, 4, 20_000).astype(float),
        "edge": draw.normal(size=5_001), "under": draw.normal(size=5_000),
    }
    data = [(g, float(v)) for g, vs in groups.items() for v in vs] + [("flat", None), (None, 1.0)]
    df = spark.createDataFrame(data, "g string, v double").repartition(4)
    probs = (0.0, 0.0004, 0.25, 0.5, 0.75, 0.9999, 1.0)
    got = quantiles(df, probs)
    for g, values in groups.items():
        assert got[g] == pytest.approx(tuple(np.quantile(values, probs)), rel=1e-9)
    assert set(got) == set(groups)


@settings(max_examples=6, deadline=None)
@given(st.lists(st.floats(-1e6, 1e6), min_size=1, max_size=25))
def test_quantiles_of_any_values(spark, values):
    df = spark.createDataFrame([("g", float(v)) for v in values], "g string, v double")
    got = quantiles(df, (0.25, 0.75))["g"]
    assert got == pytest.approx(tuple(np.quantile(values, [0.25, 0.75])), rel=1e-9, abs=1e-9)


def test_outliers_take_few_shuffles(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    text = plan(governance.outlier_counts(df, "event_type", "value"))
    assert text.count("Exchange hashpartitioning") <= 6 and text.count("FileScan") == 3


def test_valid_values(spark):
    good = ["4111 1111 1111 1111", "123-45-6789", "10.0.30.255", "x 5500-0000-0000-0004 y"]
    bad = ["4111 1111 1111 1112", "000-45-6789", "666-45-6789", "912-45-6789", "123-00-6789",
           "123-45-0000", "10.0.300.1", "256.1.1.1", "", None, "no number"]
    df = spark.createDataFrame([(v,) for v in good + bad], "text string")
    got = {r.pattern: tuple(r)[2:] for r in governance.valid_values(
        df, "t", ["text"]).drop("table_name").select("column_name", "pattern", "value_count",
                                                    "match_count", "valid_count").collect()}
    assert got == {"ssn": (14, 6, 1), "credit_card": (14, 3, 2), "ip_address": (14, 3, 1)}
    both = spark.createDataFrame([("1.2.3.4 and 999.1.1.1 and 5.6.7.8",)], "text string")
    row = governance.valid_values(both, "t", ["text"]).filter("pattern = 'ip_address'").first()
    assert (row.match_count, row.valid_count, row.valid_matches) == (1, 1, 2)


def test_outliers(spark):
    data = [("a", float(v)) for v in [1, 2, 3, 4, 5, 100, -90]] + [("b", 1.0), ("b", None)]
    df = spark.createDataFrame(data, "g string, v double")
    assert rows(governance.outlier_counts(df, "g", "v")) == [("a", 7, 0, 2), ("b", 2, 1, 0)]
    empty = spark.createDataFrame([], "g string, v double")
    assert governance.outlier_counts(empty, "g", "v").count() == 0


def test_quality_records(spark):
    df = spark.createDataFrame([(1, 1.0), (1, None), (2, 2.0), (3, 900.0), (4, 1.5), (5, 1.2)], "k int, v double")
    out = governance.quality_metric_records(df, "t", ["k"], "v", "2024-01-01 00:00:00")
    assert out.columns == schemas.QUALITY_METRICS.names
    got = {r.quality_check_name: (r.row_count, r.null_count, r.duplicate_count, r.outlier_count,
                                  r.check_result) for r in out.collect()}
    assert got == {"completeness": (6, 1, 0, 0, "FAILED"), "uniqueness": (6, 0, 1, 0, "FAILED"),
                   "outliers:v": (6, 0, 0, 1, "FAILED")}


def test_lineage_record(spark):
    from datetime import datetime

    row = governance.lineage_record(
        spark, "bronze.s", "silver.s", "clean", "flow", {"sale_id": "saleId"}, "me@x.org", 99.0,
        "l1", datetime(2024, 1, 1)).first()
    assert row.column_mapping == {"sale_id": "saleId"} and row.target_table == "silver.s"


def test_catalog_frame(spark):
    frame = governance.catalog_frame(spark, {"t": spark.range(1).toDF("email")})
    assert rows(frame) == [("t", "email")]
