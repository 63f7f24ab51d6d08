import json
import os
import time

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from lakejobs.operators import gold, projections, quality, tables
from lakejobs.paths import LakePaths
from lakejobs.plans import incremental_gold, streaming_medallion
from lakejobs.plans.together import together
from lakejobs.session import LEAN_CONF, lean
from lakejobs.streaming import ingest
from lakejobs.streaming.keys import KeyStore
from lakejobs.streaming.silver import read_silver, silver, stream_silver

SALES = [
    {"saleId": " s1", "customerId": "c1", "productId": "p1", "saleAmount": 10.0, "saleDate": "2024-01-01"},
    {"saleId": "S1", "customerId": "c1", "productId": "p1", "saleAmount": -1.0, "saleDate": "2024-01-01"},
    {"saleId": "s2", "customerId": None, "productId": "p1", "saleAmount": 5.0, "saleDate": "2024-01-01"},
    {"saleId": "s3", "customerId": "c2", "productId": "p9", "saleAmount": 7.5, "saleDate": "bad"},
    {"saleId": None, "customerId": "c2", "productId": "p2", "saleAmount": 1.5, "saleDate": "2024-01-02"},
    {"saleId": None, "customerId": "c2", "productId": "p2", "saleAmount": 2.5, "saleDate": "2024-01-02"},
]


def put_json(folder, name, records):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(r) for r in records))


def load(spark, src, lake, batch="b"):
    df = ingest.ingest_stream(spark, str(src), "json", lake.schema("s"), batch)
    ingest.start_table(df, lake.bronze("s"), lake.checkpoint("s"), ["batch_id"]).awaitTermination()
    return ingest.register_records(spark, lake.bronze("s"), lake.schema("s"))


def read(spark, lake):
    return ingest.read_records(spark, lake.bronze("s"), lake.schema("s"))


def records(spark, lake, schema):
    """Bronze records as a stream of typed columns."""
    stream = spark.readStream.schema(ingest.RECORDS).parquet(lake.bronze("s"))
    return ingest.drawn(stream, schema)


def test_json_ingest_is_incremental_and_grows(spark, tmp_path):
    lake, src = LakePaths(str(tmp_path / "lake")), tmp_path / "in"
    put_json(src, "a.json", [{"id": 1, "v": "x"}])
    load(spark, src, lake, "b1")
    load(spark, src, lake, "b2")
    assert read(spark, lake).count() == 1
    put_json(src, "b.json", [{"id": 2, "extra": 1.5}, {"id": "oops"}])
    load(spark, src, lake, "b3")
    got = {r.id: r for r in read(spark, lake).collect()}
    assert got[1].extra is None and got[2].extra == 1.5 and got[2].v is None
    assert got[None]._corrupt_record == '{"id":"oops"}'
    assert got[1].batch_id == "b1" and got[2].batch_id == "b3"
    assert got[1].source_file.endswith("a.json")
    stored = ingest.stored_schema(spark, lake.schema("s"))
    assert stored.names == ["id", "v", "extra"] and stored["id"].dataType.simpleString() == "bigint"


def test_schema_looks_at_changed_files_only(spark, tmp_path):
    src, registry = tmp_path / "in", str(tmp_path / "schema")
    put_json(src, "a.json", [{"id": 1}])
    os.utime(src / "a.json", (1_600_000_000, 1_600_000_000))
    assert ingest.register_schema(spark, str(src), "json", registry).names == ["id"]
    assert ingest.register_schema(spark, str(src), "json", registry).names == ["id"]
    put_json(src, "b.json", [{"late": 1}])
    os.utime(src / "b.json", (1_600_000_000, 1_600_000_000))
    assert ingest.unseen_files(spark, str(src), registry).count() == 1
    # A file that arrives with an old time gives its columns all the same.
    got = ingest.register_schema(spark, str(src), "json", registry)
    assert got.names == ["id", "late"]
    assert ingest.unseen_files(spark, str(src), registry).count() == 0
    put_json(src, "c.json", [{"id": 2, "new": "x"}])
    assert ingest.register_schema(spark, str(src), "json", registry).names == ["id", "late", "new"]


def test_csv_and_parquet_ingest(spark, tmp_path):
    lake = LakePaths(str(tmp_path / "lake"))
    (tmp_path / "csv").mkdir()
    (tmp_path / "csv" / "a.csv").write_text("id,name\n1,x\n2,\n")
    df = ingest.ingest_stream(spark, str(tmp_path / "csv"), "csv", lake.schema("c"), "b")
    ingest.start_table(df, lake.bronze("c"), lake.checkpoint("c")).awaitTermination()
    assert rows(spark.read.parquet(lake.bronze("c")).select("id", "name")) == [("1", "x"), ("2", None)]
    spark.range(3).write.parquet(str(tmp_path / "pq"))
    df = ingest.ingest_stream(spark, str(tmp_path / "pq"), "parquet", lake.schema("p"), "b", "erp", 1)
    ingest.start_table(df, lake.bronze("p"), lake.checkpoint("p"), ["batch_id"]).awaitTermination()
    got = spark.read.parquet(lake.bronze("p"))
    assert got.count() == 3 and {r.source_system for r in got.collect()} == {"erp"}


def test_csv_with_other_columns_fails(spark, tmp_path):
    lake = LakePaths(str(tmp_path / "lake"))
    (tmp_path / "csv").mkdir()
    (tmp_path / "csv" / "a.csv").write_text("id,name\n1,x\n")
    ingest.register_schema(spark, str(tmp_path / "csv"), "csv", lake.schema("c"))
    (tmp_path / "csv" / "a.csv").write_text("name,id\nx,1\n")
    df = ingest.ingest_stream(spark, str(tmp_path / "csv"), "csv", lake.schema("c"), "b")
    query = ingest.start_table(df, lake.bronze("c"), lake.checkpoint("c"))
    with pytest.raises(Exception):
        query.awaitTermination()


def test_batch_and_stream_give_the_same_silver(spark, tmp_path):
    lake, src = LakePaths(str(tmp_path / "lake")), tmp_path / "in"
    put_json(src, "a.json", SALES[:3])
    put_json(src, "b.json", SALES[3:])
    schema = load(spark, src, lake)
    keys = ["sale_id", "sale_date"]
    bronze = records(spark, lake, schema)
    stream_silver(bronze, lake.silver("s"), lake.checkpoint("silver"), projections.clean_sales,
                  quality.SALES_RULES, keys).awaitTermination()
    columns = [*keys, "customer_id", "product_id", "sale_amount", "data_quality_score"]
    streamed = spark.read.parquet(lake.silver("s")).select(columns)
    batch = silver(read(spark, lake), projections.clean_sales,
                   quality.SALES_RULES, keys).select(columns)
    assert rows(streamed) == rows(batch)
    # the invalid twin of S1 does not displace the valid one, and NULL ids do not merge
    assert [(r.sale_id, float(r.sale_amount)) for r in batch.orderBy("sale_amount").collect()] == [
        (None, 1.5), (None, 2.5), ("S1", 10.0)]


def test_dedup_state_survives_a_restart(spark, tmp_path):
    lake, src = LakePaths(str(tmp_path / "lake")), tmp_path / "in"

    def refresh():
        schema = load(spark, src, lake)
        bronze = records(spark, lake, schema)
        stream_silver(bronze, lake.silver("s"), lake.checkpoint("silver"), projections.clean_sales,
                      quality.SALES_RULES, ["sale_id", "sale_date"]).awaitTermination()

    put_json(src, "a.json", SALES[:1])
    refresh()
    put_json(src, "b.json", [{**SALES[0], "note": "again"}, {**SALES[0], "saleId": "new"}])
    refresh()
    got = read_silver(spark, lake.silver("s"))
    assert rows(got.select("sale_id")) == [("NEW",), ("S1",)]
    # A column of the second run is a column of the table.
    assert rows(got.select("sale_id", "note")) == [("NEW", None), ("S1", None)]
    put_json(src, "c.json", [{**SALES[0], "saleId": "s9", "note": "kept"}])
    refresh()
    got = read_silver(spark, lake.silver("s"))
    assert rows(got.select("sale_id", "note")) == [("NEW", None), ("S1", None), ("S9", "kept")]
    with pytest.raises(ValueError, match="watermark"):
        schema = ingest.stored_schema(spark, lake.schema("s"))
        silver(records(spark, lake, schema), projections.clean_sales, (), ["sale_id"])


def test_watermark_bounds_the_state(spark, tmp_path):
    src, out = tmp_path / "in", str(tmp_path / "out")
    put_json(src, "a.json", SALES[:2] + SALES[4:])
    stream = spark.readStream.schema(spark.read.json(str(src)).schema).json(str(src))
    df = silver(stream, lambda d: projections.clean_sales(d), quality.SALES_RULES,
                ["sale_id", "sale_date"], ("processed_timestamp", "1 day"))
    assert "DeduplicateWithinWatermark" in df._jdf.queryExecution().analyzed().toString()
    ingest.start_table(df, out, str(tmp_path / "ck")).awaitTermination()
    assert spark.read.parquet(out).count() == 3


def test_streaming_medallion(spark, tmp_path):
    lake = LakePaths(str(tmp_path / "lake"))
    landing = {n: str(tmp_path / "landing" / n) for n in streaming_medallion.SOURCES}
    put_json(tmp_path / "landing" / "sales", "a.json", SALES)
    (tmp_path / "landing" / "customers").mkdir()
    (tmp_path / "landing" / "customers" / "a.csv").write_text(
        "customerId,firstName,lastName,emailAddress,phoneNumber,registrationDate\n"
        "c1,ann,lee,Ann@Mail.com,1-2,2020-01-01\nc2,bob,,bad,,2024-01-01\n")
    spark.createDataFrame(
        [("p1", "Phone", "gadgets", 9.0, "d"), (" p2 ", "Shirt", "fashion", 5.0, "d"), ("p3", None, "x", 1.0, "d")],
        "productId string, productName string, categoryName string, productPrice double, productDescription string",
    ).write.parquet(landing["products"])
    metrics = streaming_medallion.run(spark, landing, lake, "b1", as_of="2024-01-31")
    got = {r.table_name: (r.layer, r.total_rows) for r in metrics.collect()}
    assert got == {"bronze_sales_raw": ("bronze", 6), "silver_sales_cleaned": ("silver", 3),
                   "gold_sales_analytics": ("gold", 2)}
    silver = spark.read.parquet(lake.silver("customers"))
    assert "email" not in silver.columns and "email_masked" in silver.columns
    assert "_corrupt_record" not in spark.read.parquet(lake.silver("sales")).columns
    customers = tables.read(spark, lake.gold("customer_360"))
    assert "email" not in customers.columns
    row = customers.first()
    assert (row.customer_id, row.email_masked, row.lifetime_value) == ("C1", "***@***.com", 10)
    products = tables.read(spark, lake.gold("product_performance"))
    assert {r.product_id: r.category_standardized for r in products.collect()} == {
        "P1": "Electronics", "P2": "Apparel"}
    # nothing new: a second run changes nothing
    again = streaming_medallion.run(spark, landing, lake, "b2", as_of="2024-01-31")
    assert {r.table_name: r.total_rows for r in again.collect()} == {k: v[1] for k, v in got.items()}


def test_gold_on_a_stream_is_refused(spark, tmp_path):
    """Distinct counts need batch input, which is why gold is rebuilt in batch."""
    put_json(tmp_path / "in", "a.json", SALES[:1])
    stream = spark.readStream.schema(spark.read.json(str(tmp_path / "in")).schema).json(str(tmp_path / "in"))
    with pytest.raises(Exception):
        agg = stream.groupBy("productId").agg(F.countDistinct("customerId"))
        ingest.start_table(agg, str(tmp_path / "o"), str(tmp_path / "c")).awaitTermination()


def test_lines_that_do_not_fit_go_to_quarantine(spark, tmp_path):
    lake, src = LakePaths(str(tmp_path / "lake")), tmp_path / "sales"
    put_json(src, "a.json", [dict(SALES[0])])
    load(spark, src, lake, "b0")
    (src / "b.json").write_text('{"saleId": "S9", "saleAmount": "many"}\nno json\n\n[1]\n')
    load(spark, src, lake, "b1")
    bronze = read(spark, lake)
    whole = bronze.filter("_corrupt_record IS NULL")
    assert bronze.count() == 4 and whole.count() == 1
    assert {r._corrupt_record for r in bronze.collect()} == {
        None, '{"saleAmount":"many","saleId":"S9"}', "no json", "[1]"}
    out = silver(bronze, projections.clean_sales, (), ["sale_id"])
    assert out.count() == 1 and "_corrupt_record" not in out.columns
    row = quality.table_metrics(whole, "t", "bronze").first()
    assert row.null_percentage == 0 and row.status == "PASSED"


def test_a_column_that_lands_late_is_kept(spark, tmp_path):
    """A file may land at any time; its columns are there once its records are."""
    lake, src = LakePaths(str(tmp_path / "lake")), tmp_path / "in"
    put_json(src, "a.json", [{"id": 1, "whole": 3}])
    df = ingest.ingest_stream(spark, str(src), "json", lake.schema("s"), "b1")
    put_json(src, "b.json", [{"id": 2, "late": {"x": [1, 2.5]}, 'odd " name': "q", "it's": 1, "\"'": 2,
                             "a.b[0]": 5, "why?": 1, "whole": 3.5}])
    ingest.start_table(df, lake.bronze("s"), lake.checkpoint("s"), ["batch_id"]).awaitTermination()
    got = {r.id: r for r in read(spark, lake).collect()}
    assert got[2].late.x == [1.0, 2.5] and got[1].late is None and got[2]['odd " name'] == "q"
    assert got[2]["it's"] == 1 and got[2]["a.b[0]"] == 5
    assert not {"\"'", "why?"} & set(ingest.stored_schema(spark, lake.schema("s")).names)
    assert ingest.stored_schema(spark, lake.schema("s"))["whole"].dataType.simpleString() == "double"
    # A type that is stored stays; what does not fit it is kept beside it.
    put_json(src, "c.json", [{"id": 3.25, "late": None}, {"id": 4.0, "whole": "1e3"}])
    load(spark, src, lake, "b2")
    got = {r.id: r for r in read(spark, lake).filter("batch_id = 'b2'").collect()}
    assert got[4].whole == 1000.0 and got[4]._corrupt_record is None
    assert got[None]._corrupt_record == '{"id":3.25,"late":null}'


def test_copies_over_three_runs(spark, tmp_path):
    """Of differing copies the first to arrive stays, then the first by a given order."""
    lake, src = LakePaths(str(tmp_path / "lake")), tmp_path / "in"
    order = [F.desc("sale_amount"), F.asc("product_id")]
    landed = []
    for run in range(3):
        wave = []
        for key in range(12):
            for copy in range((key * 7 + run * 5) % 4):
                wave.append({"saleId": f"s{key}" if key else None, "customerId": "c",
                             "productId": f"p{copy}", "saleAmount": 10.0 * run + (copy * 3) % 4 + 0.5,
                             "saleDate": "2024-01-01"})
        wave += wave[:2] + [{**SALES[0], "saleId": None, "saleAmount": 1.5}]
        landed.append(wave)
        put_json(src, f"{run}.json", wave)
        schema = load(spark, src, lake, f"b{run}")
        stream_silver(records(spark, lake, schema), lake.silver("s"), lake.checkpoint("silver"),
                      projections.clean_sales, quality.SALES_RULES, ["sale_id", "sale_date"],
                      order_by=order).awaitTermination()
    columns = ["sale_id", "product_id", "sale_amount", "batch_id"]
    streamed = read_silver(spark, lake.silver("s")).select(columns)
    batch = silver(read(spark, lake), projections.clean_sales, quality.SALES_RULES,
                   ["sale_id", "sale_date"], order_by=[F.asc("batch_id"), *order]).select(columns)
    assert rows(streamed) == rows(batch)
    nulls = sum(r["saleId"] is None for wave in landed for r in wave)
    assert streamed.filter("sale_id IS NULL").count() == nulls > 3


def test_a_micro_batch_that_runs_again(spark, tmp_path):
    """A batch that died behind its keys finds its own keys and still writes its rows."""
    from pyspark.sql import types as T

    fields = [T.StructField("k", T.StringType())]
    store = KeyStore(spark, str(tmp_path / "keys"), fields, buckets=4)
    first = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    assert store.unseen(first, 0).count() == 3
    store.add(first, 0)
    assert store.unseen(first, 0).count() == 3  # again under its own number
    again = KeyStore(spark, str(tmp_path / "keys"), fields, buckets=99)
    assert again.buckets == 4
    more = spark.createDataFrame([("a",), ("c",), (None,)], "k string")
    assert rows(again.unseen(more, 1)) == [(None,), ("c",)]
    with pytest.raises(ValueError):
        KeyStore(spark, str(tmp_path / "keys"), [T.StructField("k", T.LongType())])
    # Only the micro-batch is shuffled; the store is read where it lies.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(again.unseen(more.repartition(3), 1))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "LeftAnti" in text and "Bucketed: true" in text
    assert text.count("hashpartitioning(k") == 1


def test_gold_is_added_to(spark, tmp_path):
    """Runs over new sales alone give what a full recompute gives, attributes that come late too."""
    lake = LakePaths(str(tmp_path / "lake"))
    sales_schema = "sale_id string, sale_date date, customer_id string, product_id string, sale_amount decimal(10,2)"
    waves = [
        [("s1", "c1", "p1", "5.00", 1), ("s2", "c2", "p1", "7.50", 1), ("s3", None, "p2", None, 1)],
        [("s4", "c1", "p1", "1.25", 1), ("s5", "c3", "p2", "2.00", 2), ("s6", "c1", None, "3.00", 2)],
        [],
        [("s7", "c9", "p9", "4.00", 2), ("s8", "c2", "p1", "7.50", 1)],
    ]
    dims = [(["c1"], ["p1"]), (["c1", "c2"], ["p1"]), (["c1", "c2", "c3"], ["p1", "p2"]),
            (["c1", "c2", "c3"], ["p1", "p2", "p9"])]
    reads = []
    for epoch, (wave, (cs, ps)) in enumerate(zip(waves, dims, strict=True)):
        frame = spark.createDataFrame(
            [(s, d, c, p, a) for s, c, p, a, d in wave], "a string, d int, c string, p string, m string"
        ).selectExpr("a as sale_id", "date_add(date'2024-01-01', d) as sale_date", "c as customer_id",
                     "p as product_id", "cast(m as decimal(10,2)) as sale_amount")
        frame.write.parquet(f"{lake.silver('sales')}/_epoch={epoch}")
        customers = spark.createDataFrame([(c, f"seg{c[1]}") for c in cs], "customer_id string, customer_segment string")
        products = spark.createDataFrame([(p, "cat") for p in ps], "product_id string, category_standardized string")

        def after(epoch):
            reads.append(epoch)
            return read_silver(spark, lake.silver("sales"), epoch)

        got = incremental_gold.refresh(spark, lake, after, epoch, customers, products, "2024-02-01")
        whole = read_silver(spark, lake.silver("sales"))
        want = {"sales_analytics": gold.sales_analytics(whole, customers, products),
                "customer_360": gold.customer_360(whole, customers),
                "product_performance": gold.product_performance(whole, products, "2024-02-01")}
        for name, df in want.items():
            assert got[name].schema.simpleString() == df.schema.simpleString()
            assert rows(got[name].select(df.columns)) == rows(df), (epoch, name)
    assert reads == [None, 0, 1, 2]
    text = plan(read_silver(spark, lake.silver("sales"), 2))
    assert "PartitionFilters: [isnotnull(_epoch" in text


def test_a_gold_run_that_dies_is_done_over(spark, tmp_path, monkeypatch):
    lake = LakePaths(str(tmp_path / "lake"))
    sale = "'s{0}' as sale_id, date'2024-01-01' as sale_date, 'c' as customer_id, 'p' as product_id, cast({0} as decimal(10,2)) as sale_amount"
    customers = spark.sql("select 'c' as customer_id, 'x' as customer_segment")
    products = spark.sql("select 'p' as product_id, 'y' as category_standardized")

    def after(epoch):
        return read_silver(spark, lake.silver("sales"), epoch)

    for epoch in range(2):
        spark.sql(f"select {sale.format(epoch + 1)}").write.parquet(f"{lake.silver('sales')}/_epoch={epoch}")
        with monkeypatch.context() as patched:
            patched.setattr(tables, "few_rows", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
            with pytest.raises(RuntimeError, match="lost"):
                incremental_gold.refresh(spark, lake, after, epoch, customers, products)
        got = incremental_gold.refresh(spark, lake, after, epoch, customers, products)
    row = got["sales_analytics"].first()
    assert (row.transaction_count, float(row.total_sales), row.unique_customers) == (2, 3.0, 1)


def test_columns_of_records_are_found_without_a_search_by_pattern(spark, tmp_path):
    """A pattern over the path of a file, asked on every row, took half of a streaming flow."""
    names = spark.createDataFrame([("file:/a/batch_id=b 1/p.parquet",), ("a/b",)], "p string")
    found = names.select(ingest._folder("p").alias("folder"))
    assert [r.folder for r in found.collect()] == ["batch_id=b 1", "a"]
    assert "regexp" not in plan(found)
    put_json(tmp_path / "in", "a.json", SALES)
    stream = ingest.record_stream(spark, str(tmp_path / "in"), "b")
    assert "schema_of_variant" not in stream._jdf.queryExecution().analyzed().toString()


def refined(spark, tmp_path, lake, records, batch):
    """Land records of sales and take them to silver and quarantine."""
    put_json(tmp_path / "sales", f"{batch}.json", records)
    schemas = streaming_medallion.ingest(spark, {"sales": str(tmp_path / "sales")}, lake, batch)
    streaming_medallion.refine(spark, schemas, lake)


def test_batches_that_fit_are_not_read_for_the_quarantine(spark, tmp_path):
    """Batches in which every value fits are skipped; one with a misfit is read, early or late."""
    lake = LakePaths(str(tmp_path / "lake"))
    stream = spark.readStream.schema(ingest.RECORDS)
    taken = []
    for batch, records, fits in (
            ("b1", SALES, True),
            ("b2", [{**SALES[0], "saleId": "s7", "saleAmount": "many"}], False),
            ("b3", [{**SALES[0], "saleId": "s8", "saleAmount": 3}], False),  # whole, not told by type
            ("b4", [{**SALES[0], "saleId": "s9", "new": True}], True),
            ("b5", [{**SALES[0], "saleId": "s10", "new": "no truth"}], False)):
        refined(spark, tmp_path, lake, records, batch)
        df = ingest.misfits(spark, stream.parquet(lake.bronze("sales")), lake.schema("sales"))
        asked = ingest.misfits(spark, spark.read.schema(ingest.RECORDS).parquet(lake.bronze("sales")),
                               lake.schema("sales"))
        assert df.isStreaming and (asked.filter(F.col("batch_id") == batch).count() == 0) == fits
        taken.append(sorted(r.batch_id for r in spark.read.parquet(lake.quarantine("sales")).collect()))
        assert "PartitionFilters: [(isnull(batch_id" in plan(asked) or not fits
    assert taken == [[], ["b2"], ["b2"], ["b2"], ["b2", "b5"]]
    # A line that is no JSON comes again under the id of a batch that fitted before.
    (tmp_path / "sales" / "late.json").write_text("no json\n")
    schemas = streaming_medallion.ingest(spark, {"sales": str(tmp_path / "sales")}, lake, "b4")
    streaming_medallion.refine(spark, schemas, lake)
    found = spark.read.parquet(lake.quarantine("sales")).collect()
    assert sorted(r.batch_id for r in found) == ["b2", "b4", "b5"]
    assert "no json" in {r._corrupt_record for r in found}


def test_gold_state_is_grouped_in_one_shuffle(spark, tmp_path):
    """Pairs and sets hardly repeat: new sales and state meet in one grouping, sales are joined once."""
    from lakejobs.operators import partials

    sales = spark.sql("""select 's' as sale_id, date'2024-01-01' as sale_date, 'c' as customer_id,
        'p' as product_id, cast(1.5 as decimal(10,2)) as sale_amount from range(3)""")
    pair = ["customer_id", "product_id"]
    old = partials.sums(sales, pair)
    old.write.parquet(str(tmp_path / "old"))
    old = spark.read.parquet(str(tmp_path / "old"))
    both = partials.added_sums(sales, [old], pair)
    assert plan(both).count("hashpartitioning") == 1
    assert both.schema.simpleString() == old.schema.simpleString()
    row = both.first()
    assert (row.n, row.amounts, float(row.total), float(row.low)) == (6, 6, 9.0, 1.5)
    sets = partials.values(sales, ["sale_date"], pair)
    merged = partials.merged_sets([sets, partials.merged_sets([sets])])
    assert rows(merged.select("column", "value")) == [("customer_id", "c"), ("product_id", "p")]


def shuffled(spark):
    """Names of the shuffle files that lie on disk."""
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = disk.getAllFiles().iterator()
    found = set()
    while files.hasNext():
        name = files.next().getName()
        if name.startswith("shuffle_"):
            found.add(name)
    return found


def put_silver(spark, lake, first, last):
    """Silver sales of one micro-batch, with customers and products."""
    sales = spark.range(first, last).selectExpr(
        "concat('S', id) as sale_id", "date'2024-01-01' + cast(id % 3 as int) as sale_date",
        "concat('C', id % 5) as customer_id", "concat('P', id % 7) as product_id",
        "cast(id + 0.5 as decimal(10,2)) as sale_amount")
    sales.write.parquet(f"{lake.silver('sales')}/_epoch={first}")
    spark.range(5).selectExpr(
        "concat('C', id) as customer_id", "'a' as first_name", "'b' as last_name",
        "'x***' as email_masked", "'1' as phone", "'New' as customer_segment",
    ).write.mode("overwrite").parquet(lake.silver("customers"))
    spark.range(7).selectExpr(
        "concat('P', id) as product_id", "'n' as product_name", "'k' as category_standardized",
        "1.0 as price").write.mode("overwrite").parquet(lake.silver("products"))


def test_shuffle_files_leave_with_their_write(spark, tmp_path):
    lake = LakePaths(str(tmp_path / "lake"))
    put_silver(spark, lake, 0, 40)
    before = shuffled(spark)
    streaming_medallion.build_gold(spark, lake, "2024-02-01")
    until = time.time() + 5  # they are deleted behind the scenes
    while shuffled(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffled(spark) - before
    assert tables.read(spark, lake.gold("customer_360")).count() == 5


def test_streams_write_by_the_settings_of_the_flow(spark, tmp_path):
    lake = LakePaths(str(tmp_path / "lake"))
    put_json(tmp_path / "in", "a.json", SALES)
    before = {key: spark.conf.get(key, None) for key in LEAN_CONF}
    landing = {"sales": str(tmp_path / "in")}
    schemas = streaming_medallion.ingest(spark, landing, lake, "b1")
    streaming_medallion.refine(spark, schemas, lake)
    for path in (lake.bronze("sales"), lake.silver("sales")):
        files = [f for _, _, names in os.walk(path) for f in names if f.endswith(".parquet")]
        assert files and all(f.endswith(".zstd.parquet") for f in files)
    assert {key: spark.conf.get(key, None) for key in LEAN_CONF} == before
    with pytest.raises(ZeroDivisionError), lean(spark):
        1 / 0
    assert {key: spark.conf.get(key, None) for key in LEAN_CONF} == before


def test_gold_state_is_written_in_turn(spark, tmp_path, monkeypatch):
    """Sets and pairs, which shuffle most, are not written at once; joined sales leave before the pairs."""
    lake = LakePaths(str(tmp_path / "lake"))
    put_silver(spark, lake, 0, 40)
    state, turns = tmp_path / "lake" / "_state", []

    def one_by_one(*steps):
        turns.append((len(steps), (state / "marked" / "run-0").exists()))
        return together(*steps)

    monkeypatch.setattr(incremental_gold, "together", one_by_one)
    streaming_medallion.build_gold(spark, lake, "2024-02-01")
    assert turns == [(2, True), (1, True), (1, False)]
    got = tables.read(spark, lake.gold("sales_analytics")).agg(F.sum("transaction_count"), F.sum("total_sales"))
    assert [float(x) for x in got.first()] == [40, 800]


def test_rows_are_staged_between_deduplication_and_key_store(spark, tmp_path):
    """Two shuffles of a micro-batch do not lie on disk at once; the first one meets an empty store."""
    src, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))
    schema = "sale_id string, sale_date date, customer_id string, sale_amount decimal(10,2)"
    staged = []

    def run():
        stream = spark.readStream.schema(schema).parquet(src)
        stream_silver(stream, target, checkpoint, lambda df: df, (), ["sale_id", "sale_date"]).awaitTermination()

    put = KeyStore.unseen

    def unseen(self, rows, epoch):
        staged.append([os.path.basename(os.path.dirname(f)) for f in rows.inputFiles()][:1])
        return put(self, rows, epoch)

    KeyStore.unseen = unseen
    try:
        for ids in ("1), (2), (2", "2), (3), (null", "null), (4), (1"):
            spark.sql(f"""select concat('S', id) as sale_id, date'2024-01-01' as sale_date, 'c' as customer_id,
                cast(1 as decimal(10,2)) as sale_amount from values ({ids}) as t(id)""").write.mode("append").parquet(src)
            run()
    finally:
        KeyStore.unseen = put
    assert staged == [["check_staged"]] * 2 and not (tmp_path / "check_staged").exists()
    got = [r.sale_id for r in read_silver(spark, target).collect()]
    assert sorted(map(str, got)) == ["None", "None", "S1", "S2", "S3", "S4"]


def test_pairs_of_one_sale_hold_its_amount_once(spark):
    pairs = spark.sql("""select customer_id, n, amounts, cast(total as decimal(20,2)) as total,
        cast(low as decimal(10,2)) as low, cast(high as decimal(10,2)) as high,
        cast(first as date) as first, cast(last as date) as last from values
        ('one', 1, 1, 5.25, 5.25, 5.25, '2024-01-01', '2024-01-01'),
        ('two', 2, 2, 7.00, 3.00, 4.00, '2024-01-01', '2024-01-02'),
        ('same', 2, 2, 6.00, 3.00, 3.00, '2024-01-02', '2024-01-02'),
        ('zero', 2, 2, 0.00, -1.00, 1.00, '2024-01-02', '2024-01-03'),
        ('nothing', 1, 0, null, null, null, '2024-01-02', '2024-01-02'),
        ('overflow', 2, 2, null, 3.00, 3.00, null, null)
        as t(customer_id, n, amounts, total, low, high, first, last)""")
    packed = incremental_gold.packed(pairs)
    held = {r.customer_id: (r.low, r.high, r.last) for r in packed.collect()}
    assert held["one"] == held["nothing"] == (None, None, None)
    assert float(held["overflow"][0]) == float(held["same"][0]) == 3 and held["same"][1:] == (None, None)
    assert None not in held["two"] and None not in held["zero"]
    back = incremental_gold.unpacked(packed)
    assert back.schema.simpleString() == pairs.schema.simpleString() and rows(back) == rows(pairs)
    assert rows(incremental_gold.unpacked(pairs)) == rows(pairs)  # state from before
