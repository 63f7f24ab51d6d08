import pytest
from conftest import SMALL, plan, rows
from pyspark.sql import functions as F

from lakejobs import schemas
from lakejobs.operators import retention, tables
from lakejobs.operators.governance import access_by_day


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "table")


def frame(spark, data, schema="id int, v string"):
    return spark.createDataFrame(data, schema)


def test_overwrite_is_idempotent(spark, path):
    assert not tables.exists(spark, path)
    for _ in range(2):
        assert tables.write(frame(spark, [(1, "a")]), path) == 1
    assert rows(tables.read(spark, path)) == [(1, "a")]
    with pytest.raises(ValueError, match="unknown mode"):
        tables.write(frame(spark, []), path, "upsert")


def test_append_merges_columns(spark, path):
    assert tables.append(frame(spark, [(1, "a")]), path) == 1
    tables.append(frame(spark, [(2, 7)], "id bigint, n int"), path)
    got = tables.read(spark, path)
    assert got.schema["id"].dataType.simpleString() == "int"
    assert rows(got.select("id", "v", "n")) == [(1, "a", None), (2, None, 7)]
    with pytest.raises(ValueError, match="columns differ"):
        tables.append(frame(spark, [(1,)], "x int"), path, merge_schema=False)


def test_empty_tables(spark, path):
    assert tables.write(frame(spark, []), path) == 0
    assert tables.exists(spark, path) and rows(tables.read(spark, path)) == []
    assert tables.file_sizes(tables.read(spark, path)).first().num_rows == 0
    assert rows(tables.upsert(frame(spark, []), frame(spark, [(1, "a")]), ["id"])) == [(1, "a")]
    assert rows(tables.diff(frame(spark, []), frame(spark, []), ["id"])) == []


def test_a_load_run_again_replaces_its_rows(spark, path):
    loads = "id int, v string, load string"
    tables.write(frame(spark, [(1, "a", "007"), (2, "b", "007")], loads), path, "replace", ["load"])
    for _ in range(2):
        tables.write(frame(spark, [(3, "c", "008")], loads), path, "replace", ["load"])
    got = tables.read(spark, path, "load")
    assert rows(got) == [(1, "a", "007"), (2, "b", "007"), (3, "c", "008")]
    first = tables.up_to(got, "load", "007")
    assert rows(first.select("id")) == [(1,), (2,)] and "PartitionFilters: [isnotnull(load" in plan(first)
    assert rows(tables.load_sizes(got, "load")) == [("007", 2, 2), ("008", 1, 3)]
    sizes = tables.file_sizes(got).first()
    assert sizes.num_rows == 3 and sizes.num_files >= 2 and sizes.size_bytes > 0


def test_update(spark):
    df = frame(spark, [(1, "x"), (2, None), (3, "y"), (3, "x")])
    got = tables.update(df, F.col("v") == "x", {"v": F.lit("VIP")})
    assert rows(got) == [(1, "VIP"), (2, None), (3, "VIP"), (3, "y")]


def test_upsert(spark):
    target = frame(spark, [(1, "a"), (2, "b"), (None, "n"), (3, "c")])
    updates = frame(spark, [(2, "B"), (4, "D"), (None, "N")], "id bigint, v string")
    once = tables.upsert(target, updates, ["id"])
    want = rows(frame(spark, [(1, "a"), (2, "B"), (3, "c"), (4, "D"), (None, "n"), (None, "N")]))
    assert rows(once) == want
    known = updates.dropna()
    again = tables.upsert(tables.upsert(target, known, ["id"]), known, ["id"])
    assert rows(again) == rows(tables.upsert(target, known, ["id"]))
    text = plan(tables.upsert(target, updates, ["id"]))
    assert len([line for line in text.splitlines() if "Join" in line and "[id" in line]) == 2


def test_upsert_keeps_columns_it_does_not_have(spark):
    target = frame(spark, [(1, "a", 10)], "id int, v string, n int")
    updates = frame(spark, [(1, 11, True), (2, 12, False)], "id int, n int, flag boolean")
    assert rows(tables.upsert(target, updates, ["id"])) == [(1, "a", 11, True), (2, None, 12, False)]


def test_two_updates_for_one_key_are_refused(spark):
    tables.require_unique(frame(spark, [(1, "x"), (None, "y"), (None, "z")]), ["id"])
    with pytest.raises(ValueError, match="two updates"):
        tables.require_unique(frame(spark, [(1, "x"), (1, "y")]), ["id"])


def test_small_updates_leave_the_target_in_place(spark):
    target = spark.range(100_000).selectExpr("cast(id as int) id", "'v' v")
    updates = frame(spark, [(1, "x")])
    assert "BroadcastHashJoin [id" in plan(tables.upsert(target, updates, ["id"]))


def test_even_files_put_small_ones_together(spark, path):
    tables.write(spark.range(2000).repartition(16), f"{path}/small")
    small = tables.read(spark, f"{path}/small")
    assert tables.file_sizes(small).first().num_files == 16
    tables.write(small, f"{path}/even", even_files=True)
    even = tables.read(spark, f"{path}/even")
    assert tables.file_sizes(even).first().num_files < 4 and rows(even) == rows(small)


def test_diff_finds_every_change(spark):
    old = frame(spark, [(1, "a"), (2, "b"), (3, None), (4, "d"), (5, None)])
    new = frame(spark, [(1, "a"), (2, "B"), (3, "c"), (4, None), (6, "f"), (5, None)])
    assert rows(tables.diff(old, new, ["id"])) == sorted([
        ("update_pre", 2, "b"), ("update_post", 2, "B"), ("update_pre", 3, None),
        ("update_post", 3, "c"), ("update_pre", 4, "d"), ("update_post", 4, None),
        ("insert", 6, "f"),
    ], key=lambda t: [(v is not None, str(v)) for v in t])
    assert tables.diff(old, old, ["id"]).count() == 0
    back = tables.diff(new, old, ["id"])
    assert [(r.change_type, r.id) for r in back.collect() if r.change_type in ("insert", "delete")] == [
        ("delete", 6)]


def test_diff_with_new_columns(spark):
    old = frame(spark, [(1, "a")])
    new = frame(spark, [(1, "a", 5)], "id int, v string, n int")
    assert rows(tables.diff(old, new, ["id"])) == [("update_post", 1, "a", 5), ("update_pre", 1, "a", None)]


def test_partitioned_table_prunes(spark, path):
    data = spark.createDataFrame(
        [("u", "2024-01-01 10:00:00"), ("v", "2024-01-02 10:00:00"), ("w", "2024-01-02 11:00:00")],
        "user_email string, t string",
    ).selectExpr("user_email", "cast(t as timestamp) access_timestamp")
    daily = access_by_day(data)
    tables.write(daily, path, partition_by=["access_date"])
    tables.append(daily, path, partition_by=["access_date"])
    day = tables.read(spark, path).filter("access_date = date'2024-01-02'")
    assert day.count() == 4
    assert "PartitionFilters: [isnotnull(access_date" in plan(day)


def test_append_to_named_table(spark):
    tables.append_named(spark.range(2), "named_events")
    tables.append_named(spark.range(3), "named_events")
    assert spark.table("named_events").count() == 5
    spark.sql("DROP TABLE named_events")


def test_log_tables(spark):
    names = schemas.create_log_tables(spark)
    assert names == ["default.data_lineage", "default.quality_metrics", "default.access_audit"]
    schemas.create_log_tables(spark)
    spark.sql("INSERT INTO data_lineage (lineage_id, source_table) VALUES ('1', 's')")
    row = spark.table("data_lineage").first()
    assert row.lineage_id == "1" and row.created_at is not None
    assert spark.table("access_audit").columns[-1] == "access_date"
    for name in names:
        spark.sql(f"DROP TABLE {name}")


@pytest.mark.parametrize("policy, kept", [
    ("30-days", {3, 4}), ("7-years", {2, 3, 4}), ("permanent", {1, 2, 3, 4}), ("10_YEARS", {1, 2, 3, 4}),
])
def test_retention(spark, policy, kept):
    df = spark.createDataFrame(
        [(1, "2015-01-01"), (2, "2020-01-01"), (3, "2024-01-15"), (4, None)], "id int, ts string"
    ).withColumn("ts", F.col("ts").cast("timestamp"))
    got = {r.id for r in retention.prune(df, "ts", policy, "2024-01-31 00:00:00").collect()}
    assert got == kept


def test_retention_by_class(spark):
    df = spark.createDataFrame(
        [(1, "a", "2023-01-01"), (2, "b", "2023-01-01"), (3, None, "2023-01-01")],
        "id int, kind string, ts string").withColumn("ts", F.col("ts").cast("timestamp"))
    out = retention.prune(df, "ts", {"a": "30-days", "b": "permanent"}, "2024-01-31", "kind")
    assert {r.id for r in out.collect()} == {2, 3}
    with pytest.raises(ValueError, match="unknown retention"):
        retention.prune(df, "ts", "soon")


def test_rows_without_a_key_have_one_change_each(spark):
    old = frame(spark, [(None, f"a{i}") for i in range(300)] + [(1, "x")])
    new = frame(spark, [(None, f"b{i}") for i in range(300)] + [(1, "x")])
    got = tables.diff(old, new, ["id"]).groupBy("change_type").count().collect()
    assert {r.change_type: r["count"] for r in got} == {"insert": 300, "delete": 300}


def test_rows_of_a_partitioned_write_are_counted(spark, path):
    data = spark.range(100).selectExpr("id", "id % 3 as part")
    assert tables.write(data, path, partition_by=["part"]) == 100


def test_diff_by_buckets(spark):
    schema = "k int, a string, b string, m map<string,int>, s struct<x:int,y:int>"
    old = spark.createDataFrame(
        [(i, "v", None, {"x": i}, (i, None)) for i in range(200)] + [(None, "n", None, None, None)], schema)
    changed = {3: (3, None, "v", {"x": 3}, (3, None)), 5: (5, "v", None, {"x": 6}, (5, None)),
               7: (7, "v", None, {"x": 7}, (None, 7))}
    new = spark.createDataFrame(
        [changed.get(i, (i, "v", None, {"x": i}, (i, None))) for i in range(1, 201)], schema)
    columns = ["change_type", "k", "a", "b"]
    for frames in ((old, new), (old, old), (old.where("1 = 0"), new), (old, new.drop("b"))):
        left, right = [f.drop("m") for f in frames]  # maps cannot be compared by the plain diff
        got = tables.diff_by_buckets(left, right, ["k"], 64)
        assert rows(got.select(columns)) == rows(tables.diff(left, right, ["k"]).select(columns))
    # A map is part of the checksum: its bucket, and only those that differ, are compared.
    sealed = [tables._sealed(f, ["k"], old.columns, 512).collect() for f in (old, new)]
    differ = {r._bucket for r in set(sealed[0]) ^ set(sealed[1])}
    held = {r[0] for r in old.union(new).where("k IN (0, 3, 5, 7, 200) OR k IS NULL").select(
        tables._key_bucket(["k"], 512)).collect()}
    assert differ == held


def test_equal_buckets_are_not_shuffled(spark, tmp_path):
    spark.range(50_000).selectExpr("id as k", "id % 7 as v").write.parquet(str(tmp_path / "t"))
    old = spark.read.parquet(str(tmp_path / "t"))
    new = old.withColumn("v", F.when(F.col("k") == 4321, 99).otherwise(F.col("v")))
    out = tables.diff_by_buckets(old, new, ["k"])
    assert len(out.collect()) == 2
    text = plan(out)
    # The semi join by bucket lies below the shuffle of the rows on their key.
    rows_shuffled = [line for line in text.splitlines() if "Exchange hashpartitioning(o_0" in line]
    assert rows_shuffled and "BroadcastHashJoin" in text and "LeftSemi" in text


def test_bucketed_tables_join_without_a_shuffle(spark):
    from lakejobs.registry import columns

    text = plan(columns.colocated(spark, SMALL))
    assert "Exchange" not in text and text.count("SortMergeJoin") == 2
    assert text.count("Bucketed: true") == 3


def test_compaction_leaves_no_file_for_each_core(spark, path):
    """Enough bytes in a shuffle for a partition of 1 MB for each of four cores."""
    rows_ = spark.range(400_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text"))
    rows_.repartition(16).write.parquet(f"{path}/small")
    before = spark.read.parquet(f"{path}/small")
    assert tables.compact(before, f"{path}/few") == 400_000
    few = spark.read.parquet(f"{path}/few")
    assert len(few.inputFiles()) == 1 and few.agg(F.sum("id")).first()[0] == 400_000 * 399_999 // 2
    size = tables.file_sizes(before).first()["size_bytes"]
    assert tables.compact(before, f"{path}/even", file_bytes=size // 3) == 400_000
    assert len(spark.read.parquet(f"{path}/even").inputFiles()) == 4
    assert tables.compact(before.filter("false"), f"{path}/none") == 0
