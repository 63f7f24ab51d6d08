"""Every registered query against its SQL, and the shape of the plans."""

import re
from collections import Counter

import duckdb
import pytest
from conftest import SMALL, plan

import __spark_entry__ as entry
from lakejobs import registry

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return con


def test_every_query_has_its_sql():
    assert set(registry.queries()) == set(registry.oracles())
    assert set(registry.queries()) <= set(entry.queries())


def test_names():
    for name in registry.queries():
        assert not re.search(r"pipeline|op\d", name)


@pytest.mark.parametrize("name", sorted(registry.oracles()))
def test_query_matches_sql(spark, duck, name):
    df = registry.queries()[name](spark, SMALL)
    result = duck.execute(registry.oracles()[name])
    names = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(names)
    got = Counter(tuple(r[c] for c in sorted(names)) for r in df.collect())
    order = [names.index(c) for c in sorted(names)]
    want = Counter(tuple(r[i] for i in order) for r in result.fetchall())
    assert got == want
    text = plan(df)
    for word in ("Python", "Cartesian", "NestedLoop", "MapInPandas", "BatchEval"):
        assert word not in text


def test_entry_runs(spark):
    assert entry.entry(spark).count() == 1


def test_filters_reach_the_scan(spark):
    from lakejobs.operators import filters, retention
    from lakejobs.sources import star_tables as star

    events = star.table(spark, SMALL, "events")
    text = plan(filters.within_hours(events, "ts", 24, star.EVENTS_AS_OF))
    assert "GreaterThan(ts,2024-01-30T00:00)" in text
    text = plan(retention.prune(events.select("event_id", "ts"), "ts", "7-days", star.EVENTS_AS_OF))
    assert "GreaterThanOrEqual(ts,2024-01-24T00:00)" in text
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in text


def test_quarantine_is_split_in_one_pass(spark):
    text = plan(registry.queries()["dq_quarantine_split"](spark, SMALL))
    assert len(re.findall(r"FileScan parquet", text)) == 6  # one for each table of the star
    text = plan(registry.queries()["dq_convention_split"](spark, SMALL))
    assert len(re.findall(r"FileScan parquet", text)) == 2


def test_dedup_reads_its_input_once(spark):
    from lakejobs.operators.dedup import dedup

    df = spark.read.parquet(f"{SMALL}/orders.parquet")
    keyed = df.selectExpr("nullif(o_orderkey % 7, 0) as k", "o_totalprice as v")
    out = dedup(keyed, ["k"], ["v"])
    text = plan(out)
    assert text.count("FileScan parquet") == 1 and "WindowGroupLimit" in text
    # Where a row goes does not depend on its number within a task that may run again.
    assert "monotonically_increasing_id" not in text
    exchange, = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    assert "_tie" not in exchange
    assert out.filter("k IS NULL").count() == keyed.filter("k IS NULL").count()
    twice = keyed.unionByName(keyed)
    assert dedup(twice, ["k"], ["v"]).filter("k IS NULL").count() \
        == 2 * keyed.filter("k IS NULL").count()
    assert out.filter("k IS NOT NULL").count() == 6
