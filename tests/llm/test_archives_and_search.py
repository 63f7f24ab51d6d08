import gzip
import hashlib
import uuid

import numpy as np
import pytest
from corpus_fixtures import shipped  # noqa: F401
from pyspark.sql import functions as F

from lakejobs.llm import permutation_index, queries, warc_convert


def test_arc_versions_and_lengths():
    body = b"HTTP/1.1 200 OK\r\nX-Archive-Id: 7\r\n\r\nline\nhttp://x 1 2 3 9\n"
    for version in (1, 2):
        data = b"\n".join([
            warc_convert.arc_block(version, "a.arc"),
            warc_convert.arc_record(version, "http://a/b c", "2001", body, "a.arc"),
            warc_convert.arc_record(version, None, "20010203040506", b"", "a.arc"), b""])
        for content in (data, gzip.compress(data[:300]) + gzip.compress(data[300:])):
            found = list(warc_convert.parse_arc(warc_convert.inflated(content)))
            assert [(f["URL"], b) for f, b, _ in found] == [
                ("http://a/b%20c", body), ("about:blank", b"")]
            assert ("Result-code" in found[0][0]) == (version == 2)
    with pytest.raises(ValueError, match="no record at byte"):
        list(warc_convert.parse_arc(data[:-40]))
    spaced = warc_convert.arc_block(1, "a") + b"\nhttp://a/b c 1.2.3.4 19990101 text/plain 2\nhi\n"
    (fields, got, _), = warc_convert.parse_arc(spaced)
    assert fields["URL"] == "http://a/b c" and got == b"hi"


def test_dates():
    assert warc_convert.warc_date("20240229010203") == "2024-02-29T01:02:03Z"
    assert warc_convert.warc_date("1999") == "1999-01-01T00:00:00Z"
    assert warc_convert.warc_date("-") == "0000-01-01T00:00:00Z"


def test_pages_come_back(spark, tmp_path):
    big = "<p>né\r\n\r\nWARC/1.1\r\n" + "x" * 1000
    rows = [(1, "http://a", big, 0), (2, None, big, 0), (9, "http://b c\n", big, 0),
            (4, "http://d", "short", 0), (5, "http://d", "short", 0), (6, "e", None, 0),
            (7, "e", "", 0), (8, "f", "y" * 200_000, 0), (8, "f", "y" * 200_000, 0),
            (None, "g", big, 0), (-3, "h", "z" * 999, 0), (3, "h", "z" * 999, 0)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, record_type int")
    spark_dir = f"{tmp_path}/{uuid.uuid4().hex}"
    df.repartition(3).write.parquet(f"{spark_dir}/pages.parquet")
    got = sorted((tuple(r) for r in queries.queries()["op1_warc_convert"](
        spark, spark_dir).collect()), key=str)
    want = []
    last = {big: 9, "y" * 200_000: 8}
    second = False
    for page, _, html, _ in rows:
        data = (html or "").encode()
        top = last.get(html) if len(data) >= 1000 else None
        revisit = top is not None and (page != top or (page == 8 and second))
        second = second or page == 8
        want.append((page, len(data), hashlib.sha1(data).hexdigest(),
                     "revisit" if revisit else "response", top if revisit else None))
    assert got == sorted(want, key=str)


def test_no_pages(spark, tmp_path):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    df.write.parquet(f"{tmp_path}/pages.parquet")
    assert queries.queries()["op1_warc_convert"](spark, str(tmp_path)).count() == 0


def exact(ids, vectors, wanted, k):
    size = np.sqrt((vectors * vectors).sum(1))
    for q in wanted:
        score = (vectors * vectors[q]).sum(1) / (size * size[q])
        order = [i for i in np.lexsort((ids, -score)) if ids[i] != ids[q]][:k]
        yield int(ids[q]), [(int(ids[i]), float(score[i])) for i in order]


def test_recall_against_brute_force(spark, small):
    folder = small.replace("0.001", "0.01")
    got = {}
    for r in queries.queries()["op2_permutation_index"](spark, folder).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").where(
        permutation_index.usable(F.col("embedding"))).orderBy("vec_id").collect()
    ids, vectors = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    hits = total = 0
    for query, best in exact(ids, vectors, np.flatnonzero(ids % 50 == 0), 5):
        assert sorted(got[query]) == [1, 2, 3, 4, 5]
        found = [got[query][i] for i in range(1, 6)]
        assert found == sorted(found, key=lambda x: (-x[1], x[0]))
        hits += len({v for v, _ in found} & {v for v, _ in best})
        total += 5
    assert hits / total >= 0.95


def test_recall_beyond_one_block(spark, monkeypatch):
    rng = np.random.default_rng(2)
    vectors = rng.normal(size=(6000, 24))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)],
                               "vec_id long, embedding array<double>")
    monkeypatch.setattr(permutation_index, "BLOCK", 2500)
    monkeypatch.setattr(permutation_index, "QUERY_BLOCK", 16)
    index = permutation_index.build(df, pivots=128)
    rows = permutation_index.search(index, F.col("vec_id") % 200 == 0, k=5).collect()
    got = {}
    for r in rows:
        got.setdefault(r.query_id, set()).add(r.vec_id)
    want = dict(exact(np.arange(6000), vectors, range(0, 6000, 200), 5))
    assert np.mean([len(got[q] & {v for v, _ in best}) / 5 for q, best in want.items()]) >= 0.9


def test_all_files_opened_is_exact_and_few_files_still_give_k(spark):
    rng = np.random.default_rng(8)
    vectors = rng.normal(size=(3000, 32))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)],
                               "vec_id long, embedding array<double>")
    index = permutation_index.build(df, pivots=300)
    want = dict(exact(np.arange(3000), vectors, range(0, 3000, 100), 5))

    def found(**settings):
        got = {}
        for r in permutation_index.search(index, F.col("vec_id") % 100 == 0, **settings).collect():
            got.setdefault(r.query_id, []).append((r["rank"], r.vec_id))
        return {q: [v for _, v in sorted(x)] for q, x in got.items()}

    every = found(opened=permutation_index.RANKS + 1, reranked=1)
    assert every == {q: [v for v, _ in best] for q, best in want.items()}
    assert {len(x) for x in found(posted=0).values()} == {5}


def test_the_least_vector_of_a_repeated_id_asks(spark):
    rows = [(50, [0.0, 1.0]), (50, [1.0, 0.0]), (50, [0.5, 0.5]), (1, [0.1, 1.0]), (2, [1.0, 0.2])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for parts in (1, 3):
        index = permutation_index.build(df.repartition(parts))
        got = permutation_index.search(index, F.col("vec_id") == 50, k=1).collect()
        assert [(r.query_id, r.vec_id) for r in got] == [(50, 1)]


def test_odd_vectors_and_ties(spark):
    same = [1.0, 2.0]
    rows = [(i, same, i) for i in range(0, 40)] + [
        (100, None, 0), (101, [], 0), (102, [0.0, 0.0], 0), (103, [1.0, None], 0),
        (104, [float("nan"), 1.0], 0), (105, [float("inf"), 1.0], 0), (106, [1.0, 2.0, 3.0], 0),
        (None, same, 0), (150, [2.0, -1.0], 0), (150, [2.0, -1.0], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank int")
    index = permutation_index.build(df)
    got = {}
    for r in permutation_index.search(index, F.col("vec_id") % 50 == 0, k=5).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id))
    assert {q: [v for _, v in sorted(x)] for q, x in got.items()} == {
        0: [1, 2, 3, 4, 5], 150: [0, 1, 2, 3, 4]}
    empty = permutation_index.build(df.where("1 = 0"))
    assert permutation_index.search(empty, F.lit(True)).count() == 0
    alone = permutation_index.build(df.where("vec_id = 3"))
    assert permutation_index.search(alone, F.lit(True)).count() == 0


def test_files_of_many_gzip_members():
    """A member a record, as archives have it: the time grows with the members, not their square."""
    import gzip
    import time

    parts = [bytes([i % 251]) * 700 + b"%d" % i for i in range(20_000)]
    begin = time.time()
    content = b"".join(gzip.compress(p, 1) for p in parts)
    packing = time.time() - begin
    begin = time.time()
    assert warc_convert.inflated(content) == b"".join(parts)
    assert time.time() - begin < 5 + 5 * packing
    large = bytes(range(256)) * 40_000
    assert warc_convert.inflated(gzip.compress(large) + gzip.compress(b"") + gzip.compress(b"x")) \
        == large + b"x"
    assert warc_convert.inflated(gzip.compress(b"a") + b"\0\0") == b"a"
    with pytest.raises(ValueError, match="not whole"):
        warc_convert.inflated(gzip.compress(large)[:-9])
