import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from corpus_fixtures import messy, nothing, prose, shipped, texts  # noqa: F401
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from lakejobs.llm import components, jaccard_join, vector_packing

LOW = {c: c + 32 for c in range(65, 91)}


def shingles(text, words=3):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    if 0 < len(w) < words:
        return {tuple(w)}
    return {tuple(w[i:i + words]) for i in range(len(w) - words + 1)}


def brute(rows, words=3, percent=90):
    """(id, set size, smallest id reachable) of every row."""
    sets = [shingles(t, words) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[find(i)] = min(least.get(find(i), key), key)
    return Counter((k, len(s), least.get(find(i)) if s else k)
                   for i, ((k, _), s) in enumerate(zip(rows, sets, strict=True)))


def check(spark, rows, **options):
    df = spark.createDataFrame([(k, t, 1, "x") for k, t in rows],
                               "doc_id long, text string, n int, cls string").repartition(4)
    got = Counter((r.doc_id, r.n_shingles, r.component_id)
                  for r in jaccard_join.linked_documents(df, **options).collect())
    assert got == brute(rows, options.get("words", 3), options.get("percent", 90))


def test_odd_texts(spark, messy):
    check(spark, [(r.doc_id, r.text) for r in messy.select("doc_id", "text").collect()])


def test_edited_copies(spark):
    rng = random.Random(4)
    rows = []
    for family in range(12):
        words = prose(family, rng.choice([25, 60, 150, 700])).split()
        for _ in range(rng.choice([2, 5, 14])):
            copy = list(words)
            for _ in range(rng.randint(0, max(1, len(words) // 40))):
                copy[rng.randrange(len(copy))] = f"edit{rng.randint(0, 30)}"
            rows.append((len(rows) * 7 % 1009, " ".join(copy)))
    check(spark, rows)
    check(spark, rows, words=5, percent=80)


def test_shared_passages_and_one_family(spark):
    """A passage in most documents, and a family of near copies in long lists."""
    rng = random.Random(8)
    passage = prose(77, 40)
    rows = [(i, passage + " " + prose(1000 + i, 60)) for i in range(60)]
    words = prose(5, 120).split()
    for i in range(90):
        copy = list(words)
        for _ in range(i % 4):
            copy[rng.randrange(len(copy))] = f"new{rng.randint(0, 9)}"
        rows.append((1000 + i, " ".join(copy)))
    check(spark, rows)


def test_clusters_beyond_one_block(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "CLUSTER_BLOCK", 6)
    rng = random.Random(3)
    words = prose(6, 200).split()
    rows = []
    for i in range(40):
        copy = list(words)
        copy[rng.randrange(len(copy))] = f"w{i}"
        rows.append((i, " ".join(copy)))
    check(spark, rows)


def test_copies_are_posted_once_a_task():
    same, other = prose(1, 40), prose(2, 40)
    batches = [pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
               for texts in ([same, same.upper(), other, None], [same] * 50, ["", other])]
    post = jaccard_join.post_prefixes(3, 90, np.zeros(1 << jaccard_join.BUCKET_BITS, np.uint8))
    rows = pa.Table.from_batches(list(post(batches))).to_pylist()
    assert len({r["cls"] for r in rows}) == 2
    assert len({(r["shingle"], r["cls"]) for r in rows}) == len(rows)


def test_a_cluster_beyond_the_production_block(spark):
    words = prose(6, 70).split()
    rows = []
    for i in range(jaccard_join.CLUSTER_BLOCK + 100):
        copy = list(words)
        copy[i % 70] = f"w{i}"
        rows.append((i, " ".join(copy)))
    rows += [(10_000, prose(7, 70)), (10_001, "alone")]
    got = jaccard_join.linked_documents(
        spark.createDataFrame(rows, "doc_id long, text string").repartition(4), percent=80)
    want = Counter({0: jaccard_join.CLUSTER_BLOCK + 100, 10_000: 1, 10_001: 1})
    assert Counter(r.component_id for r in got.collect()) == want


def near_sets(count):
    """Sets of 60 numbers, each with an own one and without one of the common ones."""
    rng = np.random.default_rng(7)
    common = np.arange(1000, 1060, dtype=np.uint64)
    return [np.sort(np.append(np.delete(common, rng.integers(60)), np.uint64(10_000 + i)))
            for i in range(count)]


def test_links_of_two_production_blocks_fit_a_worker():
    sets = near_sets(2 * jaccard_join.CLUSTER_BLOCK)
    tracemalloc.start()
    root = jaccard_join.links(sets, 90)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert set(root.tolist()) == {0} and peak < 400 << 20
    assert len(set(jaccard_join.links(sets[:300], 99).tolist())) == 300


def test_overlaps():
    rng = np.random.default_rng(1)
    for size in (5, 60):
        sets = [np.unique(rng.integers(0, 90, rng.integers(1, 60)).astype(np.uint64))
                for _ in range(size)]
        got = jaccard_join.overlaps(sets)
        want = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
        assert got.tolist() == want


def test_bitmaps_never_rule_out_similar_sets():
    rng = np.random.default_rng(5)
    for n in (3, 40, 900, 3000):
        a = np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[:-(n // 25 + 1)], rng.integers(0, 1 << 62, n // 30)
                                      .astype(np.uint64)]))
        import pyarrow as pa
        bits = jaccard_join.Bitmaps(pa.array([jaccard_join.bitmap(x) for x in (a, b)], pa.binary()))
        apart = len(np.setxor1d(a, b))
        assert bits.differ(np.array([0]), np.array([1]))[0] <= apart


def test_lists_are_skipped_by_position(monkeypatch):
    """Only entries of fitting size and position meet, and none that fits is left out."""
    seen = []

    def none_similar(i, j, n, place, bits, percent):
        seen.append((i, j))
        return np.zeros(len(i), bool)

    monkeypatch.setattr(jaccard_join, "possible", none_similar)
    rng = np.random.default_rng(11)
    for percent in (60, 80, 90):
        n = rng.integers(1, 60, 300)
        place = rng.integers(0, n - -(-percent * n // 100) + 1)
        n, place = (x[np.lexsort((place, n))] for x in (n, place))
        seen.clear()
        assert not list(jaccard_join.connect_list(20, 290, n, place, None, percent))
        i, j = (np.concatenate(x) for x in zip(*seen, strict=True))
        met = set(zip(i.tolist(), j.tolist(), strict=True))
        assert len(met) == len(i) and jaccard_join.fitting(i, j, n, place, percent).all()
        every = np.arange(20, 290)
        fits = jaccard_join.fitting(every[:, None], every[None, :], n, place, percent)
        fits &= every[:, None] != every[None, :]
        assert met == {(a, b) for a, b in zip(*(x + 20 for x in np.nonzero(fits)), strict=True)
                       if b < a}
        assert jaccard_join.partnered(n[20:290], place[20:290], percent).tolist() \
            == fits.any(1).tolist()


def test_the_leading_set_is_near_the_others():
    sets = [np.arange(5, dtype=np.uint64), *near_sets(40)]
    assert len(jaccard_join.leading(sets)) == 60


def test_empty_and_components(spark, nothing):
    assert jaccard_join.linked_documents(nothing).count() == 0
    edges = [(1, 2), (2, 3), (9, 8), (8, 7), (7, 10), (5, 5), (2, 1), (20, 3)]
    got = dict(components.components(spark.createDataFrame(edges, "u long, v long")).collect())
    assert got == {1: 1, 2: 1, 3: 1, 20: 1, 7: 7, 8: 7, 9: 7, 10: 7}
    chain = [(i, i + 1) for i in range(200)]
    got = components.components(spark.createDataFrame(chain, "u long, v long")).collect()
    assert len(got) == 201 and {r.root for r in got} == {0}


def test_one_document_of_each_group_stays(spark, messy):
    rows = [(r.doc_id, r.text) for r in messy.select("doc_id", "text").collect()]
    out = corpus_pipeline.near_duplicates(spark, messy, "")
    assert out.columns == messy.columns
    want = {k for k, _, c in brute(rows) if k == c}
    got = [r.doc_id for r in out.collect()]
    assert set(got) == want and len(got) == len(want)


def test_near_copies_of_the_stage(spark):
    """Copies with a similarity of 0.8 to 0.9 go, those below stay."""
    rows = []
    for family in range(4):
        words = prose(200 + family, 120).split()
        for cut in (0, 14, 18, 40):
            rows.append((len(rows), " ".join(words[:len(words) - cut])))
        edited = list(words)
        edited[50] = edited[90] = "edited"
        rows.append((len(rows), " ".join(edited)))
    sets = [shingles(t, 5) for _, t in rows[:5]]
    like = [len(sets[0] & s) / len(sets[0] | s) for s in sets]
    assert sum(0.8 <= x < 0.9 for x in like) == 3 and like[3] < 0.8
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(r.doc_id for r in corpus_pipeline.near_duplicates(spark, df, "").collect())
    assert got == sorted(k for k, _, c in brute(rows, words=5, percent=80) if k == c)


def test_stage_tells_rows_of_one_id_apart(spark):
    one, other, third = prose(301, 80), prose(302, 80), prose(303, 80)
    near = one.replace("stone", "stones", 1)
    assert near != one
    rows = [(1, one), (2, near), (2, other), (2, other), (-3, third), (7, third), (None, near),
            (None, prose(304, 80)), (None, prose(305, 80)), (None, prose(305, 80)),
            (None, third + " end"), (None, None), (4, None), (4, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = Counter(tuple(r) for r in corpus_pipeline.near_duplicates(spark, df, "").collect())
    assert got == Counter([(1, one), (2, other), (-3, third), (None, prose(304, 80)),
                           (None, prose(305, 80)), (None, None), (4, None), (4, "")])


def test_without_languages_only_texts_without_letters_go(spark, messy):
    blank = messy.withColumn("lang", F.lit(None).cast("string"))
    out = corpus_pipeline.language(spark, blank, "")
    assert out.columns == messy.columns
    want = Counter(r.doc_id for r in messy.collect() if any(c.isalpha() for c in r.text or ""))
    assert Counter(r.doc_id for r in out.collect()) == want and want[29] == 1


def test_pipeline_keeps_good_documents(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language ID", "quality classifier", "n-gram Jaccard join",
        "mixing sources to target weights", "packing"]
    first = corpus_pipeline.language(spark, docs, small)
    assert first.columns == docs.columns and first.count() >= 0.97 * docs.count()
    second = corpus_pipeline.quality(spark, first, small)
    labels = spark.read.parquet(f"{small}/labels.parquet").where("quality = 1")
    good = first.join(labels, "doc_id", "left_semi").count()
    assert second.columns == docs.columns
    assert second.join(labels, "doc_id", "left_semi").count() >= 0.95 * good


def test_pipeline_runs(spark, small):
    rows = entry.queries()["pipeline"](spark, small).collect()
    assert set(rows[0].asDict()) == {c.split()[0] for c in vector_packing.SCHEMA.split(", ")}
    by = Counter()
    for r in rows:
        by[r.sequence_id] += r.length
    assert max(by.values()) <= 2048
    assert sum(n & (n - 1) > 0 for n in by.values()) == 0


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES])
def test_stages_take_empty_tables(spark, stage, nothing, small):
    assert stage(spark, nothing, small).count() == 0


def test_stages_take_odd_texts(spark, messy, tmp_path):
    spark.createDataFrame([(i, i % 2) for i in range(36)], "doc_id long, quality int").write.parquet(
        f"{tmp_path}/labels.parquet")
    for _, stage in corpus_pipeline.STAGES[:4]:
        assert stage(spark, messy, str(tmp_path)).columns == messy.columns


def test_near_copies_without_an_id_meet_as_their_own_texts(spark):
    """2,000 near copies under one id: each class is met by its own row, not by all of them."""
    base = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(2000):
        words = list(base)
        words[i % 400] = f"x{i}"
        rows.append((None if i % 2 else 7, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    texts = docs.withColumn("mark", F.xxhash64("text"))
    placed = texts.select("doc_id", "mark", F.monotonically_increasing_id().alias("cls"),
                          F.lit(1).alias("cluster"), F.lit("b").alias("bundle"))
    assert jaccard_join.texts_of(placed, texts).count() == 2000
    found = jaccard_join.linked_documents(docs).groupBy("doc_id").agg(
        F.count("*").alias("n"), F.min("component_id").alias("one"),
        F.max("component_id").alias("other")).collect()
    assert {(r.doc_id, r.n, r.one, r.other) for r in found} == {(None, 1000, 7, 7), (7, 1000, 7, 7)}
