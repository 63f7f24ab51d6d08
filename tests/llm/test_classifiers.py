import zlib

import numpy as np
import pyarrow as pa
from corpus_fixtures import messy, nothing, shipped, texts  # noqa: F401
from pyspark.sql import functions as F

from lakejobs.llm import arrow_text, mil_quality, queries, sampling, string_kernel


def accuracy(rows, truth):
    return np.mean([truth(r) for r in rows])


def test_held_out_is_the_crc_of_the_id(messy):
    for r in messy.select("doc_id", sampling.held_out(F.col("doc_id")).alias("h")).collect():
        assert r.h == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)


def test_language_of_held_out_documents(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    got = queries.queries()["op6_string_kernel"](spark, small)
    rows = got.join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(rows) > 30 and accuracy(rows, lambda r: r.lang == r.lang_pred) > 0.93
    assert got.count() == docs.count()


def test_language_of_odd_texts(messy, nothing):
    model = string_kernel.learn(messy)
    assert model.languages == ["en", "fr"]
    rows = string_kernel.identify(messy, model, out="size").select("text", "size.*").collect()
    for r in rows:
        letter = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not letter)
        assert 0 <= r.score <= 1
    none = string_kernel.learn(nothing)
    assert none.languages == []
    assert {r[0].lang_pred for r in messy.select(
        string_kernel.identified(F.col("text"), none)).collect()} == {"und"}
    assert string_kernel.identify(nothing, model).count() == 0


def test_presence_is_the_set_of_grams():
    texts = ["Abcab", "", "zé"]
    raw, at = arrow_text.utf8(pa.array(texts))
    table = string_kernel.presence(raw, at[:-1], at[1:])
    for text, row in zip(texts, table, strict=True):
        data = text.encode().lower()
        grams = {data[i:i + n] for n in string_kernel.GRAMS for i in range(len(data) - n + 1)}
        buckets = set()
        for g in grams:
            value = 0
            for b in g:
                value = (value * 257 + b + 1) % (1 << 32)
            buckets.add((value * 0x9E3779B1 % (1 << 32) ^ len(g)) >> (32 - string_kernel.BITS))
        assert set(np.flatnonzero(row).tolist()) == buckets


def test_quality_of_held_out_documents(spark, small):
    folder = small.replace("0.001", "0.01")
    got = queries.queries()["op5_mil_quality"](spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = got.join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 60 and accuracy(rows, lambda r: r.predicted == r.quality) > 0.9
    assert all(r.predicted == int(r.score >= 0.7) for r in rows)


def test_quality_of_odd_texts(spark, messy, nothing):
    labels = spark.createDataFrame(
        [(i, int(i % 2)) for i in range(36)] + [(None, 1), (3, None), (4, 0), (4, 0)],
        "doc_id long, quality int")
    model = mil_quality.learn(messy, labels)
    scores = messy.select("text", mil_quality.quality_score(F.col("text"), model).alias("s")).collect()
    assert all(0 <= r.s <= 1 for r in scores) and len(scores) == messy.count()
    assert len({r.s for r in scores if not r.text}) == 1
    assert mil_quality.learn(nothing, labels) is None
    assert mil_quality.learn(messy, labels.where("1 = 0")) is None
    assert nothing.select(mil_quality.quality_score(F.col("text"), model)).count() == 0


def test_gradients():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(7, mil_quality.FEATURES))
    owner, label, weight = np.array([0, 0, 0, 1, 2, 2, 2]), np.array([1.0, 0, 1]), np.ones(3)
    model = mil_quality.fit(x, owner, label, epochs=1)
    grads = model.gradients(model.forward(x, owner, 3), owner, label, weight)

    def loss():
        p = model.forward(x, owner, 3)["score"]
        return -(label * np.log(p) + (1 - label) * np.log(1 - p)).sum()

    for name, g in grads.items():
        p = model.params[name]
        at = tuple(rng.integers(0, s) for s in p.shape)
        keep = p[at]
        p[at] = keep + 1e-5
        up = loss()
        p[at] = keep - 1e-5
        down = loss()
        p[at] = keep
        assert abs((up - down) / 2e-5 - g[at]) < 1e-4, name


def test_passages_cover_whole_texts():
    at = np.array([0, 0, 5, 1030, 1031])
    owner, begin, end = arrow_text.passages(at, 512)
    assert owner.tolist() == [0, 1, 2, 2, 2, 3]
    assert sum(end - begin) == 1031 and max(end - begin) <= 512


def test_quality_score_is_that_of_a_plain_loop(messy):
    """Passage by passage and document by document, without the batched layers."""
    rng = np.random.default_rng(3)
    hidden, att, features = mil_quality.HIDDEN, mil_quality.ATTENTION, mil_quality.FEATURES
    p = {"w": rng.normal(0, .1, (features, hidden)), "b": rng.normal(size=hidden),
         "v": rng.normal(size=(hidden, att)), "u": rng.normal(size=(hidden, att)),
         "a": rng.normal(size=att), "c": rng.normal(size=hidden), "d": np.array([.2])}
    model = mil_quality.AttentionModel(rng.normal(0, .1, features), rng.uniform(.1, 1, features), p)
    rows = messy.select("text", mil_quality.quality_score(F.col("text"), model).alias("s")).collect()
    long = "Some words, and more. " * 400
    rows += messy.sparkSession.createDataFrame([(long,), (long[5:],)], "text string").select(
        "text", mil_quality.quality_score(F.col("text"), model).alias("s")).collect()
    for text, score in rows:
        raw, at = arrow_text.utf8(pa.array([text or ""]))
        _, begin, end = arrow_text.passages(at, mil_quality.PASSAGE_BYTES)
        assert begin[0] == 0 and end[-1] == len((text or "").encode())
        assert (begin[1:] == end[:-1]).all()
        states, pulls = [], []
        for b, e in zip(begin, end, strict=True):
            x = mil_quality.passage_features(raw, np.array([b]), np.array([e]))[0]
            x = np.clip((x - model.mean) / model.scale, -8, 8)
            h = np.tanh(x @ p["w"] + p["b"])
            gate = 1 / (1 + np.exp(-(h @ p["u"])))
            states.append(h)
            pulls.append(float(np.sum(p["a"] * np.tanh(h @ p["v"]) * gate)))
        weights = np.exp(np.array(pulls) - max(pulls))
        bag = sum(w * h for w, h in zip(weights / weights.sum(), states, strict=True))
        assert abs(score - 1 / (1 + np.exp(-(bag @ p["c"] + p["d"][0])))) < 1e-4


def test_language_scores_are_those_of_the_explicit_kernel(spark):
    """Nystroem features from the kernel matrix of the landmarks, one passage after another."""
    words = {"a": "the cat sat on a mat and saw the dog".split(),
             "b": "le chat est sur une table et voit un chien".split(),
             "c": "der hund sieht eine katze auf dem tisch".split()}
    rng = np.random.default_rng(6)
    names = [n for n in words for _ in range(12)]
    passages = [" ".join(rng.choice(words[n], 9)) for n in names]
    model = string_kernel.fit(passages, names, landmarks=10)

    def seen(text):
        raw, at = arrow_text.utf8(pa.array([text]))
        row = string_kernel.presence(raw, at[:-1], at[1:])[0].astype(float)
        return row / np.sqrt(max(row.sum(), 1))

    order = sorted(range(len(names)), key=lambda i: (names[i], i))
    marks = [seen(passages[order[i]]) for i in
             np.unique(np.linspace(0, len(order) - 1, 10).astype(int))]
    values, vectors = np.linalg.eigh(np.array([[x @ y for y in marks] for x in marks]))
    root = vectors[:, values > 1e-6 * values.max()] / np.sqrt(values[values > 1e-6 * values.max()])

    def mapped(text):
        kernel = np.array([seen(text) @ m for m in marks])
        return np.append(kernel @ root, 1.0)

    design = np.array([mapped(t) for t in passages])
    target = np.array([[1.0 if n == m else -1.0 for m in sorted(words)] for n in names])
    weighted = design / len(names)
    solution = np.linalg.solve(weighted.T @ design + 1e-2 / 3 * np.eye(design.shape[1]),
                               weighted.T @ target)
    asked = ["the dog sat", "un chien voit le chat", "katze auf dem hund", "mat table tisch"]
    best, score = string_kernel.predict(pa.array(asked), model)
    for text, at, share in zip(asked, best, score, strict=True):
        plain = np.exp(string_kernel.SHARPNESS * (mapped(text) @ solution))
        assert at == int(plain.argmax()) and abs(share - plain.max() / plain.sum()) < 1e-3


def test_sample_ranked_in_a_tree_is_the_sample_ranked_at_once(spark):
    rows = [(i % 700 if i % 5 else None, "ab"[i % 3 == 0], f"t{i}") for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, label string, text string")
    keyed = df.select("*", F.xxhash64("id").alias("h"),
                      F.xxhash64("id", "label", "text").alias("w")).collect()
    want = []
    for label in "ab":
        ranked = sorted((r for r in keyed if r.label == label),
                        key=lambda r: (r.h, r.id is not None, r.id or 0, r.w))
        want += [(r.id, r.label, r.text) for r in ranked[:40]]
    for parts in (1, 7):
        twice = df.union(df.where("id < 9 or id is null")).repartition(parts)
        got = sampling.first_by_hash(twice, "label", "id", 40).collect()
        assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_learning_takes_one_row_of_a_repeated_id_and_few_passages(spark):
    texts = [(i % 40, "word " * (20 + i) + str(i)) for i in range(200)]
    docs = spark.createDataFrame([*texts, (1, "long. " * 60_000)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    held = {}
    plain = mil_quality.fit

    def noted(features, owner, label, **rest):
        held.update(passages=len(features), bags=len(label), most=np.bincount(owner).max())
        return plain(features, owner, label, epochs=1)

    mil_quality.fit, before = noted, mil_quality.fit
    try:
        assert mil_quality.learn(docs, labels, most_passages=16) is not None
    finally:
        mil_quality.fit = before
    assert held["bags"] == sum(zlib.crc32(str(i).encode()) % 4 != 2 for i in range(40))
    assert held["most"] <= 16
