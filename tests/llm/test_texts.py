import hashlib
import re
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from corpus_fixtures import messy, nothing, shipped, texts  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakejobs.llm import apportionment, licence_automaton, licence_texts, lookup_sketch

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = {c: c + 32 for c in range(65, 91)}
MIT = " ".join(licence_automaton.TEMPLATES["mit"][1].split())


def base(text):
    words = WORD.findall((text or "").translate(LOW))
    places, labels = [], set()
    for phrase, label in licence_automaton.PHRASES.items():
        p = phrase.split()
        found = [i for i in range(len(words)) if words[i:i + len(p)] == p]
        places += found
        labels |= {label} if found else set()
    return len(words), len(places), min(places, default=None), max(places, default=None), \
        ",".join(sorted(labels))


def test_base_phrases(spark, messy):
    texts = ["GNU General  Public-License, MIT\nLicense mit license", "cc by", "cc-BY 4", "ccby",
             "apache", "the mit", "license", "Apache License MIT License" * 3, "général public license"]
    df = spark.createDataFrame([(t,) for t in texts], "text string").union(messy.select("text"))
    for r in df.select("text", licence_automaton.scanned(F.col("text")).alias("f")).collect():
        f = r.f
        assert (f.n_words, f.n_base, f.first_word, f.last_word, f.base_labels) == base(r.text)
        assert set(filter(None, f.base_labels.split(","))) <= set(f.labels.split(","))
        assert 0 <= f.score <= 1
    assert licence_automaton.scan(messy.where("1 = 0")).count() == 0


def test_template_spans():
    scanner = licence_automaton.LicenceScanner(
        licence_automaton.TEMPLATES, licence_automaton.PHRASES)
    words = MIT.split()
    changed = " ".join(words[:20] + ["zzz"] + words[21:])
    out = scanner.scan(pa.array([f"before it {changed} after", "nothing of it", MIT[:60], None]))
    assert out[0]["labels"] == {"mit"} and not out[0]["base"]
    (label, first, end, covered), = out[0]["spans"]
    assert (label, first, end) == ("mit", 2, 2 + len(words)) and 0.95 < covered < 1
    assert not out[1]["spans"] and not out[2]["spans"] and not out[3]["labels"]


def test_whole_texts_get_their_label():
    """Every template is found whole, and half a whole license is not that license."""
    scanner = licence_automaton.LicenceScanner(
        licence_automaton.TEMPLATES, licence_automaton.PHRASES)
    for label, texts in licence_texts.TEXTS.items():
        for text in texts:
            (found,) = scanner.scan(pa.array([f"Copyright 2020 someone.\n\n{text}\nint main;"]))
            size = len(licence_texts.words(text).split())
            assert (label, 3, 3 + size, 1.0) in found["spans"] and found["score"] == 1
    whole = licence_texts.words(licence_texts.TEXTS["zlib"][0]).split()
    half, most = " ".join(whole[:len(whole) // 2]), " ".join(whole[:len(whole) * 4 // 5])
    found = scanner.scan(pa.array([half, most]))
    assert found[0]["labels"] == set() and found[1]["labels"] == {"zlib"}


def test_templates_of_a_folder(tmp_path, spark):
    text = "The Example Licence. " + " ".join(f"clause{i} grants use, copying and sale." for i in range(300))
    (tmp_path / "Example-1.txt").write_text(text)
    (tmp_path / "empty").write_text("")
    templates = licence_texts.with_folder({"mit": ["Released under the MIT license"]}, str(tmp_path))
    assert set(templates) == {"mit", "example-1"}
    df = spark.createDataFrame([(text.upper(),), (text[:900],), (None,)], "text string")
    got = df.select(licence_automaton.scanned(F.col("text"), templates).alias("f")).collect()
    assert [r.f.labels for r in got] == ["example-1", "", ""]
    assert got[0].f.score == 1 and got[0].f.n_words == len(WORD.findall(text))


@given(st.lists(st.lists(st.integers(1, 3), min_size=1, max_size=8), min_size=1, max_size=4),
       st.lists(st.integers(1, 4), max_size=15))
@settings(max_examples=150, deadline=None)
def test_matching_statistics(sequences, text):
    automaton = licence_automaton.SuffixAutomaton(sequences)
    runs = {tuple(s[a:b]) for s in sequences for a in range(len(s)) for b in range(a + 1, len(s) + 1)}
    for i, (length, state) in enumerate(automaton.stream(text)):
        want = max((n for n in range(i + 2) if n == 0 or tuple(text[i + 1 - n:i + 1]) in runs))
        assert length == want
        for template, ends in automaton.ends[state].items() if length else ():
            for end in ends:
                assert sequences[template][end - length + 1:end + 1] == text[i + 1 - length:i + 1]


def digest_sets(texts):
    digest, cut = lookup_sketch.paragraph_digests(pa.array(texts, pa.string()))
    return [digest[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)]


def test_peeling_recovers_all_differences(texts):
    left = [t for t in texts.values()]
    right = [*left[1:], left[0]]
    a = lookup_sketch.paragraph_digests(pa.array(left, pa.string()))
    b = lookup_sketch.paragraph_digests(pa.array(right, pa.string()))
    like, (row, digest, side) = lookup_sketch.compare(a, b)
    for i, (x, y) in enumerate(zip(digest_sets(left), digest_sets(right), strict=True)):
        assert len(set(x.tolist())) == len(x)
        assert set(digest[(row == i) & (side > 0)].tolist()) == set(x.tolist()) - set(y.tolist())
        assert set(digest[(row == i) & (side < 0)].tolist()) == set(y.tolist()) - set(x.tolist())
        union = len(set(x.tolist()) | set(y.tolist()))
        want = len(set(x.tolist()) & set(y.tolist())) / union if union else 1.0
        assert abs(like[i] - want) < 1e-12


def test_versions(messy):
    got = lookup_sketch.versions(messy, buckets=5).collect()
    assert len(got) == messy.count()
    key = lambda r: -(1 << 63) if r.doc_id is None else r.doc_id
    order = sorted(messy.select("doc_id", "text").collect(), key=key, reverse=True)
    want = Counter()
    for r, n in zip(order, [*order[1:], order[0]], strict=True):
        text, following = r.text or "", n.text or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + following[:half]
        want[r.doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == want
    prints = {}
    for r in got:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        prints.setdefault(r.doc_id, r.fingerprint)
    assert prints[0] == prints[25] == prints[26] and prints[20] == prints[21]
    assert len(set(prints.values())) >= 30
    assert lookup_sketch.versions(messy.where("1 = 0")).count() == 0
    one = lookup_sketch.versions(messy.where("doc_id = 7")).first()
    assert one.near_next == 1


def test_differences_column(spark):
    df = spark.createDataFrame([("a b.\nc d.", "a b.\nx y."), (None, "")], "a string, b string")
    d = df.select(lookup_sketch.differences(
        lookup_sketch.text_digests(F.col("a")), lookup_sketch.text_digests(F.col("b"))).alias("d"))
    first, second = (r.d for r in d.collect())
    assert len(first.removed) == len(first.added) == 1 and abs(first.likeness - 1 / 3) < 1e-12
    assert second.likeness == 1 and not second.removed


@given(st.lists(st.floats(0.1, 50), min_size=1, max_size=6), st.integers(0, 40))
@settings(max_examples=100, deadline=None)
def test_highest_quotients(votes, seats):
    got = apportionment.sainte_lague(votes, seats, [seats + 1] * len(votes))
    want = [0] * len(votes)
    for _ in range(seats):
        want[int(np.argmax([v / (2 * n + 1) for v, n in zip(votes, want, strict=True)]))] += 1
    assert sum(got) == seats
    spread = lambda s: sorted(v / (2 * n + 1) for v, n in zip(votes, s, strict=True))
    assert got == want or np.allclose(spread(got), spread(want), rtol=1e-9)


def test_targets_stop_at_twice_the_source():
    sizes, weights = [100, 1000, 10_000], [5, 2, 1]
    got = apportionment.targets(sizes, weights, 1.5, 2)
    assert got[0] == 200 and got[1] == 2000 and abs(sum(got) - 1.5 * sum(sizes)) < 1e-6
    assert apportionment.targets([0, 0], [5, 2], 1.5, 2) == [0, 0]


def test_mix(messy, texts):
    got = apportionment.mix(messy, keep=("doc_id", "source", "text")).collect()
    assert len(got) == messy.count()
    taken, target = Counter(), {}
    for r in got:
        words = len(re.findall(r"[^\x20\x09-\x0D]+", r.doc.text or ""))
        assert r.size == words and 0 <= r.taken <= 2 * r.size
        taken[r.doc.source] += r.taken
        target[r.doc.source] = r.target
    for source, words in taken.items():
        assert abs(words - target[source]) <= 2 * apportionment.BLOCK_WORDS
    again = apportionment.mix(messy.repartition(7), keep=("doc_id", "source", "text")).collect()
    assert Counter(again) == Counter(got)
    assert apportionment.mix(messy.where("1 = 0")).count() == 0


def test_quotas_of_small_sources_beside_a_large_one():
    rows = apportionment.source_quotas(
        {"large": 1_024_000_000, "small": 2500, "tiny": 20, None: 0}, (1, 5, 5), 1.5, 2.0)
    assert [r[0] for r in rows] == ["large", "small", "tiny", None]
    assert rows[0][2] == 1_024_000_000 // (64 * 8192) and {r[2] for r in rows[1:]} == {1}
    assert [r[4] for r in rows[1:]] == [5000, 40, 0]
    assert all(abs(r[5] - r[4]) <= 1 and r[5] <= 2 * r[3] for r in rows)


def test_shards_get_whole_blocks():
    rng = np.random.default_rng(2)
    words = rng.integers(0, 40_000, 3000)
    words[:40] = rng.integers(0, 90, 40)
    for seats in (1, 64, int(words.sum()) // 3, 2 * int(words.sum())):
        held = pd.DataFrame({"_part": 3, "_shard": np.arange(3000), "_seats": seats,
                             "_words": words})
        got = apportionment.shard_quotas(held.sample(frac=1, random_state=1))
        quota = got["_quota"].to_numpy()
        assert got["_shard"].tolist() == list(range(3000)) and quota.sum() == seats
        assert (quota <= 2 * got["_words"]).all()
        share = got["_words"].to_numpy() * (seats / words.sum())
        assert np.abs(quota - share).max() <= 2 * apportionment.BLOCK_WORDS
        if seats < words.sum():
            assert (quota % apportionment.BLOCK_WORDS != 0).sum() <= apportionment.BLOCK_WORDS


def test_equal_shards_take_no_step_each():
    seats = apportionment.sainte_lague([7.0] * 200_000, 300_001, [9] * 200_000)
    assert sum(seats) == 300_001 and seats == sorted(seats, reverse=True) and seats[0] == 2


def test_small_sources_get_their_target(spark, monkeypatch):
    monkeypatch.setattr(apportionment, "BLOCKS_PER_SHARD", 2)
    rows = [(i, "big word " * 400, "large") for i in range(100)]
    rows += [(1000 + i, "few short words " * 8 + "end", "small") for i in range(100)]
    rows += [(2000, "one text of less than half a block", "tiny"), (2001, "no source", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    for share in (0.4, 1.5):
        taken, target = Counter(), {}
        for r in apportionment.mix(df, keep=("doc_id", "source"), share=share).collect():
            assert 0 <= r.taken <= 2 * r.size
            taken[r.doc.source] += r.taken
            target[r.doc.source] = r.target
        assert len(target) == 4
        assert all(abs(taken[s] - target[s]) <= 1 for s in target), (taken, target)


def test_copies_keep_the_columns(messy):
    out = apportionment.copies(messy)
    assert out.columns == messy.columns
    times = Counter(r.doc_id for r in out.collect())
    assert times and max(n for d, n in times.items() if d != 5) <= 2
    assert not {20, 21, 22} & set(times)


def test_rows_of_one_id_are_drawn_one_by_one(spark):
    """A source whose rows have no id, or one, gets its target; copies do not lie side by side."""
    rows = [(None if i % 2 else 7, f"{i} " + "word " * 99, "hot") for i in range(1500)]
    rows += [(10_000 + i, f"n{i} " + "word " * 99, "other") for i in range(1500)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    mixed = apportionment.mix(df, keep=("doc_id", "source"), share=1.1).collect()
    target = {r.doc.source: r.target / 100 for r in mixed}
    out = apportionment.copies(df, share=1.1).withColumn("part", F.spark_partition_id()).collect()
    times = Counter(r.source for r in out)
    assert all(abs(times[s] - target[s]) <= 0.05 * target[s] for s in target), (times, target)
    beside = sum(a.part == b.part and a.text == b.text for a, b in zip(out, out[1:], strict=False))
    assert max(Counter(r.text for r in out).values()) == 2 and beside < 20
    again = apportionment.copies(df.repartition(3), share=1.1).collect()
    assert Counter(r.text for r in again) == Counter(r.text for r in out)


def test_impossible_share():
    with pytest.raises(ValueError, match="twice"):
        apportionment.mix(None, most=3)


BASE = {("gnu", "general", "public", "license"): "gpl", ("apache", "license"): "apache",
        ("cc", "by"): "cc-by", ("mit", "license"): "mit"}


def test_base_phrases_begin_where_they_are_written(spark):
    texts = ["under the GNU General Public License v3, or the GNU General Public License v2",
             "the lesser general public license", "gnu affero general public license",
             "general public license", "gnu apache license", "MIT License cc by", "cc gnu"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    for r in df.select("text", licence_automaton.scanned(F.col("text")).alias("f")).collect():
        words = WORD.findall(r.text.lower())
        found = [(i, label) for p, label in BASE.items() for i in range(len(words))
                 if tuple(words[i:i + len(p)]) == p]
        places = [i for i, _ in found]
        assert (r.f.n_base, r.f.first_word, r.f.last_word) == (
            len(found), min(places, default=None), max(places, default=None))
        assert r.f.base_labels == ",".join(sorted({label for _, label in found}))
