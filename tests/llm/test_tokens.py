import zlib
import time
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from corpus_fixtures import messy, nothing, shipped, texts  # noqa: F401
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakejobs.llm import token_counts, vector_packing

WORD, BYTE = (public_tokenizers.path(p) for p in ("word_bpe_49k.json", "byte_bpe_50k.json"))


def test_counts_are_those_of_the_library(messy):
    slow = Tokenizer.from_file(WORD)
    got = messy.select("text", token_counts.token_count(F.col("text"), WORD).alias("n")).collect()
    assert len(got) == messy.count()
    for r in got:
        assert r.n == len(slow.encode(r.text or "", add_special_tokens=False).ids), r.text


def test_long_texts_are_cut_at_spaces_only():
    text = "alpha beta " * 50 + "x" * 400 + " end"
    batches = list(token_counts.balanced([None, text, "", "b"], limit=64))
    assert "".join(c for b in batches for r, c in b if r == 1) == text
    assert all(not c.startswith("x") and len(c) < 470 for b in batches for _, c in b)
    whole = token_counts.PieceLengths(WORD)
    totals = np.zeros(4, np.int64)
    for b in batches:
        whole.count(b, totals)
    want = len(whole.tokenizer.encode(text, add_special_tokens=False).ids)
    assert totals.tolist()[:3] == [0, want, 0]


def test_memo_stays_bounded(monkeypatch):
    monkeypatch.setattr(token_counts, "MEMO_ENTRIES", 50)
    counter = token_counts.PieceLengths(WORD)
    totals = np.zeros(1, np.int64)
    for i in range(20):
        counter.count([(0, " ".join(f"w{i}q{j}" for j in range(30)))], totals)
    text = " ".join(f"w{i}q{j}" for i in range(20) for j in range(30))
    assert totals[0] == len(counter.tokenizer.encode(text, add_special_tokens=False).ids)
    assert len(counter.memo) < 200


def test_empty_tables(nothing):
    assert nothing.select(token_counts.token_count(F.col("text"), WORD)).count() == 0
    assert vector_packing.pack_documents(nothing, BYTE).count() == 0


def test_every_id_lies_in_one_piece(messy, texts):
    slow = Tokenizer.from_file(BYTE)
    rows = vector_packing.pack_documents(messy, BYTE, max_tokens=256, max_segments=8).collect()
    docs, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        docs[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    for key, text in [*texts.items(), (None, "no id here at all")]:
        ids = np.array([*slow.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        times = 2 if key == 5 else 1
        assert sum(r.length for r in docs[key]) == times * len(ids)
        seen = np.zeros(len(ids), int)
        for r in docs[key]:
            seen[r.start:r.start + r.length] += 1
            assert r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[r.start:r.start + r.length].tobytes())
        assert (seen == times).all()
    padding = 0
    for pieces in sequences.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 256 and len(pieces) <= 8
        padding += 0 if at & (at - 1) == 0 else 256 - at
    assert padding <= 256 * 6


def test_examples_keep_all_limits(spark):
    rng = np.random.default_rng(0)
    rows = [(i, int(t), int(rng.integers(0, t + 1))) for i, t in enumerate(rng.integers(1, 900, 500))]
    df = spark.createDataFrame(rows, "id long, tokens long, loss long").repartition(2)
    got = vector_packing.pack_examples(
        df, id_col="id", tokens_col="tokens", loss_col="loss", max_tokens=1000, max_segments=4,
        max_loss=600 + 300, window=100).collect()
    assert sorted((r.example_id, r.tokens, r.loss_tokens) for r in got) == rows
    by = defaultdict(list)
    for r in got:
        by[r.sequence_id].append(r)
    for v in by.values():
        assert sum(r.tokens for r in v) <= 1000 and sum(r.loss_tokens for r in v) <= 900
        assert len(v) <= 4 and sorted(r.segment for r in v) == list(range(len(v)))
    assert len(by) <= 1.25 * sum(r[1] for r in rows) / 1000


def test_example_beyond_a_limit_is_an_error(spark):
    df = spark.createDataFrame([(1, 2000, 5)], "id long, tokens long, loss long")
    with pytest.raises(Exception, match="no sequence can hold"):
        vector_packing.pack_examples(df, id_col="id", tokens_col="tokens", loss_col="loss",
                                     max_tokens=1000, max_segments=4, max_loss=10).collect()


def test_dot_product_prefers_what_fills_the_open_dimension():
    pool = vector_packing.Pool((100, 4, 100))
    pool.add("little loss", 50, 0)
    pool.add("much loss", 50, 50)
    assert pool.best(np.array([100.0, 4, 10]), True) == 0
    assert pool.best(np.array([60.0, 4, 100]), True) == 1
    assert pool.best(np.array([40.0, 4, 100]), True) == -1


def test_choice_is_the_largest_product_of_all_that_wait():
    """Buckets choose as a scan of every waiting example does, the first of equal demand first."""
    rng = np.random.default_rng(4)
    limits = np.array([60.0, 5, 40])
    pool = vector_packing.Pool((60, 5, 40))
    waiting = {}
    for i in range(400):
        tokens = int(rng.integers(1, 60))
        waiting[i] = (tokens, int(rng.integers(0, min(tokens, 40) + 1)))
        pool.add(f"e{i}", *waiting[i])
    while waiting:
        left, taken = limits.copy(), []
        for key, tokens, loss in vector_packing.fill(pool, False):
            fit = {i: (left / limits * np.array([t, 1, n]) / limits).sum()
                   for i, (t, n) in waiting.items() if t <= left[0] and n <= left[2]}
            at = int(key[1:])
            assert waiting[at] == (tokens, loss) and fit[at] >= max(fit.values()) - 1e-9
            assert at == min(i for i in fit if waiting[i] == waiting[at])
            left -= (tokens, 1, loss)
            taken.append(waiting.pop(at))
        assert taken and (left >= 0).all()


def test_many_short_documents_take_linear_time():
    packer = vector_packing.Packer(2048, 256, 2048)
    assert not [s for i in range(60_000) for s in packer.put(i, 3 + i % 2)]
    begin = time.time()
    pieces = [p for s in packer.flush(True) for p in s]
    assert time.time() - begin < 30
    held = defaultdict(list)
    for key, start, length in pieces:
        held[key].append((start, length))
    for key, parts in held.items():
        at = 0
        for start, length in sorted(parts):
            assert start == at
            at += length
        assert at == 3 + key % 2
    assert len(held) == 60_000 and not packer.docs
