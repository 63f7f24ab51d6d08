"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages. Every passage is encoded (how bytes of different kinds follow
one another, and how much repeats), gated attention weighs the encoded passages, and the
weighted mean is scored. Weights are learnt from document labels alone, by Adam, on a bounded
sample whose passage features the executors compute.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakejobs.llm import arrow_text, sampling

PASSAGE_BYTES = 512
HIDDEN, ATTENTION = 24, 12
TRIGRAM_BITS = 10
KINDS = 14


def _kinds() -> np.ndarray:
    """The kind of each byte: letters by case, digits, white space, and groups of signs."""
    kind = np.full(256, 13, np.int64)
    for i, signs in enumerate([b" ", b"\n\r\t", b".,;:", b"!?", b"'\"-", b"()[]{}<>",
                               b"*#_~`", b"|/\\", b"%$&@+="]):
        kind[list(signs)] = i
    kind[48:58], kind[65:91], kind[97:123], kind[128:] = 9, 10, 11, 12
    return kind


KIND = _kinds()
FEATURES = KINDS * KINDS + KINDS + 5


def passage_features(raw: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Features of passages that stand one behind another in ``raw``."""
    n = len(begin)
    out = np.zeros((n, FEATURES), np.float32)
    low, high = (begin[0], end[-1]) if n else (0, 0)
    if high == low:
        return out
    text, size = raw[low:high], end - begin
    owner = np.repeat(np.arange(n), size)
    kind = KIND[text]
    length = np.maximum(size, 1)[:, None]
    out[:, :KINDS] = np.bincount(
        owner * KINDS + kind, minlength=n * KINDS).reshape(n, KINDS) / length
    same = owner[1:] == owner[:-1]
    pair = (owner[1:] * KINDS + kind[:-1]) * KINDS + kind[1:]
    out[:, KINDS:-5] = np.sqrt(np.bincount(
        pair[same], minlength=n * KINDS * KINDS).reshape(n, -1) / length)
    wide = text.astype(np.uint32)
    if len(text) > 2:
        gram = (wide[:-2] * np.uint32(66049) + wide[1:-1] * np.uint32(257) + wide[2:]) \
            * np.uint32(0x9E3779B1) >> np.uint32(32 - TRIGRAM_BITS)
        seen = np.zeros((n, 1 << TRIGRAM_BITS), bool)
        whole = owner[2:] == owner[:-2]
        seen[owner[2:][whole], gram[whole]] = True
        out[:, -5] = seen.sum(1) / length[:, 0]
    starts, ends, text_of = arrow_text.runs((kind != 0) & (kind != 1), np.append(begin, high) - low)
    words = np.maximum(np.bincount(text_of, minlength=n), 1)
    hashes = arrow_text.span_hashes(text, starts, ends)
    for i, step in ((-4, 1), (-3, 2)):
        again = (hashes[step:] == hashes[:-step]) & (text_of[step:] == text_of[:-step])
        out[:, i] = np.bincount(text_of[step:][again], minlength=n) / words
    out[:, -2] = np.minimum(size / words, 40) / 10
    out[:, -1] = np.log1p(size) / 10
    return out


def bags(texts: pa.Array):
    """(first text, texts, owner of each passage, passage features) of runs of whole texts."""
    for first, part in arrow_text.slices(texts):
        raw, at = arrow_text.utf8(part)
        owner, begin, end = arrow_text.passages(at, PASSAGE_BYTES)
        blocks = [passage_features(raw, begin[g], end[g]) for g in arrow_text.groups(begin, end)]
        yield first, len(part), owner, np.concatenate(blocks)


@dataclass
class AttentionModel:
    mean: np.ndarray
    scale: np.ndarray
    params: dict[str, np.ndarray]

    def forward(self, features: np.ndarray, owner: np.ndarray, n: int) -> dict:
        """All layers; ``owner`` is sorted and names the bag of each passage."""
        p = self.params
        x = np.clip((features - self.mean) / self.scale, -8, 8)
        h = np.tanh(x @ p["w"] + p["b"])
        tan = np.tanh(h @ p["v"])
        gate = 1 / (1 + np.exp(-(h @ p["u"])))
        raw = (tan * gate) @ p["a"]
        first = np.searchsorted(owner, np.arange(n))
        top = np.maximum.reduceat(raw, first)
        power = np.exp(raw - top[owner])
        share = power / np.add.reduceat(power, first)[owner]
        bag = np.add.reduceat(share[:, None] * h, first)
        logit = bag @ p["c"] + p["d"][0]
        return {"x": x, "h": h, "tan": tan, "gate": gate, "share": share, "bag": bag,
                "first": first, "score": 1 / (1 + np.exp(-np.clip(logit, -30, 30)))}

    def gradients(self, f: dict, owner: np.ndarray, label: np.ndarray,
                  weight: np.ndarray) -> dict[str, np.ndarray]:
        p = self.params
        error = (f["score"] - label) * weight
        bag = error[:, None] * p["c"]
        h = f["share"][:, None] * bag[owner]
        pull = (bag[owner] * f["h"]).sum(1)
        raw = f["share"] * (pull - np.add.reduceat(f["share"] * pull, f["first"])[owner])
        both = raw[:, None] * p["a"]
        tan = both * f["gate"] * (1 - f["tan"] ** 2)
        gate = both * f["tan"] * f["gate"] * (1 - f["gate"])
        h = (h + tan @ p["v"].T + gate @ p["u"].T) * (1 - f["h"] ** 2)
        return {"w": f["x"].T @ h, "b": h.sum(0), "v": f["h"].T @ tan, "u": f["h"].T @ gate,
                "a": (f["tan"] * f["gate"]).T @ raw, "c": f["bag"].T @ error,
                "d": np.array([error.sum()])}


def fit(features: np.ndarray, owner: np.ndarray, label: np.ndarray, *, epochs: int = 60,
        batch: int = 64, rate: float = 0.004, decay: float = 1e-4) -> AttentionModel:
    """Minimise the cross-entropy of the labels, each label weighing the same."""
    rng = np.random.default_rng(7)
    sizes = {"w": (FEATURES, HIDDEN), "b": (HIDDEN,), "v": (HIDDEN, ATTENTION),
             "u": (HIDDEN, ATTENTION), "a": (ATTENTION,), "c": (HIDDEN,), "d": (1,)}
    params = {k: rng.normal(0, s[0] ** -0.5, s) for k, s in sizes.items()}
    model = AttentionModel(features.mean(0), np.maximum(features.std(0), 1e-3), params)
    share = np.array([max((label == v).sum(), 1) for v in (0, 1)])
    weight = len(label) / 2 / share[label.astype(int)]
    first = np.searchsorted(owner, np.arange(len(label)))
    stop = np.append(first[1:], len(owner))
    moments = {k: (np.zeros(s), np.zeros(s)) for k, s in sizes.items()}
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(label))
        pace = rate * 0.5 * (1 + np.cos(np.pi * epoch / epochs))
        for at in range(0, len(order), batch):
            docs = order[at:at + batch]
            rows = np.concatenate([np.arange(first[i], stop[i]) for i in docs])
            own = np.repeat(np.arange(len(docs)), stop[docs] - first[docs])
            f = model.forward(features[rows], own, len(docs))
            step += 1
            for k, g in model.gradients(f, own, label[docs], weight[docs]).items():
                g = g / len(docs) + decay * params[k]
                m, v = moments[k]
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                params[k] -= pace * (m / (1 - 0.9 ** step)) / (
                    np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return model


def encoded(text: Column, most: int) -> Column:
    """Passage features of a text, as float32 bytes; of more than ``most`` passages, as many that
    are spread evenly over the whole text."""

    @F.arrow_udf("binary")
    def encode(texts: pa.Array) -> pa.Array:
        out = []
        for _, n, owner, features in bags(texts):
            cut = np.searchsorted(owner, np.arange(n + 1))
            for low, high in zip(cut[:-1], cut[1:], strict=True):
                some = np.linspace(low, high - 1, min(most, high - low)).astype(int)
                out.append(features[some].tobytes())
        return pa.array(out, pa.binary())

    return encode(text)


def learn(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", per_label: int = 1500,
          most_passages: int = 128) -> AttentionModel | None:
    """Fit on up to ``per_label`` labelled documents of each label outside the held-out share, and
    on up to ``most_passages`` of each, so what the driver holds is bounded.

    None where no document has a label. A document with both labels in repeated label rows
    counts under both. Of rows that repeat an id, one is learnt from: that with the smallest hash
    of its text."""
    marks = labels.select(F.col(f"`{id_col}`").alias("doc_id"),
                          F.col(f"`{label_col}`").cast("int").alias("label"))
    marks = marks.where(F.col("label").isin(0, 1) & ~sampling.held_out(F.col("doc_id"))).distinct()
    texts = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    # Ids are matched before any text moves: up to a fixed number of them, as literals.
    known = marks.join(texts.select("doc_id"), "doc_id", "left_semi")
    ids = sampling.first_by_hash(known, "label", "doc_id", per_label).collect()
    if not ids:
        return None
    label = {}
    for row in ids:
        label.setdefault(row.doc_id, set()).add(row.label)
    bounded = texts.where(F.col("doc_id").isin(list(label)))
    one = sampling.first_by_hash(
        bounded.withColumn("text_hash", F.xxhash64("text")), "doc_id", "text_hash", 1)
    sample = sorted(one.select("doc_id", encoded(F.col("text"), most_passages).alias("bag"))
                    .collect(), key=lambda r: (r.doc_id, r.bag))
    marked = [(np.frombuffer(r.bag, np.float32).reshape(-1, FEATURES), v)
              for r in sample for v in sorted(label[r.doc_id])]
    owner = np.repeat(np.arange(len(marked)), [len(b) for b, _ in marked])
    return fit(np.concatenate([b for b, _ in marked]), owner,
               np.array([v for _, v in marked], float))


def quality_score(text: Column, model: AttentionModel | None) -> Column:
    """Probability of label 1 for a whole text; null counts as empty. 0.5 without a model."""
    if model is None:
        return F.lit(0.5)

    @F.arrow_udf("double")
    def score_texts(texts: pa.Array) -> pa.Array:
        out = [model.forward(features, owner, n)["score"] for _, n, owner, features in bags(texts)]
        return pa.array(np.concatenate(out) if out else np.zeros(0), pa.float64())

    return score_texts(text)
