"""Language identification with a blended-spectrum string kernel.

A passage is the set of its byte n-grams (of several lengths, hashed). Two passages have the
number of common n-grams as kernel, divided by the root of the product of the set sizes. The
Nystroem method maps passages to landmarks, kernel ridge regression fits one scorer per
language against the rest, and as all this is linear in the presence vector, scoring is one
matrix product for a batch of passages.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakejobs.llm import arrow_text, sampling

GRAMS = (1, 2, 3, 4)
BITS = 13
PASSAGE_BYTES = 2048
SHARPNESS = 6.0

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def presence(raw: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The n-gram presence of passages: one row of zeros and ones for each."""
    out = np.zeros((len(begin), 1 << BITS), np.uint8)
    if len(begin) == 0 or end[-1] == begin[0]:
        return out
    low, high = begin[0], end[-1]
    text = LOWER[raw[low:high]].astype(np.uint32)
    owner = np.repeat(np.arange(len(begin), dtype=np.int64) << BITS, end - begin)
    last = np.repeat(end - low, end - begin)
    place = np.arange(len(text))
    rolling = np.zeros(len(text), np.uint32)
    flat = out.reshape(-1)
    for n in range(1, max(GRAMS) + 1):
        size = len(text) - n + 1
        if size <= 0:
            break
        rolling = rolling[:size] * np.uint32(257) + text[n - 1:] + np.uint32(1)
        if n not in GRAMS:
            continue
        bucket = ((rolling * np.uint32(0x9E3779B1)) ^ np.uint32(n)) >> np.uint32(32 - BITS)
        inside = place[:size] + n <= last[:size]
        flat[(owner[:size] + bucket)[inside]] = 1
    return out


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    weights: np.ndarray  # n-gram bucket x language
    bias: np.ndarray


def fit(texts: list[str], languages: list[str], landmarks: int = 160,
        ridge: float = 1e-2) -> LanguageModel:
    """Nystroem features of evenly chosen landmark passages, then ridge regression."""
    names = sorted(set(languages))
    if not names:
        return LanguageModel([], np.zeros((1 << BITS, 0), np.float32), np.zeros(0, np.float32))
    raw, at = arrow_text.utf8(pa.array(texts, pa.string()))
    seen = presence(raw, at[:-1], at[1:]).astype(np.float32)
    seen /= np.sqrt(np.maximum(seen.sum(1, keepdims=True), 1))
    order = np.argsort([names.index(x) for x in languages], kind="stable")
    chosen = order[np.unique(np.linspace(0, len(order) - 1, min(landmarks, len(order)))
                             .astype(int))]
    marks = seen[chosen]
    values, vectors = np.linalg.eigh((marks @ marks.T).astype(np.float64))
    good = values > 1e-6 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])
    features = np.hstack([seen @ marks.T @ root, np.ones((len(seen), 1))])
    target = np.where(np.array(languages)[:, None] == np.array(names), 1.0, -1.0)
    share = np.array([languages.count(x) for x in names], float)
    weight = 1 / share[[names.index(x) for x in languages]]
    weighted = features * weight[:, None] / weight.sum()
    solution = np.linalg.solve(
        weighted.T @ features + ridge / len(names) * np.eye(features.shape[1]),
        weighted.T @ target)
    return LanguageModel(
        names, (marks.T @ (root @ solution[:-1])).astype(np.float32),
        solution[-1].astype(np.float32))


def predict(texts: pa.Array, model: LanguageModel) -> tuple[np.ndarray, np.ndarray]:
    """Index of the best language and its score for whole texts.

    The scores of a text are the means over its passages, weighted by passage length."""
    raw, at = arrow_text.utf8(texts)
    owner, begin, end = arrow_text.passages(at, PASSAGE_BYTES)
    total = np.zeros((len(texts), len(model.languages)))
    for part in arrow_text.groups(begin, end):
        seen = presence(raw, begin[part], end[part]).astype(np.float32)
        norm = np.sqrt(np.maximum(seen.sum(1, keepdims=True), 1))
        scores = (seen @ model.weights) / norm + model.bias
        share = np.maximum(end[part] - begin[part], 1)
        np.add.at(total, owner[part], scores * share[:, None])
    total /= np.maximum(np.diff(at), 1)[:, None]
    odds = np.exp(SHARPNESS * (total - total.max(1, keepdims=True)))
    best = total.argmax(1)
    return best, (odds.max(1) / odds.sum(1))


def learn(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang", per_language: int = 300,
          passage_chars: int = 2000) -> LanguageModel:
    """Fit on up to ``per_language`` rows of each language outside the held-out share.

    From each chosen text one passage of ``passage_chars`` is taken, at a place set by a hash."""
    rows = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{lang_col}`").alias("lang"),
        F.col(f"`{text_col}`").alias("text"),
    ).where(~sampling.held_out(F.col("doc_id")) & F.col("lang").isNotNull()
            & F.col("text").rlike(r"\p{L}"))
    spare = F.greatest(F.lit(1), F.length("text") - passage_chars)
    place = F.pmod(F.xxhash64("doc_id", F.lit("passage")), spare).cast("int") + 1
    rows = rows.select("doc_id", "lang", F.substring("text", place, F.lit(passage_chars))
                       .alias("passage"))
    chosen = sampling.first_by_hash(rows, "lang", "doc_id", per_language)
    sample = sorted(chosen.select("lang", "doc_id", "passage").collect(),
                    key=lambda r: (r.lang, r.doc_id, r.passage))
    return fit([r.passage for r in sample], [r.lang for r in sample])


def identified(text: Column, model: LanguageModel) -> Column:
    """Struct of ``lang_pred`` and ``score`` (0 to 1) of a whole text.

    A null text, a text without a letter, and any text where no language was learnt, is
    ``und`` with score 0."""
    if not model.languages:
        return F.struct(F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))

    @F.arrow_udf("lang_pred string, score double")
    def score_texts(texts: pa.Array) -> pa.Array:
        best, score = np.zeros(len(texts), int), np.zeros(len(texts))
        for begin, part in arrow_text.slices(texts):
            stop = begin + len(part)
            best[begin:stop], score[begin:stop] = predict(part, model)
        names = pa.array(model.languages, pa.string()).take(pa.array(best))
        return pa.StructArray.from_arrays(
            [names, pa.array(score, pa.float64())], ["lang_pred", "score"])

    scored = score_texts(text)
    letters = F.coalesce(text.rlike(r"\p{L}"), F.lit(False))
    return F.struct(
        F.when(letters, scored["lang_pred"]).otherwise("und").alias("lang_pred"),
        F.when(letters, scored["score"]).otherwise(0.0).alias("score"))


def identify(docs: DataFrame, model: LanguageModel, text_col: str = "text",
             out: str = "language") -> DataFrame:
    """Add the struct of :func:`identified` as column ``out``, which replaces one of that name."""
    return docs.withColumn(out, identified(F.col(f"`{text_col}`"), model))
