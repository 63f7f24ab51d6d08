"""Hard negatives for contrastive training, with Fagin's threshold algorithm.

Candidates lie in blocks. In a block, every dimension has its list of candidates in the order of
that component. An anchor reads the lists side by side, from the top where its own component
is positive, from the bottom where it is negative, and scores each candidate it meets by its whole
vector. What it has not met can score no more than the sum of the products at the depth
reached: once this threshold is strictly below the k-th score of each wanted window, the block
is done. Scores are whole numbers, so results are exact.

Anchors stream past the blocks: a vector is shuffled once a pass, an anchor once a block it has to
see. The first pass finds positives within blocks of one label, the second, negatives in windows
below each positive's score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 8192
FIRST_DEPTH = 32
SCALE = 256
LARGEST = 1 << 26  # of a component's absolute value; a product of two vectors stays a long


@dataclass
class Want:
    """The k best rows with a score from low to high."""

    low: float
    high: float
    k: int


class Lists:
    """A block of whole-number vectors with one sorted list for each dimension."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, values: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.labels, self.values = ids[order], labels[order], values[order]
        self.order = np.argsort(self.values, axis=0, kind="stable")
        self.sorted = np.take_along_axis(self.values, self.order, 0)
        self.largest = int(np.abs(self.values).max(initial=0))
        self.floats = self.values.astype(float)

    def scores(self, rows: np.ndarray, anchor: np.ndarray) -> np.ndarray:
        """Exact products: in doubles where they stay below 2**53, else in longs."""
        if self.largest * int(np.abs(anchor).max(initial=0)) * max(1, len(anchor)) < 1 << 53:
            return (self.floats[rows] @ anchor.astype(float)).astype(np.int64)
        return (self.values[rows] * anchor).sum(1)

    def best(self, anchor: np.ndarray, wanted: list[Want], allowed: np.ndarray):
        """The rows that each window wants, best first, ties to the smaller id."""
        n = len(self.ids)
        up, down = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        met = np.zeros(n, bool)
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in wanted]
        depth, step = 0, FIRST_DEPTH
        if not len(up) and not len(down):  # no list bears on a score: all are 0
            depth, step = n, 0
            found = self._merged(found, np.flatnonzero(allowed), anchor, wanted)
        while depth < n:
            end = min(n, depth + step)
            fresh = np.zeros(n, bool)
            fresh[self.order[n - end:n - depth, up].ravel()] = True
            fresh[self.order[depth:end, down].ravel()] = True
            fresh &= ~met
            met |= fresh
            found = self._merged(found, np.flatnonzero(fresh & allowed), anchor, wanted)
            threshold = int((self.sorted[n - end, up] * anchor[up]).sum()
                            + (self.sorted[end - 1, down] * anchor[down]).sum())
            if all(threshold < (scores[-1] if len(scores) == want.k else want.low)
                   for want, (_, scores) in zip(wanted, found, strict=True)):
                break
            depth, step = end, 2 * step
        return found

    def _merged(self, found, rows, anchor, wanted):
        """What the windows held, with newly met rows."""
        scores = self.scores(rows, anchor)
        out = []
        for want, (old, old_scores) in zip(wanted, found, strict=True):
            fits = (scores >= want.low) & (scores <= want.high)
            every = np.concatenate([old, rows[fits]])
            of_every = np.concatenate([old_scores, scores[fits]])
            # Rows are in the order of ids.
            first = np.lexsort((every, -of_every))[:want.k]
            out.append((every[first], of_every[first]))
        return out


def whole(vector: Column) -> Column:
    """Components as floor(256 x), x as double; null where the vector takes no part."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (
        F.abs(x) * SCALE >= F.lit(float(LARGEST))))
    return F.when(vector.isNotNull() & ~bad, F.transform(
        vector, lambda x: F.floor(x * F.lit(float(SCALE)))))


def prepared(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding",
             label_col: str = "label") -> DataFrame:
    """(vec_id, label, vector) of the rows that take part, whole-number components.

    Those without id, label or vector, with a component that is null, not finite or 2**18 or
    more in size, or with another than the most frequent dimension take no part. Of rows that share
    an id, that with the least label and then vector takes part."""
    rows = vectors.select(
        F.col(f"`{id_col}`").cast("long").alias("vec_id"),
        F.col(f"`{label_col}`").cast("long").alias("label"),
        whole(F.col(f"`{vector_col}`").cast("array<double>")).alias("vector"),
    ).where("vec_id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL")
    common = rows.groupBy(F.size("vector").alias("n")).count().orderBy(
        F.desc("count"), "n").first()
    rows = rows.where(F.size("vector") == (common.n if common else 0))
    return rows.groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("row")).select(
        "vec_id", "row.label", "row.vector")


PASSED = "anchor_id long, positive_id long, positive_score long, vec_id long, score long"
ROW = "group long, block long, anchor boolean, vec_id long, label long, vector array<long>, " \
      "wants array<struct<vec_id:long,score:long>>"


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1 if len(flat) else 0)


def _pass(search):
    """Run ``search(lists, id, label, vector, wants)`` for the anchors that follow each block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, parts, lists = None, [], None
        for batch in batches:
            group, block, anchor, ids, labels = (batch.column(i).to_numpy(zero_copy_only=False)
                                                 for i in range(5))
            values = _matrix(batch.column(5))
            edge = np.flatnonzero((np.diff(group) != 0) | (np.diff(block) != 0)
                                  | (np.diff(anchor.astype(np.int8)) != 0)) + 1
            for begin, end in zip(np.r_[0, edge], np.r_[edge, len(ids)], strict=True):
                if begin == end:
                    continue
                if place != (group[begin], block[begin]):
                    place, parts, lists = (group[begin], block[begin]), [], None
                rows = slice(begin, end)
                if not anchor[begin]:
                    parts.append((ids[rows], labels[rows], values[rows]))
                    continue
                if not parts and lists is None:
                    continue
                if lists is None:
                    lists = Lists(*(np.concatenate(c) for c in zip(*parts, strict=True)))
                    parts = []
                wants = batch.column(6).slice(begin, end - begin).to_pylist()
                out = [r for i, w in zip(range(begin, end), wants, strict=True)
                       for r in search(lists, int(ids[i]), int(labels[i]), values[i], w)]
                columns = list(zip(*out, strict=True)) if out else [[]] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns],
                    ["anchor_id", "positive_id", "positive_score", "vec_id", "score"])

    return run


def _streamed(vectors: DataFrame, anchors: DataFrame, parts: int, search) -> DataFrame:
    names = ["group", "block", "anchor", "vec_id", "label", "vector", "wants"]
    return vectors.select(names).union(anchors.select(names)) \
        .repartition(parts, "group", "block") \
        .sortWithinPartitions("group", "block", "anchor", "vec_id") \
        .mapInArrow(_pass(search), PASSED)


def mine(rows: DataFrame, is_anchor: Column, *, positives: int = 5, negatives: int = 3,
         low: int = 50, high: int = 95) -> DataFrame:
    """For each anchor and each of its first positives, the first negatives in its window.

    ``rows`` are as ``prepared`` gives them; a negative has another label than its anchor, and
    100 times its score lies between ``low`` and ``high`` times that of the positive. More score
    comes first, then the smaller id. An anchor without positives, and a positive without
    negatives, gives no row."""
    many = rows.count()
    blocks = -(-many // BLOCK) or 1
    none = F.lit(None).cast("array<struct<vec_id:long,score:long>>")

    # Blocks of one label: as many as its rows need, and at least one.
    sizes = rows.groupBy("label").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    dealt = rows.join(sizes, "label")
    own = F.pmod(F.xxhash64("vec_id"), F.col("blocks"))
    same = dealt.select(F.col("label").alias("group"), own.alias("block"),
                        F.lit(False).alias("anchor"), "vec_id", "label", "vector",
                        none.alias("wants"))
    asking = dealt.where(is_anchor).select(
        F.col("label").alias("group"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
        .alias("block"), F.lit(True).alias("anchor"), "vec_id", "label", "vector",
        none.alias("wants"))

    def nearest(lists, anchor_id, label, vector, wants):
        (found, scores), = lists.best(vector, [Want(-np.inf, np.inf, positives)],
                                      lists.ids != anchor_id)
        for row, score in zip(found, scores, strict=True):
            yield anchor_id, None, None, int(lists.ids[row]), int(score)

    first = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "vec_id")
    known = _streamed(same, asking, blocks, nearest) \
        .withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= positives) \
        .groupBy("anchor_id").agg(F.collect_list(F.struct("vec_id", "score")).alias("wants"))

    mixed = rows.select(F.lit(0).cast("long").alias("group"),
                        F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).alias("block"),
                        F.lit(False).alias("anchor"), "vec_id", "label", "vector",
                        none.alias("wants"))
    asking = rows.where(is_anchor).join(known, F.col("vec_id") == F.col("anchor_id")).select(
        F.lit(0).cast("long").alias("group"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))
        .alias("block"), F.lit(True).alias("anchor"), "vec_id", "label", "vector", "wants")

    def below(lists, anchor_id, label, vector, wants):
        windows = [Want(-(-low * w["score"] // 100), high * w["score"] // 100, negatives)
                   for w in wants]
        held = [(w, want) for w, want in zip(wants, windows, strict=True) if want.low <= want.high]
        if not held:
            return
        found = lists.best(vector, [want for _, want in held], lists.labels != label)
        for (w, _), (rows_, scores) in zip(held, found, strict=True):
            for row, score in zip(rows_, scores, strict=True):
                yield anchor_id, w["vec_id"], w["score"], int(lists.ids[row]), int(score)

    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("score"), "vec_id")
    return _streamed(mixed, asking, blocks, below) \
        .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives).select(
            "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"),
            "positive_score", F.col("score").alias("negative_score"))
