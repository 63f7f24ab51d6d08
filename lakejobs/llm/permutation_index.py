"""Approximate nearest neighbours with a permutation index.

A vector is represented by the order in which its nearest pivots follow: as the rank of every
pivot. In a block of vectors, each vector is posted in the inverted files of its first pivots. A
query opens the files of its own first pivots, ranks what is posted there by the footrule
distance of the two orders, and the best are ranked again by their cosine on the original
vectors. Blocks of vectors meet blocks of queries; no vector is posted outside its block, so a
block's inverted files stay in memory and a hot pivot is spread over all blocks.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PIVOTS = 512
RANKS = 255  # pivots a representation holds; all others share the rank behind
POSTED, OPENED = 16, 40
BLOCK, QUERY_BLOCK = 8192, 1024
RERANKED = 1 / 24  # share of a block that is compared exactly, at least LEAST_RERANKED
LEAST_RERANKED = 200


def usable(vector: Column, dimension: int | None = None) -> Column:
    """Neither null nor empty nor zero, with finite components only, and of one dimension."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good = vector.isNotNull() & (F.size(vector) > 0) & ~bad & F.exists(vector, lambda x: x != 0)
    return good & (F.size(vector) == dimension) if dimension else good


def unit(vectors: np.ndarray) -> np.ndarray:
    scale = np.abs(vectors).max(1, keepdims=True)
    vectors = vectors / scale
    return vectors / np.sqrt((vectors * vectors).sum(1, keepdims=True))


def orders(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The rank of every pivot for every vector, nearest first; ties go to the first pivot."""
    near = np.argsort(-(unit(vectors) @ pivots.T), axis=1, kind="stable")[:, :RANKS]
    ranks = np.full((len(vectors), len(pivots)), RANKS, np.uint8)
    np.put_along_axis(ranks, near, np.arange(near.shape[1], dtype=np.uint8)[None, :], 1)
    return ranks


def choose_pivots(rows: DataFrame, vector: str, key: str, pivots: int = PIVOTS) -> np.ndarray:
    """Up to ``pivots`` different directions among the 4 x ``pivots`` rows with the smallest
    hash: a sample whose size is a parameter."""
    sample = rows.select(vector, key).orderBy(F.xxhash64(key), key).limit(4 * pivots).collect()
    if not sample:
        return np.zeros((0, 0))
    different = np.unique(np.array([r[0] for r in sample], float), axis=0)
    picked = np.random.default_rng(11).permutation(len(different))[:pivots]
    return unit(different[np.sort(picked)])


@dataclass
class Index:
    """Usable vectors with their representation, and the pivots it refers to."""

    rows: DataFrame  # vec_id, vector, ranks
    pivots: np.ndarray


def build(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding",
          pivots: int = PIVOTS) -> Index:
    """Index every usable row of the most frequent dimension; repeated ids are kept."""
    rows = vectors.select(
        F.col(f"`{id_col}`").cast("long").alias("vec_id"),
        F.col(f"`{vector_col}`").cast("array<double>").alias("vector"),
    ).where(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    common = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    dimension = common.n if common else 0
    rows = rows.where(F.size("vector") == dimension)
    marks = choose_pivots(rows, "vector", "vec_id", pivots)

    @F.arrow_udf("binary")
    def represent(column: pa.Array) -> pa.Array:
        if not len(column):
            return pa.array([], pa.binary())
        values = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
        parts = [orders(values[i:i + BLOCK], marks) for i in range(0, len(values), BLOCK)]
        return pa.array([r.tobytes() for p in parts for r in p], pa.binary())

    return Index(rows.withColumn("ranks", represent("vector")), marks)


def _arrays(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, vectors and ranks of a block, in the order of ids."""
    ids = table.column("vec_id").to_numpy()
    order = np.argsort(ids, kind="stable")
    flat = table.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    ranks = np.frombuffer(b"".join(table.column("ranks").to_pylist()), np.uint8)
    return (ids[order], flat.reshape(len(ids), -1)[order], ranks.reshape(len(ids), -1)[order])


def search_block(vectors: tuple, queries: tuple, k: int, posted_in: int, opens: int,
                 share: float):
    """The k best of one block for each query: (query id, vec id, cosine).

    A query whose files hold fewer than k candidates is compared with the whole block, so it
    finds k wherever there are so many."""
    ids, values, ranks = vectors
    posted = [np.flatnonzero(ranks[:, p] < posted_in) for p in range(ranks.shape[1])]
    size = np.sqrt((values * values).sum(1))
    least = max(LEAST_RERANKED, math.ceil(len(ids) * share), 4 * k)
    for query, vector, order in zip(*queries, strict=True):
        opened = np.flatnonzero(order < opens)
        mark = np.zeros(len(ids), bool)
        for pivot in opened:
            mark[posted[pivot]] = True
        mark[ids == query] = False
        found = np.flatnonzero(mark)
        if len(found) < k:
            found = np.flatnonzero(ids != query)
        if len(found) > least:
            held = ranks[found]
            footrule = (np.maximum(held, order) - np.minimum(held, order)).sum(1, dtype=np.int64)
            # Ties go to the smaller id, as rows are in the order of ids.
            key = footrule * len(ids) + np.arange(len(found))
            found = np.sort(found[np.argpartition(key, least - 1)[:least]])
        length = np.sqrt((vector * vector).sum())
        score = (values[found] * vector).sum(1) / (size[found] * length)
        best = np.lexsort((ids[found], -score))[:k]
        for i in best:
            yield int(query), int(ids[found[i]]), float(score[i])


def search(index: Index, is_query: Column, *, k: int = 5, posted: int = POSTED,
           opened: int = OPENED, reranked: float = RERANKED) -> DataFrame:
    """The k nearest found of every indexed row that is a query: query_id, rank, vec_id, score.

    A vector stands in the files of its ``posted`` nearest pivots, a query opens ``opened`` files,
    and the share ``reranked`` of a block is compared exactly; ``opened=RANKS + 1, reranked=1``
    opens all files and compares all they hold, which makes the search exact.

    Nearest by cosine first, ties to the smaller id; a query's own id is no candidate. Of rows
    that repeat a query's id, the least vector asks; as candidates all of them count. No query
    or no candidate gives no row."""
    rows = index.rows
    counts = rows.agg(F.count("*").alias("n"), F.count_if(is_query).alias("q")).first()
    blocks, chunks = -(-counts.n // BLOCK) or 1, -(-counts.q // QUERY_BLOCK) or 1

    def numbered(part: DataFrame, own: str, many: int, other: str, times: int) -> DataFrame:
        return part.withColumn(own, F.pmod(F.xxhash64("vec_id", F.lit(own)), F.lit(many))) \
            .withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(times - 1).cast("long"))))

    asking = rows.where(is_query).groupBy("vec_id").agg(
        F.min(F.struct("vector", "ranks")).alias("least")).select("vec_id", "least.*")
    left = numbered(rows, "block", blocks, "chunk", chunks)
    right = numbered(asking, "chunk", chunks, "block", blocks)

    def meet(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        found = []
        if vectors.num_rows and queries.num_rows:
            found = list(search_block(_arrays(vectors), _arrays(queries), k, posted, opened,
                                      reranked))
        columns = list(zip(*found, strict=True)) if found else [[], [], []]
        return pa.table({"query_id": pa.array(columns[0], pa.int64()),
                         "vec_id": pa.array(columns[1], pa.int64()),
                         "score": pa.array(columns[2], pa.float64())})

    near = left.groupBy("block", "chunk").cogroup(right.groupBy("block", "chunk")).applyInArrow(
        meet, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
