"""Mixing sources to target weights by Sainte-Laguë apportionment of equal blocks of words.

Blocks go to sources by highest quotients (target / 1, 3, 5, ...); a source's last block is cut
where it would go beyond its target, and the words this leaves go to those below theirs by the
same rule. Each source's blocks then go to its shards by the words the shards hold, so quotas of
shards are whole blocks but for the rest of a source. A source has as many shards as its own
words fill. In a shard the documents of a source stand in seeded order, twice one after another;
its quota is taken as evenly spaced blocks from a seeded start, the last of them in part, the
second pass only when the first is used up. So every word is taken twice at most, and each source
gets its quota to the word, however few and short its texts are.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_WORDS = 64
BLOCKS_PER_SHARD = 8192
BROADCAST_SOURCES = 1 << 16
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def sainte_lague(votes: list[float], seats: int, most: list[int]) -> list[int]:
    """Seats by highest quotients votes / (2 n + 1), ties to the first; nobody gets over ``most``.

    Giving seats while a quotient lies above a level equals rounding votes / (2 level); the level
    is narrowed by halving, and what then remains goes one by one to the highest quotients."""
    v, cap = np.array(votes, float), np.array(most, np.int64)
    seats = min(seats, int(cap[v > 0].sum()))
    got = np.zeros(len(v), np.int64)
    if seats <= 0:
        return got.tolist()

    def above(level: float) -> np.ndarray:
        return np.minimum(np.floor(v / (2 * level) + 0.5).astype(np.int64), cap)

    high = float(v.max()) * 2
    low = high
    while above(low).sum() < seats:
        low /= 2
    for _ in range(200):
        middle = (low + high) / 2
        if middle in (low, high):
            break
        if above(middle).sum() > seats:
            low = middle
        else:
            high = middle
    got = above(high)
    while (left := seats - int(got.sum())) > 0:
        quotient = np.where(got < cap, v / (2 * got + 1), -1.0)
        got[np.flatnonzero(quotient == quotient.max())[:left]] += 1
    return got.tolist()


def in_blocks(votes: list[float], words: int, most: list[int], exact: bool) -> list[int]:
    """Words by whole blocks of highest quotients, the rest by how far each is below its votes,
    which are in words. With ``exact`` no block goes beyond the votes."""
    wanted = np.array(votes, float)
    given = BLOCK_WORDS * np.array(
        sainte_lague(votes, words // BLOCK_WORDS, [m // BLOCK_WORDS for m in most]), np.int64)
    if exact:
        given = np.minimum(given, np.floor(wanted).astype(np.int64))
    rest = sainte_lague(np.maximum(wanted - given, 0).tolist(), words - int(given.sum()),
                        (np.array(most, np.int64) - given).tolist())
    return (given + np.array(rest, np.int64)).tolist()


def targets(sizes: list[int], weights: list[float], share: float, most: float) -> list[float]:
    """Shares of ``share`` times all words by weight; none above ``most`` times its source, the
    excess being shared again by weight."""
    total = share * sum(sizes)
    out = [0.0] * len(sizes)
    free = [i for i, s in enumerate(sizes)]
    while free:
        weight = sum(weights[i] for i in free)
        over = {i for i in free if total * weights[i] / weight > most * sizes[i]}
        for i in over or free:
            out[i] = most * sizes[i] if over else total * weights[i] / weight
        total -= sum(out[i] for i in over)
        free = [i for i in free if over and i not in over]
    return out


SOURCES = "_name string, _part long, _shards long, source_size long, target double, _seats long"


def source_quotas(sizes: dict[str | None, int], cycle, share: float, most: float) -> list[tuple]:
    """Rows of ``SOURCES``: each source with its number, shards, words, target and quota.

    A source has a shard for every ``BLOCKS_PER_SHARD`` blocks, at least one."""
    names = sorted(s for s in sizes if s is not None) + [None] * (None in sizes)
    words = [sizes[n] for n in names]
    wanted = targets(words, [cycle[i % len(cycle)] for i in range(len(names))], share, most)
    seats = in_blocks(wanted, round(sum(wanted)), [int(most * n) for n in words], True)
    return [(name, i, max(1, n // (BLOCK_WORDS * BLOCKS_PER_SHARD)), n, target, quota)
            for i, (name, n, target, quota) in
            enumerate(zip(names, words, wanted, seats, strict=True))]


def shard_quotas(held: pd.DataFrame) -> pd.DataFrame:
    """The quota of each shard of one source, from their words and the source's quota."""
    held = held.sort_values("_shard")
    seats, words = int(held["_seats"].iloc[0]), held["_words"].to_numpy()
    votes = words * (seats / max(1, int(words.sum())))
    held["_quota"] = in_blocks(votes.tolist(), seats, (2 * words).tolist(), False)
    return held[["_part", "_shard", "_words", "_quota"]]


def _taken_until(place: Column, quota: Column, seed: int) -> Column:
    """Words taken before a place in one pass over a cell, of ``quota`` in all.

    Enough whole blocks are spread evenly, and the last of them is cut to the quota; a quota that
    whole blocks cannot hold is taken from the begin."""
    blocks = F.floor(F.col("_words") / F.lit(BLOCK_WORDS)).cast("long")
    wanted = F.ceil(quota / F.lit(BLOCK_WORDS)).cast("long")
    some = F.greatest(blocks, F.lit(1))
    start = F.pmod(F.xxhash64("_name", "_shard", F.lit(seed)), some)

    def before(until: Column) -> Column:
        """How many of the first blocks are taken."""
        return F.floor((until * wanted + start) / some).cast("long")

    block = F.least(F.floor(place / F.lit(BLOCK_WORDS)).cast("long"), blocks)
    inside = F.when(block < blocks, (place - block * BLOCK_WORDS)
                    * (before(block + 1) - before(block))).otherwise(0)
    spread = before(block) * BLOCK_WORDS + inside
    return F.least(F.when(wanted <= blocks, spread).otherwise(place), quota)


def mix(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", keep: tuple[str, ...] = ("doc_id",),
        cycle: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0,
        seed: int = 17) -> DataFrame:
    """Per document the columns ``keep`` as struct ``doc``, its ``size`` in words, its source's
    ``source_size`` and ``target``, the words ``taken``, and its place in the seeded order:
    ``source_number``, ``shard`` and the words ``before`` it there.

    Sources are weighed by ``cycle`` in code point order, null last. A null text has no words.
    Repeated ids are separate documents, spread over shards by their texts. Equal input gives
    equal results. One row per source passes through the driver, and no more than
    ``BROADCAST_SOURCES`` are broadcast. A task holds one row per shard of a source, that is one
    for ``BLOCKS_PER_SHARD`` blocks. ``most`` is at most 2, as a shard is passed over twice."""
    if not 0 < most <= 2:
        raise ValueError("a word can be taken twice at most")
    text = F.col(f"`{text_col}`")
    source = F.col(f"`{source_col}`").cast("string")
    sizes = docs.groupBy(source.alias("name")).agg(F.sum(word_count(text)).alias("words"))
    rows = source_quotas({r.name: r.words for r in sizes.collect()}, cycle, share, most)
    sources = docs.sparkSession.createDataFrame(rows, SOURCES)
    if len(rows) <= BROADCAST_SOURCES:
        sources = F.broadcast(sources)

    def sharded(*columns: Column) -> DataFrame:
        """The documents with their source's row, their size, order and shard."""
        line = docs.select(
            *columns, source.alias("_source"), word_count(text).alias("size"),
            F.xxhash64(text).alias("_tie"),
            F.xxhash64(F.col(f"`{id_col}`"), text, F.lit(seed)).alias("_order"))
        line = line.join(sources, F.col("_source").eqNullSafe(F.col("_name")))
        return line.withColumn("_shard", F.pmod("_order", "_shards").cast("long"))

    quotas = sharded().groupBy("_part", "_shard", "_seats").agg(
        F.sum("size").alias("_words")).groupBy("_part").applyInPandas(
        shard_quotas, "_part long, _shard long, _words long, _quota long")
    shard = Window.partitionBy("_part", "_shard").orderBy("_order", "_tie", "size")
    line = sharded(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("doc")).withColumn(
        "_end", F.sum("size").over(shard.rowsBetween(Window.unboundedPreceding, 0)))
    joined = line.join(quotas, ["_part", "_shard"])
    begin, end, words = F.col("_end") - F.col("size"), F.col("_end"), F.col("_words")
    first = F.least(F.col("_quota"), words)
    second = F.col("_quota") - first
    taken = (_taken_until(end, first, seed) - _taken_until(begin, first, seed)
             + _taken_until(end, second, seed) - _taken_until(begin, second, seed))
    return joined.select(
        "doc", "size", "source_size", "target", taken.alias("taken"),
        F.col("_part").alias("source_number"), F.col("_shard").alias("shard"),
        begin.alias("before"))


def copies(docs: DataFrame, *, seed: int = 17, **options) -> DataFrame:
    """The mix as whole documents: each is repeated ``taken / size`` times, the fraction by a
    seeded draw, so that the expected words of a source are those taken. Same columns as given.

    A draw belongs to a row's place in the mix, so rows of one id are drawn one by one. The rows
    come in a seeded order over all tasks, copies of a document apart from each other. Documents
    without words are not taken."""
    mixed = mix(docs, keep=tuple(docs.columns), seed=seed, **options)
    place = ("source_number", "shard", "before")
    draw = F.pmod(F.xxhash64(*place, F.lit("copies"), F.lit(seed)), F.col("size"))
    times = F.when(F.col("size") > 0, F.floor((F.col("taken") + draw) / F.col("size")))
    repeated = mixed.where(times > 0).select(
        "doc", *place, F.explode(F.sequence(F.lit(1), times.cast("int"))).alias("_copy"))
    order = F.xxhash64(*place, "_copy", F.lit(seed))
    return repeated.select("doc", order.alias("_order")).repartition(
        F.col("_order")).sortWithinPartitions("_order").select("doc.*")
