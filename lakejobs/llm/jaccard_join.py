"""Exact Jaccard self-join of word-shingle sets with skipping by set relations.

Equal sets are one class. A class posts the rarest shingles of its set (a prefix long enough
that two similar sets share one), each with set size and position. Lists are read in the order
of size and position: stretches of a list are skipped where sizes or positions rule out the
needed overlap, entries where the parity bitmaps of two sets differ in more bits than similar
sets can, or where both are connected already. What stays connected is a candidate cluster.
Inside a cluster every set is kept as its difference from a leading set; the overlap of two sets
follows from the leader's and theirs with what their differences share, so similar sets are
compared by a few shingles. No step drops a pair that could be similar.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakejobs.llm import arrow_text
from lakejobs.llm.components import components, stored

BUCKET_BITS = 22
ID_BITS = 1 << 23
CLUSTER_BLOCK = 4096
BUNDLE = 2000
SHORT_LIST = 8
LEAST_BITS = 512
SLICE = 256
PAIRS = 1 << 20

# Fixed value: the white space between words.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                              0xD6E8FEB86659FD93)]


def shingle_sets(texts: pa.Array, words: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text.

    A text with fewer words has its whole sequence as one shingle, a text without words none."""
    for _, part in arrow_text.slices(texts):
        raw, at = arrow_text.utf8(part)
        raw = LOWER[raw]
        begin, end, owner = arrow_text.runs(~SPACE[raw], at)
        own = arrow_text.span_hashes(raw, begin, end)
        count = np.bincount(owner, minlength=len(part))
        first = np.concatenate([[0], np.cumsum(count)])
        size = max(0, len(own) - words + 1)
        value = np.zeros(size, np.uint64)
        for i in range(words):
            value = arrow_text.mixed(value * MIX[0] + own[i:i + size] + MIX[1])
        stop = np.maximum(first[1:] - words + 1, first[:-1])
        for i, n in enumerate(count.tolist()):
            if n >= words:
                yield np.unique(value[first[i]:stop[i]])
            elif n:
                short = np.full(1, n, np.uint64) * MIX[2]
                for k in range(first[i], first[i + 1]):
                    short = arrow_text.mixed(short * MIX[3] + own[k:k + 1])
                yield short
            else:
                yield np.zeros(0, np.uint64)


def set_class(shingles: np.ndarray) -> int:
    """A 64-bit id of a set."""
    data = np.ascontiguousarray(shingles).tobytes()
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)


def bitmap(shingles: np.ndarray) -> bytes:
    """The parity of the number of shingles on each bit; at least half a bit per shingle, a power
    of two. Each shingle that only one of two sets has changes one bit."""
    bits = LEAST_BITS
    while 2 * bits < len(shingles):
        bits *= 2
    spot = (shingles & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(spot, minlength=bits) & 1).astype(np.uint8)).tobytes()


SETS = "mark long, n long, cls long, bits binary, bucket long, times long"
ID_TYPES = {"long": pa.int64(), "string": pa.string()}


def describe_sets(words: int, id_type: str = "long"):
    """Per document size and class of its set; behind a task's documents, the shingle buckets
    that are far more frequent in the task than the mean."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", *(c.split()[0] for c in SETS.split(", "))]
        counts = np.zeros(1 << BUCKET_BITS, np.int32)
        for batch in batches:
            sizes, classes, bits = [], [], []
            for shingles in shingle_sets(batch.column(1), words):
                sizes.append(len(shingles))
                classes.append(set_class(shingles) if len(shingles) else None)
                bits.append(bitmap(shingles) if len(shingles) else None)
                np.add.at(counts, (shingles >> np.uint64(64 - BUCKET_BITS)).astype(np.int64), 1)
            none = pa.nulls(len(sizes), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(sizes, pa.int64()),
                 pa.array(classes, pa.int64()), pa.array(bits, pa.binary()), none, none], names)
        often = np.flatnonzero(counts > 2 * counts.mean() + 6)
        none = pa.nulls(len(often), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(len(often), ID_TYPES[id_type]), none, none, none,
             pa.nulls(len(often), pa.binary()), pa.array(often, pa.int64()),
             pa.array(counts[often].astype(np.int64))], names)

    return run


def bucket_grades(often: DataFrame) -> np.ndarray:
    """The magnitude of every frequent bucket's count, 0 for all others: a byte per bucket, put
    together from blocks that the executors fill."""
    low = 1 << (BUCKET_BITS - 6)

    def block(table: pa.Table) -> pa.Table:
        out = np.zeros(low, np.uint8)
        bucket = table.column("bucket").to_numpy()
        times = np.log2(table.column("times").to_numpy().astype(float)) * 4
        out[bucket % low] = np.minimum(times + 1, 255).astype(np.uint8)
        return pa.table({"nth": pa.array([int(bucket[0] // low)], pa.int64()),
                         "grades": pa.array([out.tobytes()], pa.binary())})

    blocks = often.groupBy("bucket").agg(F.sum("times").alias("times")).groupBy(
        F.floor(F.col("bucket") / low)).applyInArrow(block, "nth long, grades binary").collect()
    grade = np.zeros(1 << BUCKET_BITS, np.uint8)
    for nth, grades in blocks:
        grade[nth * low:(nth + 1) * low] = np.frombuffer(grades, np.uint8)
    return grade


POSTINGS = "shingle long, n int, place int, cls long"


def post_prefixes(words: int, percent: int, grade: np.ndarray):
    """The prefix of every set in the order of (grade of the shingle's bucket, hash).

    A task posts a class once, so that a list holds a copy per task at most."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        posted: set[int] = set()
        for batch in batches:
            values, sizes, places, classes = [], [], [], []
            for shingles in shingle_sets(batch.column(0), words):
                n = len(shingles)
                cls = set_class(shingles) if n else None
                if cls is None or cls in posted:
                    continue
                posted.add(cls)
                bucket = (shingles >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
                order = np.argsort(grade[bucket], kind="stable")
                prefix = shingles[order[:n - -(-percent * n // 100) + 1]]
                values.append(prefix)
                sizes.append(np.full(len(prefix), n, np.int32))
                places.append(np.arange(len(prefix), dtype=np.int32))
                classes.append(np.full(len(prefix), cls, np.int64))
            if values:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(values).view(np.int64)),
                     pa.array(np.concatenate(sizes)), pa.array(np.concatenate(places)),
                     pa.array(np.concatenate(classes))], ["shingle", "n", "place", "cls"])

    return run


def needed(n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """The least overlap with which sets of two sizes are similar."""
    return -(-percent * (n + m) // (100 + percent))


def shared_lists(percent: int):
    """The postings that can be of use: those of lists, in the order of shingle, size, position
    and class, that hold another class of fitting size and position."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        for rows in whole_lists(batches):
            shingle, n, place, cls = (rows.column(i).to_numpy().astype(np.int64) for i in range(4))
            # Equal sets post the same rows, which stand one behind another.
            new = np.ones(len(shingle), bool)
            new[1:] = (shingle[1:] != shingle[:-1]) | (cls[1:] != cls[:-1])
            at = np.flatnonzero(new)
            shingle, n, place = shingle[at], n[at], place[at]
            edge = np.flatnonzero(np.concatenate([[True], shingle[1:] != shingle[:-1], [True]]))
            keep = np.zeros(len(at), bool)
            # Lists end at their edges, so a step beyond the longest list finds nothing.
            for step in range(1, min(int(np.diff(edge).max()), SHORT_LIST)):
                i = np.flatnonzero(shingle[step:] == shingle[:-step])
                i = i[fitting(i, i + step, n, place, percent)]
                keep[i] = keep[i + step] = True
            for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
                if b - a > SHORT_LIST:
                    keep[a:b] = partnered(n[a:b], place[a:b], percent)
            yield from rows.take(pa.array(at[keep])).combine_chunks().to_batches()

    return run


def partnered(n: np.ndarray, place: np.ndarray, percent: int) -> np.ndarray:
    """Which entries of one list, in the order of size and position, have another that fits.

    Of each size, the entries that fit one are the first ones, up to a position."""
    out = np.zeros(len(n), bool)
    sizes, first = np.unique(n, return_index=True)
    for m, a, b in zip(sizes.tolist(), first.tolist(), [*first[1:].tolist(), len(n)], strict=True):
        i = np.arange(np.searchsorted(n, -(-percent * m // 100)),
                      np.searchsorted(n, 100 * m // percent, "right"))
        least = needed(n[i], m, percent)
        others = np.searchsorted(place[a:b], m - least, "right") - (
            (n[i] == m) & (place[i] <= m - least))
        out[i] |= (others > 0) & (n[i] - place[i] >= least) & (np.minimum(n[i], m) >= least)
    return out


def whole_lists(batches) -> Iterator[pa.Table]:
    """Rows in the order of shingle, cut between lists: a list is held until it ends."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        shingle = batch.column(0).to_numpy()
        begin = int(np.searchsorted(shingle, shingle[-1], "left"))
        if begin:
            yield pa.Table.from_batches([*held, batch.slice(0, begin)])
            held = [batch.slice(begin)]
        elif held and held[-1].column(0)[0].as_py() != int(shingle[-1]):
            yield pa.Table.from_batches(held)
            held = [batch]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def fitting(i: np.ndarray, j: np.ndarray, n, place, percent: int) -> np.ndarray:
    """Which pairs of entries of one list can be similar, by size and position."""
    least = needed(n[i], n[j], percent)
    return ((np.minimum(n[i], n[j]) >= least)
            & (np.minimum(n[i] - place[i], n[j] - place[j]) >= least))


class Bitmaps:
    """Bitmaps of many sets; those of one length stand in one table."""

    def __init__(self, column: pa.Array):
        self.raw, self.at = arrow_text.utf8(
            column.cast(pa.large_binary()).view(pa.large_string()))
        self.size = np.diff(self.at)

    def rows(self, which: np.ndarray, size: int) -> np.ndarray:
        """The bitmaps of some sets of one length, folded to ``size`` bytes."""
        own = int(self.size[which[0]])
        table = self.raw[(self.at[which][:, None] + np.arange(own))]
        while own > size:
            own //= 2
            table = table[:, :own] ^ table[:, own:]
        return np.ascontiguousarray(table).view(np.uint64)

    def differ(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """In how many bits the bitmaps of each pair differ, at the smaller length."""
        out = np.zeros(len(a), np.int64)
        kinds = self.size[a] * (1 << 32) + self.size[b]
        for kind in np.unique(kinds):
            pairs = np.flatnonzero(kinds == kind)
            size = int(min(kind >> 32, kind & 0xFFFFFFFF))
            step = max(1, (4 << 20) // size)
            for part in range(0, len(pairs), step):
                some = pairs[part:part + step]
                out[some] = np.bitwise_count(
                    self.rows(a[some], size) ^ self.rows(b[some], size)).sum(1)
        return out


def possible(i: np.ndarray, j: np.ndarray, n, place, bits: Bitmaps, percent: int) -> np.ndarray:
    """Which pairs of entries of one list can be similar, by size, position and bitmap."""
    fits = np.flatnonzero(fitting(i, j, n, place, percent))
    apart = n[i[fits]] + n[j[fits]] - 2 * needed(n[i[fits]], n[j[fits]], percent)
    out = np.zeros(len(i), bool)
    out[fits[bits.differ(i[fits], j[fits]) <= apart]] = True
    return out


def connect_list(first: int, last: int, n, place, bits: Bitmaps, percent: int):
    """Pairs that connect all entries of a long list that can be similar: a forest.

    Of each size, an entry meets those before it up to the largest position that fits."""
    group = np.arange(first, last)
    sizes, start = np.unique(n[first:last], return_index=True)
    wide = int(place[first:last].max()) + 2
    order = n[first:last] * wide + place[first:last]
    for i in range(first + 1, last):
        some = slice(*np.searchsorted(sizes, [-(-percent * n[i] // 100), n[i] + 1]))
        least = needed(n[i], sizes[some], percent)
        most = np.clip(sizes[some] - least, -1, wide - 2)
        stop = np.searchsorted(order, sizes[some] * wide + most, "right")
        count = np.minimum(stop, i - first) - start[some]
        count[(count < 0) | (n[i] - place[i] < least)] = 0
        window = (first + np.repeat(start[some] - np.cumsum(count) + count, count)
                  + np.arange(count.sum()))
        window = window[group[window - first] != group[i - first]]
        while len(window):
            some, window = window[-256:], window[:-256]  # the nearest sizes first
            some = some[group[some - first] != group[i - first]]
            if not len(some):
                continue
            good = some[possible(np.full(len(some), i), some, n, place, bits, percent)]
            own = group[good - first]
            for other in np.unique(own):
                yield i, int(good[np.flatnonzero(own == other)[0]])
                group[group == other] = group[i - first]


def read_lists(percent: int):
    """Candidate edges from shared lists (shingle, n, place, cls, bits) in the order of shingle,
    size and position. One list at a time is held whole."""

    def edges(rows: pa.Table) -> pa.RecordBatch:
        shingle, n, place, cls = (rows.column(i).to_numpy().astype(np.int64) for i in range(4))
        bits = Bitmaps(rows.column(4).combine_chunks())
        edge = np.flatnonzero(np.concatenate(
            [[True], shingle[1:] != shingle[:-1], [True]])) if len(shingle) else np.zeros(1, int)
        size = np.repeat(np.diff(edge), np.diff(edge))
        left, right = [], []
        for step in range(1, SHORT_LIST):
            i = np.flatnonzero((shingle[step:] == shingle[:-step]) & (size[step:] <= SHORT_LIST))
            good = possible(i, i + step, n, place, bits, percent) if len(i) else i
            left.append(i[good] if len(i) else i)
            right.append((i + step)[good] if len(i) else i)
        for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
            if b - a > SHORT_LIST:
                pairs = list(connect_list(a, b, n, place, bits, percent))
                left.append(np.array([p[0] for p in pairs], np.int64))
                right.append(np.array([p[1] for p in pairs], np.int64))
        u, v = (cls[np.concatenate(x)] if x else np.zeros(0, np.int64) for x in (left, right))
        pairs = np.unique(np.stack([np.maximum(u, v), np.minimum(u, v)], 1), axis=0)
        return pa.RecordBatch.from_arrays(
            [pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["u", "v"])

    def run(batches) -> Iterator[pa.RecordBatch]:
        yield from map(edges, whole_lists(batches))

    return run


def leading(sets: list[np.ndarray]) -> np.ndarray:
    """Of a few sets, that with the least differences to some sets."""
    step = -(-len(sets) // 32)
    some = sets[::4 * step]
    return some[0] if len(some) == 1 else min(some, key=lambda s: sum(
        len(np.setxor1d(s, other, assume_unique=True)) for other in sets[::step]))


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """The overlap of every two sets."""
    return np.concatenate([part for _, part in overlap_slices(sets)])


def overlap_slices(sets: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray]]:
    """The overlaps of ``SLICE`` sets after another with all, each with the first one's number,
    from the differences of the sets to a leading one.

    overlap(x, y) = |L| - |L \\ x| - |L \\ y| + what the two differences have in common."""
    leader = leading(sets)
    differences = [np.setxor1d(leader, s, assume_unique=True) for s in sets]
    size = np.array([len(s) for s in sets])
    missing = (np.array([len(d) for d in differences]) + len(leader) - size) // 2
    owner = np.repeat(np.arange(len(sets)), [len(d) for d in differences])
    value = np.concatenate(differences)
    order = np.argsort(value, kind="stable")
    owner, value = owner[order], value[order]
    edge = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1], [True]])) \
        if len(value) else np.zeros(1, int)
    times = np.diff(edge)
    many = max(16, len(sets) // 16)
    few = [owner[edge[:-1][times == d][:, None] + np.arange(d)]
           for d in np.unique(times[times <= many]).tolist()]
    dense = np.flatnonzero(times > many)
    for begin in range(0, len(sets), SLICE):
        end = min(begin + SLICE, len(sets))
        out = (len(leader) - missing[begin:end, None] - missing[None, :]).astype(np.int32)
        for rows in few:
            which, nth = np.nonzero((rows >= begin) & (rows < end))
            step = max(1, PAIRS // rows.shape[1])
            for part in range(0, len(which), step):
                some = which[part:part + step]
                own = rows[some, nth[part:part + step]] - begin
                np.add.at(out, (np.repeat(own, rows.shape[1]), rows[some].ravel()), 1)
        for part in range(0, len(dense), 2048):
            columns = dense[part:part + 2048]
            table = np.zeros((len(sets), len(columns)), np.float32)
            for i, k in enumerate(columns):
                table[owner[edge[k]:edge[k + 1]], i] = 1
            out += np.rint(table[begin:end] @ table.T).astype(np.int32)
        yield begin, out


def links(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """For each set, the first set of those it reaches by links among these."""
    size = np.array([len(s) for s in sets])
    linked = np.zeros((len(sets), len(sets)), bool)
    for begin, shared in overlap_slices(sets):
        end = begin + len(shared)
        both = size[begin:end, None] + size[None, :]
        linked[begin:end] = (100 + percent) * shared.astype(np.int64) >= percent * both
    root = np.full(len(sets), -1)
    for i in range(len(sets)):
        if root[i] >= 0:
            continue
        front = np.zeros(len(sets), bool)
        front[i] = True
        while front.any():
            root[front] = i
            front = linked[front].any(0) & (root < 0)
    return root


def compare_clusters(words: int, percent: int):
    """Edges between linked classes of a bundle of clusters: each class with its root."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("cluster", "ascending"), ("cls", "ascending")])
        found = shingle_sets(table.column("text").combine_chunks(), words)
        rows = zip(table.column("cluster").to_pylist(), table.column("cls").to_pylist(), found,
                   strict=True)
        u, v = [], []
        for _, members in groupby(rows, lambda r: r[0]):
            # Rows that repeat an id: those with another set than the class are left out.
            sets = {cls: s for _, cls, s in members if set_class(s) == cls}
            part = list(sets)
            root = links(list(sets.values()), percent) if len(part) > 1 else [0] * len(part)
            for i, r in enumerate(root):
                if i != r:
                    u.append(part[i])
                    v.append(part[r])
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    return run


def only_ids(rows: DataFrame, id_col: str, ids: DataFrame) -> DataFrame:
    """The rows whose id is among ``ids``, and some others: a filter of ``ID_BITS`` bits, whose
    size does not depend on the data, so that a join after it has less to shuffle."""

    def mark(batches) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(ID_BITS, bool)
        for batch in batches:
            seen[batch.column(0).to_numpy()] = True
        yield pa.RecordBatch.from_arrays(
            [pa.array([np.packbits(seen).tobytes()], pa.binary())], ["bits"])

    def place(column: str):
        return F.pmod(F.xxhash64(column), F.lit(ID_BITS))

    parts = ids.select(place(ids.columns[0]).alias("bit")).coalesce(8).mapInArrow(
        mark, "bits binary").collect()  # 8 MB at most
    seen = np.zeros(ID_BITS // 8, np.uint8)
    for part in parts:
        seen |= np.frombuffer(part.bits, np.uint8)
    known = np.unpackbits(seen).astype(bool)

    @F.arrow_udf("boolean")
    def maybe(bit: pa.Array) -> pa.Array:
        return pa.array(known[bit.to_numpy(zero_copy_only=False)])

    return rows.where(maybe(place(id_col)))


def texts_of(placed: DataFrame, texts: DataFrame) -> DataFrame:
    """The text of each placed class: that of its row by id and hash of the text, so that the
    other texts of a repeated or null id are not met."""
    placed = placed.select(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"),
                           "cls", "cluster", "bundle")
    return texts.join(placed, F.col("doc_id").eqNullSafe(F.col("_id"))
                      & (F.col("mark") == F.col("_mark"))).drop("mark", "_mark")


def linked_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                     id_type: str = "long", words: int = 3, percent: int = 90) -> DataFrame:
    """Per row: doc_id, n_shingles, and component_id, the smallest id reachable by links.

    Two sets are linked when 100 x overlap >= percent x union. Null and empty texts and texts of
    white space have no set and are their own component. Rows that repeat an id count as
    documents of their own. Ids are long or, by ``id_type``, string. An empty table gives no
    row."""
    texts = docs.select(F.col(f"`{id_col}`").cast(id_type).alias("doc_id"),
                        F.col(f"`{text_col}`").alias("text"),
                        F.xxhash64(F.col(f"`{text_col}`")).alias("mark"))
    described = stored(texts.mapInArrow(
        describe_sets(words, id_type), f"doc_id {id_type}, {SETS}"), "sets")
    sets = described.where("bucket IS NULL").select("doc_id", "mark", "n", "cls")
    bits = described.where("cls IS NOT NULL").groupBy("cls").agg(F.first("bits").alias("bits"))
    grade = bucket_grades(described.where("bucket IS NOT NULL"))

    postings = texts.select("text").mapInArrow(post_prefixes(words, percent, grade), POSTINGS)
    order = ("shingle", "n", "place", "cls")
    lists = stored(postings.repartition("shingle").sortWithinPartitions(*order).mapInArrow(
        shared_lists(percent), POSTINGS), "lists")
    lists = lists.join(bits, "cls").select(*order, "bits")
    edges = lists.repartition("shingle").sortWithinPartitions(*order).mapInArrow(
        read_lists(percent), "u long, v long").distinct()
    clusters = components(edges).select(F.col("node").alias("cls"), F.col("root").alias("cluster"))

    first = sets.where("cls IS NOT NULL").groupBy("cls").agg(
        F.min(F.struct("doc_id", "mark")).alias("one")).select("cls", "one.*")
    members = stored(clusters.join(first, "cls"), "members")
    size = members.groupBy("cluster").agg(F.count("*").alias("size"))
    bundles = -(-members.count() // BUNDLE) or 1
    blocks = F.ceil(F.col("size") / CLUSTER_BLOCK).cast("int")
    block = F.pmod(F.xxhash64("cls"), blocks).cast("int")
    small = F.concat(F.lit("b"), F.pmod(F.xxhash64("cluster"), F.lit(bundles)).cast("string"))
    # A cluster beyond one block is compared block by block, each pair of blocks in a task.
    pair = F.transform(F.sequence(F.lit(0), blocks - 1), lambda other: F.concat_ws(
        "-", "cluster", F.least(block, other), F.greatest(block, other)))
    placed = members.join(size, "cluster").withColumn(
        "bundle", F.explode(F.when(blocks == 1, F.array(small)).otherwise(pair)))
    found = texts_of(placed, only_ids(texts, "doc_id", members.select("doc_id"))).groupBy("bundle").applyInArrow(
        compare_clusters(words, percent), "u long, v long")
    roots = components(found.distinct()).select(F.col("node").alias("cls"), "root")

    rooted = sets.join(roots, "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    smallest = rooted.where("root IS NOT NULL").groupBy("root").agg(
        F.min("doc_id").alias("component_id"))
    return rooted.join(smallest, "root", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
        .alias("component_id"))
