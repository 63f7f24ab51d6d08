"""Document fingerprints as invertible Bloom lookup sketches of paragraph digests.

A text is cut into paragraphs: at line ends, after sentences, and in long runs at words that
the content itself chooses, so that an edit moves no border elsewhere. Every paragraph's digest
is added to one cell in each of three tables; a cell holds the number, the sum (exclusive or)
and a check sum of its digests. Sketches of two versions subtract cell by cell; a cell with one
digest left gives it away, which empties further cells, and so on. If cells stay filled, the
tables are doubled and the comparison is made again, until the differing digests are whole.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakejobs.llm import arrow_text

LEAST_SIZE = 4
BORDER_EVERY = 16
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
STOP = np.zeros(256, bool)
STOP[list(b".!?")] = True
SALTS = [np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB),
         np.uint64(0x8EBC6AF09C88C6E3), np.uint64(0x589965CC75374CC3)]


def paragraph_digests(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Digests of all paragraphs of all texts, and where each text's digests begin.

    The k-th copy of a paragraph within a text has a digest of its own; an empty text has none.
    """
    raw, at = arrow_text.utf8(texts)
    begin, end, owner = arrow_text.runs(~SPACE[raw], at)
    starts = at[:-1][np.diff(at) > 0]
    if len(begin) > 1:
        lines = np.concatenate([[0], np.cumsum(raw == 10)])
        border = (lines[begin[1:]] > lines[end[:-1]]) | STOP[raw[end[:-1] - 1]]
        chosen = arrow_text.span_hashes(raw, begin[:-1], end[:-1]) % np.uint64(BORDER_EVERY) == 0
        cut = np.concatenate([[True], border | chosen | (owner[1:] != owner[:-1])])
        nth = np.arange(len(cut)) - np.maximum.accumulate(np.where(cut, np.arange(len(cut)), 0))
        cut |= nth % BORDER_EVERY == 0
        cut[1:] &= owner[1:] == owner[:-1]  # a text's first word is covered by its start
        starts = np.union1d(starts, begin[1:][cut[1:]])
    text = np.searchsorted(at, starts, "right") - 1
    digest = arrow_text.span_hashes(raw, starts, np.append(starts[1:], len(raw)))
    order = np.lexsort((digest, text))
    text, digest = text[order], digest[order]
    if len(digest):
        new = np.concatenate([[True], (text[1:] != text[:-1]) | (digest[1:] != digest[:-1])])
        first = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
        copy = (np.arange(len(new)) - first).astype(np.uint64)
        digest = np.where(copy > 0, arrow_text.mixed(digest + copy * SALTS[3]), digest)
    return digest, np.searchsorted(text, np.arange(len(texts) + 1))


def sketch_size(digests: np.ndarray) -> np.ndarray:
    """Cells per table that a text with so many digests starts with: a power of two."""
    want = np.maximum(LEAST_SIZE, digests / 8)
    return 1 << np.ceil(np.log2(want)).astype(np.int64)


class Sketches:
    """Three tables of cells for each of many texts, all in flat arrays."""

    def __init__(self, size: np.ndarray):
        self.size = size
        self.cut = np.concatenate([[0], np.cumsum(3 * size)])
        cells = int(self.cut[-1])
        self.count = np.zeros(cells, np.int64)
        self.key = np.zeros(cells, np.uint64)
        self.check = np.zeros(cells, np.uint64)

    def add(self, row: np.ndarray, digest: np.ndarray, times) -> None:
        check = arrow_text.mixed(digest ^ SALTS[3])
        size = self.size[row]
        for table in range(3):
            spot = arrow_text.mixed(digest ^ SALTS[table]) & (size - 1).astype(np.uint64)
            cell = self.cut[row] + table * size + spot.astype(np.int64)
            np.add.at(self.count, cell, times)
            np.bitwise_xor.at(self.key, cell, digest)
            np.bitwise_xor.at(self.check, cell, check)

    def minus(self, other: Sketches) -> Sketches:
        out = Sketches(self.size)
        out.count = self.count - other.count
        out.key = self.key ^ other.key
        out.check = self.check ^ other.check
        return out

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(row, digest, side) of the digests that are left, and which rows came out whole.

        Side is 1 for digests of the first version and -1 for those of the second."""
        owner = np.repeat(np.arange(len(self.size)), 3 * self.size)
        rows, digests, sides = [], [], []
        live = np.flatnonzero(self.count)
        while len(live):
            live = live[np.abs(self.count[live]) == 1]
            pure = live[arrow_text.mixed(self.key[live] ^ SALTS[3]) == self.check[live]]
            if not len(pure):
                break
            found = np.unique(np.rec.fromarrays(
                [owner[pure], self.key[pure], self.count[pure]], names="row,digest,side"))
            self.add(found.row, found.digest, -found.side)
            rows.append(found.row)
            digests.append(found.digest)
            sides.append(found.side)
            live = np.flatnonzero(self.count)
        left = np.zeros(len(self.size), bool)
        left[owner[(self.count != 0) | (self.key != 0) | (self.check != 0)]] = True
        none = np.zeros(0, np.int64)
        return (np.concatenate(rows or [none]), np.concatenate(digests or [none.astype(np.uint64)]),
                np.concatenate(sides or [none]), ~left)


def build(digest: np.ndarray, cut: np.ndarray, size: np.ndarray) -> Sketches:
    out = Sketches(size)
    out.add(np.repeat(np.arange(len(size)), np.diff(cut)), digest, 1)
    return out


def take(digest: np.ndarray, cut: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The digests of some rows, with their own cuts."""
    n = cut[rows + 1] - cut[rows]
    new = np.concatenate([[0], np.cumsum(n)])
    return digest[np.arange(new[-1]) + np.repeat(cut[rows] - new[:-1], n)], new


def compare(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]):
    """Likeness of each pair of texts, and (row, digest, side) of all differing digests."""
    n_a, n_b = np.diff(a[1]), np.diff(b[1])
    differing = np.zeros(len(n_a), np.int64)
    rows = np.arange(len(n_a))
    size = np.maximum(sketch_size(n_a), sketch_size(n_b))
    parts = []
    while len(rows):
        own, other = take(*a, rows), take(*b, rows)
        row, digest, side, whole = build(*own, size).minus(build(*other, size)).peel()
        good = whole[row]
        parts.append((rows[row[good]], digest[good], side[good]))
        np.add.at(differing, rows[row[good]], 1)
        rows, size = rows[~whole], size[~whole] * 2
    union = (n_a + n_b + differing) / 2
    like = np.where(union > 0, 1 - differing / np.maximum(union, 1), 1.0)
    return like, tuple(np.concatenate(x) for x in zip(*parts, strict=True)) if parts else None


def printed(digest: np.ndarray, cut: np.ndarray) -> list[str]:
    """Sketches as text: cells per table, then counts, keys and checks in base 64."""
    size = sketch_size(np.diff(cut))
    s = build(digest, cut, size)
    out = []
    for n, a, b in zip(size.tolist(), s.cut[:-1].tolist(), s.cut[1:].tolist(), strict=True):
        cells = (s.count[a:b].astype("<u2").tobytes() + s.key[a:b].astype("<u8").tobytes()
                 + s.check[a:b].astype("<u4").tobytes())
        out.append(f"{n}:{base64.b64encode(cells).decode()}")
    return out


def packed(digest: np.ndarray, cut: np.ndarray) -> pa.Array:
    """Digests of each text as little-endian bytes."""
    data = pa.py_buffer(digest.astype("<u8").tobytes())
    offsets = pa.py_buffer((cut * 8).astype(np.int32).tobytes())
    return pa.Array.from_buffers(pa.binary(), len(cut) - 1, [None, offsets, data])


def unpacked(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    raw, at = arrow_text.utf8(values.fill_null(b"").cast(pa.large_binary()).view(pa.large_string()))
    return np.frombuffer(raw.tobytes(), "<u8"), at // 8


def text_digests(text: Column) -> Column:
    """Paragraph digests of a whole text (null: none) as bytes."""

    @F.arrow_udf("binary")
    def digest_texts(texts: pa.Array) -> pa.Array:
        parts = [packed(*paragraph_digests(part)) for _, part in arrow_text.slices(texts)]
        return pa.concat_arrays(parts) if parts else pa.array([], pa.binary())

    return digest_texts(text)


def described(text: Column, next_text: Column, edited: Column) -> Column:
    """Struct of the sketches of a text and of its edited text, and the likeness of the text to
    the edited one and to the next one: the share of paragraphs two texts have in common, 1 for
    two empty texts. Equal texts have equal sketches."""

    @F.arrow_udf("fingerprint string, edited_fingerprint string, "
                 "near_edited double, near_next double")
    def describe(texts: pa.Array, following: pa.Array, edits: pa.Array) -> pa.Array:
        columns: list[list] = [[], [], [], []]
        for begin, part in arrow_text.slices(texts):
            own = paragraph_digests(part)
            edit = paragraph_digests(edits.slice(begin, len(part)))
            columns[0] += printed(*own)
            columns[1] += printed(*edit)
            columns[2] += compare(own, edit)[0].tolist()
            columns[3] += compare(
                own, paragraph_digests(following.slice(begin, len(part))))[0].tolist()
        kinds = [pa.string(), pa.string(), pa.float64(), pa.float64()]
        return pa.StructArray.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
            ["fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    return describe(text, next_text, edited)


def differences(left: Column, right: Column) -> Column:
    """Struct of the likeness and the digests that only the left or only the right text has."""

    @F.arrow_udf("likeness double, removed array<string>, added array<string>")
    def recover(a: pa.Array, b: pa.Array) -> pa.Array:
        like, found = compare(unpacked(a), unpacked(b))
        rows = [{"likeness": x, "removed": [], "added": []} for x in like.tolist()]
        if found is not None:
            for row, digest, side in zip(*(x.tolist() for x in found), strict=True):
                rows[row]["removed" if side > 0 else "added"].append(f"{digest:016x}")
        return pa.array(rows, pa.struct([
            ("likeness", pa.float64()), ("removed", pa.list_(pa.string())),
            ("added", pa.list_(pa.string()))]))

    return recover(left, right)


def in_buckets(docs: DataFrame, key: str, buckets: int) -> DataFrame:
    """Rows with ``_bucket``, cut at the quantiles of the key, ``_key`` and ``_guest``.

    The first row of a bucket in descending order is also a guest in the bucket before it (of
    the first bucket: in the last), so that every bucket holds all neighbours of its rows. One key
    per bucket passes through the driver, never a text. A null key counts as the smallest."""
    keyed = docs.withColumn("_key", F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63))))
    shares = [i / buckets for i in range(1, buckets)]
    bounds = sorted(set(keyed.select(F.percentile_approx("_key", shares, 10 * buckets))
                        .first()[0] or []))
    cuts = np.array(bounds, np.int64)

    @F.arrow_udf("int")
    def bucket_of(keys: pa.Array) -> pa.Array:
        found = np.searchsorted(cuts, keys.to_numpy(zero_copy_only=False), "left")
        return pa.array(found, pa.int32())

    tops = keyed.select("_key").groupBy(bucket_of("_key").alias("bucket")).agg(
        F.max("_key").alias("top")).collect()
    order = sorted((r.bucket, r.top) for r in tops)
    host = {top: order[(i + 1) % len(order)][0] for i, (_, top) in enumerate(order)}

    @F.arrow_udf("array<struct<bucket:int,guest:boolean>>")
    def places(keys: pa.Array) -> pa.Array:
        own = np.searchsorted(cuts, keys.to_numpy(zero_copy_only=False), "left")
        return pa.array(
            [[{"bucket": b, "guest": False}]
             + ([{"bucket": host[k], "guest": True}] if k in host else [])
             for k, b in zip(keys.to_pylist(), own.tolist(), strict=True)],
            pa.list_(pa.struct([("bucket", pa.int32()), ("guest", pa.bool_())])))

    return keyed.withColumn("_place", F.explode(places("_key"))).select(
        *docs.columns, "_key", F.col("_place.bucket").alias("_bucket"),
        F.col("_place.guest").alias("_guest"))


def with_next(placed: DataFrame, value: str) -> DataFrame:
    """Add ``next_<value>``: the value of the row with the next smaller key (after the last:
    the first), rows of one key in the order of the value's hash."""
    line = Window.partitionBy("_bucket").orderBy("_guest", F.desc("_key"), F.xxhash64(value))
    return placed.select("*", F.lead(value).over(line).alias(f"next_{value}")).where(
        ~F.col("_guest")).drop("_key", "_bucket", "_guest")


def versions(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
             buckets: int | None = None) -> DataFrame:
    """Fingerprints of every text and of its edited text (second half replaced from the next
    document), with the likeness of the text to both the edited text and the next one.

    A null text counts as empty; repeated ids follow one another; an empty table gives no row."""
    spark = docs.sparkSession
    buckets = buckets or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.length("text") - half),
                      F.substring("next_text", F.lit(1), half))
    # The one shuffle carries every text once; digests are made behind it.
    lined = with_next(in_buckets(texts, "doc_id", buckets), "text").withColumn("edited", edited)
    return lined.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        described(F.col("text"), F.col("next_text"), F.col("edited")).alias("seen"),
    ).select("doc_id", "n_chars", "edited_sha256", "seen.*")
