"""Vector bin packing of token sequences by the dot-product heuristic.

Every sequence has a limit on tokens, on segments and on loss-bearing tokens. An open sequence
takes, of the examples that fit in all three, the one whose demand has the largest dot product
with what is left; where cutting is allowed, the last gap is filled with a cut example. Each
task packs the rows it reads, with a bounded window of examples in memory; nothing is shuffled,
and a task that runs again packs the same way.
"""

from __future__ import annotations

import base64
import os
import re
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW_TOKENS = 2_000_000
SEQUENCES_PER_TASK = 1 << 36
LONG_SPACE = re.compile(r"\s{2000}")
_CODECS: dict[str, Codec] = {}


class Codec:
    """Ids of a byte-level BPE vocabulary, given as the .json file; a .tiktoken file with the
    same vocabulary beside it is used where present, as it gives the same ids in a quarter of
    the time."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        self.specials = [t.content for t in self.slow.get_added_tokens_decoder().values()]
        self.fast = None
        ranks = path.removesuffix(".json") + ".tiktoken"
        if os.path.exists(ranks):
            import public_tokenizers
            import tiktoken

            with open(ranks, "rb") as lines:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding(
                "byte-bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table,
                special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        if self.fast is None or ("<|" in text and any(s in text for s in self.specials)) \
                or (len(text) > 2000 and "  " in text and LONG_SPACE.search(text)):
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.uint32)
        return self.fast.encode_to_numpy(text, disallowed_special=())


def codec(path: str) -> Codec:
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


class Pool:
    """Examples that wait for a place, in buckets of equal demand: tokens, one segment, and
    loss-bearing tokens. A choice compares buckets, so its time depends on how many different
    demands wait and not on how many examples; within a bucket the first to come is the first
    to go."""

    def __init__(self, limits: tuple[int, int, int]):
        self.limits = np.array(limits, float)
        self.examples: dict[int, tuple] = {}  # those that wait: key, tokens, loss
        self.added = 0
        self.slots: dict[tuple[int, int], int] = {}
        self.queues: list[deque[int]] = []
        self.tokens = self.loss = self.waiting = np.zeros(0, np.int64)  # of each bucket

    def add(self, key, tokens: int, loss: int) -> None:
        self._put(self.added, key, tokens, loss)
        self.added += 1

    def _put(self, at: int, key, tokens: int, loss: int) -> None:
        slot = self.slots.get((tokens, loss))
        if slot is None:
            slot = self._open(tokens, loss)
        self.examples[at] = (key, tokens, loss)
        self.queues[slot].append(at)
        self.waiting[slot] += 1

    def _open(self, tokens: int, loss: int) -> int:
        """A new bucket; where there is no room, empty ones go and the arrays double."""
        if len(self.queues) == len(self.tokens):
            kept = [i for i, queue in enumerate(self.queues) if queue]
            grown = np.zeros((3, max(64, 2 * len(kept))), np.int64)
            for row, old in zip(grown, (self.tokens, self.loss, self.waiting), strict=True):
                row[:len(kept)] = old[kept]
            self.tokens, self.loss, self.waiting = grown
            self.queues = [self.queues[i] for i in kept]
            self.slots = {(int(self.tokens[i]), int(self.loss[i])): i for i in range(len(kept))}
        slot = self.slots[tokens, loss] = len(self.queues)
        self.queues.append(deque())
        self.tokens[slot], self.loss[slot] = tokens, loss
        return slot

    def best(self, left: np.ndarray, whole: bool) -> int:
        """The waiting example with the largest dot product; -1 if none fits.

        ``whole`` examples must fit; else only a part of them has to."""
        if left[0] < 1 or left[1] < 1 or not self.examples:
            return -1
        used = len(self.queues)
        tokens, loss = self.tokens[:used], self.loss[:used]
        fits = self.waiting[:used] > 0
        if whole:
            fits &= (tokens <= left[0]) & (loss <= left[2])
        elif left[2] < 1:
            fits &= loss == 0
        weight = left / self.limits
        score = np.where(
            fits, tokens * (weight[0] / self.limits[0]) + weight[1] / self.limits[1]
            + loss * (weight[2] / self.limits[2]), -1.0)
        slot = int(score.argmax())
        return self.queues[slot][0] if fits[slot] else -1

    def take(self, at: int, tokens: int, loss: int) -> None:
        """Place so much of the first example of its bucket; what is left of it waits on."""
        key, size, bearing = self.examples.pop(at)
        slot = self.slots[size, bearing]
        self.queues[slot].popleft()
        self.waiting[slot] -= 1
        if size > tokens:
            self._put(at, key, size - tokens, bearing - loss)


def fill(pool: Pool, cut: bool) -> list[tuple]:
    """Fill one sequence: (key, tokens and loss-bearing tokens taken from the front of what is
    left of it).

    With ``cut``, every token of an example counts as loss-bearing or none does."""
    left, out = pool.limits.copy(), []
    while left[0] >= 1 and left[1] >= 1:
        at = pool.best(left, True) if not cut or left[1] > 1 else -1
        part = at < 0
        if part:
            at = pool.best(left, False) if cut else -1
        if at < 0:
            break
        key, tokens, loss = pool.examples[at]
        take = min(tokens, int(left[0]), int(left[2]) if loss else tokens) if part else tokens
        lost = (take if loss else 0) if part else loss
        left -= (take, 1, lost)
        pool.take(at, take, lost)
        out.append((key, take, lost))
    return out


def binary_parts(pieces: list[tuple], limit: int) -> Iterator[list[tuple]]:
    """Cut one sequence into sequences whose lengths are powers of two, largest first."""
    left = sum(p[2] for p in pieces)
    queue = list(reversed(pieces))
    while left:
        room = min(limit, 1 << (left.bit_length() - 1))
        left -= room
        part = []
        while room:
            key, start, length = queue.pop()
            take = min(room, length)
            part.append((key, start, take))
            if take < length:
                queue.append((key, start + take, length - take))
            room -= take
        yield part


class Packer:
    """Packs token arrays that arrive one by one; gives out finished sequences."""

    def __init__(self, max_tokens: int, max_segments: int, max_loss: int):
        self.limit = max_tokens
        self.pool = Pool((max_tokens, max_segments, max_loss))
        self.docs: dict = {}
        self.fresh: list[tuple] = []
        self.waiting = 0

    def put(self, key, size: int) -> Iterator[list[tuple]]:
        """Full sequences of a long document leave at once; its rest waits."""
        room = min(self.limit, int(self.pool.limits[2]))
        whole = size - size % room
        for start in range(0, whole, room):
            yield [(key, start, room)]
        if size > whole:
            self.docs[key] = whole
            self.fresh.append((key, size - whole))
            self.waiting += size - whole

    def flush(self, last: bool) -> Iterator[list[tuple]]:
        pool = self.pool
        for key, size in self.fresh:
            pool.add(key, size, size)
        self.fresh = []
        while self.waiting and (last or self.waiting >= 64 * self.limit):
            pieces = []
            for key, take, _ in fill(pool, True):
                pieces.append((key, self.docs[key], take))
                self.docs[key] += take
            size = sum(p[2] for p in pieces)
            self.waiting -= size
            if size < self.limit:
                yield from binary_parts(pieces, self.limit)
            else:
                yield pieces
        self.docs = {key: self.docs[key] for key, _, _ in pool.examples.values()}


SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")


def packed(batches, path: str, end_id: int, limits: tuple[int, int, int]):
    encode, packer = codec(path), Packer(*limits)
    tokens: dict[int, tuple] = {}  # of waiting documents: id, length, ids from a place on
    sequence = TaskContext.get().partitionId() * SEQUENCES_PER_TASK
    rows: list[tuple] = []
    row = held = 0

    def write(sequences) -> None:
        nonlocal sequence
        for pieces in sequences:
            offset = 0
            for key, start, length in pieces:
                doc, size, base, ids = tokens[key]
                crc = zlib.crc32(ids[start - base:start - base + length].data)
                rows.append((doc, start, length, crc, size, sequence, offset))
                offset += length
            sequence += 1

    def out():
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 7
        rows.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], NAMES)

    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            ids = np.append(encode.ids(text.as_py() or ""), np.uint32(end_id)).astype("<u4")
            tokens[row] = (doc, len(ids), 0, ids)
            write(packer.put(row, len(ids)))
            row += 1
            held += len(ids)
            if held >= WINDOW_TOKENS:
                write(packer.flush(False))
                tokens = {k: (doc, size, done, ids[done - base:].copy())
                          for k, done in packer.docs.items()
                          for doc, size, base, ids in [tokens[k]]}
                held = packer.waiting
                yield out()
    write(packer.flush(True))
    yield out()


NAMES = [c.split()[0] for c in SCHEMA.split(", ")]


def pack_documents(
    docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text",
    end_id: int = 1, max_tokens: int = 2048, max_segments: int = 256, max_loss: int | None = None,
) -> DataFrame:
    """Pack whole documents, cut freely, into sequences; one row per piece.

    Null text is empty, so its document is the end id alone. Repeated ids are packed once per
    row. An empty table gives no rows. Sequences are full or have a power of two as length.
    """
    limits = (max_tokens, max_segments, max_loss or max_tokens)
    return docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"),
    ).mapInArrow(lambda batches: packed(batches, path, end_id, limits), SCHEMA)


EXAMPLE_SCHEMA = ("example_id long, tokens long, loss_tokens long, "
                  "sequence_id long, segment long, offset long")


def placed(batches, limits: tuple[int, int, int], window: int):
    sequence = TaskContext.get().partitionId() * SEQUENCES_PER_TASK
    names = [c.split()[0] for c in EXAMPLE_SCHEMA.split(", ")]
    pool = Pool(limits)

    def drain(last: bool):
        nonlocal sequence
        rows = []
        while pool.examples and (last or len(pool.examples) > window // 4):
            chosen = fill(pool, False)
            if not chosen:
                break
            offset = 0
            for segment, (key, take, lost) in enumerate(chosen):
                rows.append((key, take, lost, sequence, segment, offset))
                offset += take
            sequence += 1
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    for batch in batches:
        ids, tokens, loss = (batch.column(i).to_pylist() for i in range(3))
        over = [i for i, t, n in zip(ids, tokens, loss, strict=True)
                if t > limits[0] or n > limits[2] or n > t or t < 1 or n < 0]
        if over:
            raise ValueError(f"examples that no sequence can hold: {over[:5]}")
        for begin in range(0, len(ids), window):
            part = slice(begin, begin + window)
            for example in zip(ids[part], tokens[part], loss[part], strict=True):
                pool.add(*example)
            yield drain(False)
    yield drain(True)


def pack_examples(
    examples: DataFrame, *, id_col: str, tokens_col: str, loss_col: str, max_tokens: int,
    max_segments: int, max_loss: int, window: int = 2000,
) -> DataFrame:
    """Place uncut instruction examples under all three limits; one row per example.

    An example that breaks a limit by itself, has no token or a null count is an error, as it
    can be neither dropped nor cut.
    """
    limits = (max_tokens, max_segments, max_loss)
    return examples.select(
        F.col(f"`{id_col}`").cast("long").alias("example_id"),
        F.coalesce(F.col(f"`{tokens_col}`").cast("long"), F.lit(0)).alias("tokens"),
        F.coalesce(F.col(f"`{loss_col}`").cast("long"), F.lit(0)).alias("loss_tokens"),
    ).mapInArrow(lambda batches: placed(batches, limits, window), EXAMPLE_SCHEMA)
