"""Repair of conversations: faults, and the cheapest edits to a legal sequence of roles.

Rows are ordered by a range partition, which deals a long conversation out to several tasks. A task
cuts its rows into blocks of bounded size; a conversation that lies in one block is repaired
there. Those that lie in several (at the borders of tasks, or very long ones) are put together from
their blocks: repeated turns by a window over digests, costs by 4 x 4 tables from state to state,
one a block, and the edits of each block between the states that its neighbours fix. Only
the final digest, which has to see all text in order, streams through one task a conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakejobs.llm import repair_paths as paths
from lakejobs.llm.components import stored

BLOCK_ROWS, BLOCK_CHARS = 4096, 1 << 22
SOLVED_ROWS = 1 << 15  # rows that are repaired together
SPACE = " \t\n\v\f\r"
KINDS = {"s": paths.SYSTEM, "u": paths.USER, "a": paths.ASSISTANT}
LEGAL = {(paths.SYSTEM, paths.USER), (paths.USER, paths.ASSISTANT),
         (paths.ASSISTANT, paths.USER)}
FILLED = {paths.AFTER_USER: "user", paths.AFTER_ASSISTANT: "assistant"}
LONGEST = (1 << 63) - 1

RESULT = ("gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
          "audit string, repaired_sha256 string")
COUNTED = ("codes binary, low long, high long, turns long")


def damage(rows: DataFrame) -> DataFrame:
    """Conversation rows with damage by the CRC-32 of "conv_id:turn" modulo 20.

    0 drops the row (``times`` 0), 1 empties its text, 2 removes its full stops, 3 repeats it
    (``times`` 2), 4 makes its role user. Nulls of the key, role and text are one space; the
    columns conv_id and turn stay as they are, and no other column is kept."""
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"),
                   F.coalesce(F.col("turn").cast("string"), blank))
    kind = F.crc32(key.cast("binary")) % 20
    text = F.coalesce(F.col("text"), blank)
    return rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.when(kind == 4, F.lit("user")).otherwise(F.coalesce(F.col("role"), blank)).alias("role"),
        F.when(kind.isin(0, 1), F.lit("")).when(kind == 2, F.translate(text, ".!?", ""))
        .otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("times"))


@dataclass
class Block:
    """Consecutive turns of one conversation."""

    conv: int | None
    roles: list[str] = field(default_factory=list)
    texts: list[str] = field(default_factory=list)
    codes: bytearray = field(default_factory=bytearray)
    seen: set = field(default_factory=set)
    low: int | None = None
    high: int | None = None
    turns: int = 0
    chars: int = 0

    def add(self, turn: int | None, role: str, text: str, times: int) -> None:
        if not times:
            return
        if turn is not None and turn != self.high:
            self.low = turn if self.low is None else self.low
            self.high, self.turns = turn, self.turns + 1
        kind = KINDS.get(role[:1], paths.OTHER)
        said = text.strip(SPACE)
        for _ in range(times):
            fault = 0
            if not said:
                fault = paths.BLANK
            elif (role, text) in self.seen:
                fault = paths.DUPLICATE
            elif said[-1] not in ".!?":
                fault = paths.TRUNCATED
            self.seen.add((role, text))
            self.roles.append(role)
            self.texts.append(text)
            self.codes.append(kind | fault)
        self.chars += times * (len(role) + len(text))

    def full(self, rows: int) -> bool:
        return len(self.codes) >= rows or self.chars >= BLOCK_CHARS


def gaps(low: int | None, high: int | None, turns: int) -> int:
    return 0 if low is None else min(high - low + 1 - turns, LONGEST)


def faults(codes: bytes) -> tuple[int, int, int, int]:
    """Blank, duplicate and truncated turns, and neighbours of roles that may not follow."""
    values = np.frombuffer(codes, np.uint8)
    kinds = [int(c) & 3 for c in values]
    wrong = sum(pair not in LEGAL for pair in zip(kinds, kinds[1:], strict=False))
    return (*[int(((values & bit) != 0).sum())
              for bit in (paths.BLANK, paths.DUPLICATE, paths.TRUNCATED)], wrong)


def repaired(edits, turns, states, roles, texts) -> Iterator[str]:
    """The lines "role:text" that the edits leave."""
    for edit, turn, state in zip(edits.tolist(), turns.tolist(), states.tolist(), strict=True):
        if edit == paths.KEEP:
            yield f"{roles[turn]}:{texts[turn]}"
        elif edit == paths.REROLE:
            yield f"{FILLED[state]}:{texts[turn]}"
        elif edit == paths.INSERT:
            yield f"{FILLED[state]}:"


def completed(state: int) -> list[str]:
    """The empty turns that complete the roles at the end of a conversation."""
    return {paths.AFTER_SYSTEM: ["user:", "assistant:"], paths.AFTER_USER: ["assistant:"]}.get(
        state, [])


def digest(lines: list[str]) -> str:
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def solve(blocks: list[Block]) -> Iterator[dict]:
    """Result rows of whole conversations, those of similar length together."""
    by_length: dict[int, list[Block]] = {}
    for block in blocks:
        by_length.setdefault(len(block.codes).bit_length(), []).append(block)
    for same in by_length.values():
        found = paths.Paths(
            np.frombuffer(b"".join(b.codes for b in same), np.uint8),
            np.array([len(b.codes) for b in same], np.int64),
            np.tile(paths.END_COST, (len(same), 1)))
        cost = found.cost_from(paths.EMPTY)
        roles = [r for b in same for r in b.roles]
        texts = [t for b in same for t in b.texts]
        walks = found.walk(np.arange(len(same)), np.full(len(same), paths.EMPTY))
        for i, (block, (edits, turns, states, end)) in enumerate(zip(same, walks, strict=True)):
            blank, duplicate, truncated, illegal = faults(bytes(block.codes))
            lines = [*repaired(edits, turns, states, roles, texts), *completed(end)]
            yield {"conv_id": block.conv, "gaps": gaps(block.low, block.high, block.turns),
                   "blank": blank, "duplicate": duplicate, "truncated": truncated,
                   "illegal": illegal, "cost": int(cost[i]),
                   "audit": paths.audit(edits) + paths.END_LETTERS[end],
                   "repaired_sha256": digest(lines)}


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "int": pa.int32(),
             "array<string>": pa.list_(pa.string()), "array<binary>": pa.list_(pa.binary()),
             "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32())}
    pairs = [part.split() for part in ddl.split(", ")]
    return pa.schema([(name, kinds[kind]) for name, kind in pairs])


def _batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema)


CUT = f"conv_id long, place long, {RESULT}, roles array<string>, texts array<string>, " \
      f"digests array<binary>, {COUNTED}"
CUT_SCHEMA = _arrow(CUT)


def cut(batches: Iterator[pa.RecordBatch], block_rows: int) -> Iterator[pa.RecordBatch]:
    """Ordered rows of one task: results of the conversations that lie in it whole, blocks (with a
    place) of those that may go on elsewhere."""
    now, nth, run, pieces, waiting, rows = None, 0, 0, 0, [], 0

    def as_block(block: Block, part: int, number: int) -> pa.RecordBatch:
        marks = [hashlib.sha256(f"{len(r)}:{r}{t}".encode()).digest()
                 for r, t in zip(block.roles, block.texts, strict=True)]
        return _batch([{
            "conv_id": block.conv, "place": (part << 32) + number, "roles": block.roles,
            "texts": block.texts, "digests": marks, "codes": bytes(block.codes),
            "low": block.low, "high": block.high, "turns": block.turns}], CUT_SCHEMA)

    part = 0
    for batch in batches:
        columns = [batch.column(n).to_pylist()
                   for n in ("conv_id", "turn", "role", "text", "times", "part")]
        for conv, turn, role, text, times, part in zip(*columns, strict=True):
            if now is not None and conv != now.conv:
                if run == 0 or pieces:
                    yield as_block(now, part, nth)
                    nth += 1
                else:
                    waiting.append(now)
                    rows += len(now.codes) + 1
                now, run, pieces = None, run + 1, 0
            elif now is not None and now.full(block_rows):
                yield as_block(now, part, nth)
                nth, pieces, now = nth + 1, pieces + 1, None
            if now is None:
                now = Block(conv)
            now.add(turn, role, text, times)
        if rows >= SOLVED_ROWS:
            yield _batch(list(solve(waiting)), CUT_SCHEMA)
            waiting, rows = [], 0
    if now is not None:
        yield as_block(now, part, nth)
    if waiting:
        yield _batch(list(solve(waiting)), CUT_SCHEMA)


MEASURED = f"place long, conv_id long, {COUNTED}, costs array<long>"
TOLD = "place long, exits array<long>, final int, gaps long, blank long, duplicate long, " \
       "truncated long, illegal long, cost long"
WALKED = "place long, conv_id long, audits array<string>, ends array<int>"
PIECES = "conv_id long, place long, audit string, lines array<string>"


def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Codes with the duplicates of earlier blocks, and the cost from each state to each."""
    schema = _arrow(MEASURED)
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            codes = bytearray(row["codes"])
            for at in row["repeated"] or []:
                if not codes[at] & paths.BLANK:
                    codes[at] = codes[at] & 3 | paths.DUPLICATE
            values, size = np.frombuffer(bytes(codes), np.uint8), np.array([len(codes)], np.int64)
            costs = np.zeros((4, 4), np.int64)
            for end in range(paths.STATES):
                exits = np.full((1, 4), paths.NEVER)
                exits[0, end] = 0
                costs[:, end] = paths.Paths(values, size, exits).cost[0]
            rows.append({k: row[k] for k in ("place", "conv_id", "low", "high", "turns")} | {
                "codes": bytes(codes), "costs": costs.ravel().tolist()})
        if rows:
            yield _batch(rows, schema)


def exits_of(table: pa.Table) -> pa.Table:
    """The blocks of one conversation: the cost behind each, and its counts at the last."""
    rows = sorted(table.to_pylist(), key=lambda r: r["place"])
    exits = paths.END_COST
    told = []
    for row in reversed(rows):
        told.append({"place": row["place"], "exits": [int(e) for e in exits], "final": 0})
        exits = (np.array(row["costs"]).reshape(4, 4) + exits).min(1)
    low = high = last = None
    turns, counts = 0, np.zeros(4, np.int64)
    for row in rows:
        if row["low"] is not None:
            turns += row["turns"] - (row["low"] == high)
            low, high = row["low"] if low is None else low, row["high"]
        if row["codes"]:
            counts += faults(row["codes"])
            counts[3] += last is not None and (last, row["codes"][0] & 3) not in LEGAL
            last = row["codes"][-1] & 3
    told[0] |= {"final": 1, "gaps": gaps(low, high, turns), "cost": int(exits[paths.EMPTY])} | dict(
        zip(("blank", "duplicate", "truncated", "illegal"), counts.tolist(), strict=True))
    return pa.Table.from_pylist(told, _arrow(TOLD))


def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The least cheapest edits of a block from each state before it."""
    schema = _arrow(WALKED)
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            found = paths.Paths(np.frombuffer(row["codes"], np.uint8),
                                np.array([len(row["codes"])], np.int64),
                                np.array([row["exits"]], np.int64))
            walks = list(found.walk(np.zeros(4, np.int64), np.arange(paths.STATES)))
            rows.append({"place": row["place"], "conv_id": row["conv_id"],
                         "audits": [paths.audit(w[0]) for w in walks],
                         "ends": [w[3] for w in walks]})
        if rows:
            yield _batch(rows, schema)


def entries_of(table: pa.Table) -> pa.Table:
    """The state before each block of one conversation."""
    state, out = paths.EMPTY, []
    for row in sorted(table.to_pylist(), key=lambda r: r["place"]):
        out.append({"place": row["place"], "entry": state})
        state = row["ends"][state]
    return pa.Table.from_pylist(out, _arrow("place long, entry int"))


def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edits of a block and the lines that they leave, the end of a conversation completed."""
    schema = _arrow(PIECES)
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            letters = row["audits"][row["entry"]]
            edits, turns, states, state, turn = [], [], [], row["entry"], 0
            for letter in letters.encode():
                edit = "DIKR".index(chr(letter))
                if edit == paths.KEEP:
                    state = int(paths.KEPT[row["codes"][turn] & 3, state])
                elif edit != paths.DELETE:
                    state = int(paths.FILLED[state])
                edits.append(edit)
                turns.append(turn)
                states.append(state)
                turn += edit != paths.INSERT
            lines = list(repaired(np.array(edits), np.array(turns), np.array(states),
                                  row["roles"], row["texts"]))
            if row["final"]:
                letters += paths.END_LETTERS[state]
                lines += completed(state)
            rows.append({"conv_id": row["conv_id"], "place": row["place"], "audit": letters,
                         "lines": lines})
        if rows:
            yield _batch(rows, schema)


def united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in order: the audit and the digest of each conversation, one block in memory."""
    schema = _arrow("conv_id long, audit string, repaired_sha256 string")
    conv, audit, hashed, any_line, started = None, [], hashlib.sha256(), False, False

    def done() -> pa.RecordBatch:
        return _batch([{"conv_id": conv, "audit": "".join(audit),
                        "repaired_sha256": hashed.hexdigest()}], schema)

    for batch in batches:
        for row in batch.to_pylist():
            if started and row["conv_id"] != conv:
                yield done()
                audit, hashed, any_line = [], hashlib.sha256(), False
            conv, started = row["conv_id"], True
            audit.append(row["audit"])
            if row["lines"]:
                hashed.update((b"\n" if any_line else b"") + "\n".join(row["lines"]).encode())
                any_line = True
    if started:
        yield done()


def joined_blocks(blocks: DataFrame) -> DataFrame:
    """Results of the conversations that lie in several blocks."""
    mark = Window.partitionBy("conv_id", "digest").orderBy("place", "at")
    repeats = blocks.select("conv_id", "place", F.posexplode("digests").alias("at", "digest")) \
        .withColumn("nth", F.row_number().over(mark)).where("nth > 1") \
        .groupBy("place").agg(F.collect_list("at").alias("repeated"))
    counted = [c.split()[0] for c in COUNTED.split(", ")]
    measured = stored(blocks.select("place", "conv_id", *counted).join(repeats, "place", "left")
                      .mapInArrow(measure, MEASURED), "measured")
    told = stored(measured.groupBy("conv_id").applyInArrow(exits_of, TOLD), "exits")
    walked = stored(measured.join(told, "place").select("place", "conv_id", "codes", "exits")
                    .mapInArrow(walk, WALKED), "walked")
    entries = walked.groupBy("conv_id").applyInArrow(entries_of, "place long, entry int")
    parts = blocks.select("place", "conv_id", "roles", "texts") \
        .join(measured.select("place", "codes"), "place") \
        .join(told.select("place", "final"), "place") \
        .join(walked.select("place", "audits"), "place").join(entries, "place") \
        .mapInArrow(pieces, PIECES)
    ends = parts.repartition("conv_id").sortWithinPartitions("conv_id", "place").mapInArrow(
        united, "conv_id long, audit string, repaired_sha256 string")
    totals = told.where("final = 1").join(measured.select("place", "conv_id"), "place") \
        .drop("place", "exits", "final").withColumnRenamed("conv_id", "_conv")
    return totals.join(ends, F.col("_conv").eqNullSafe(F.col("conv_id"))).drop("_conv")


def repair(rows: DataFrame, times_col: str | None = None,
           block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per conv_id of rows (conv_id, turn, role, text): faults and the cheapest edits.

    ``times_col`` tells how often a row stands there: 0 keeps only its conversation in the
    result. Nulls of role and text are empty; other columns are left out. A
    row is a fault once: blank, else a repeat of role and text, else cut off before a full stop.
    Rows of one turn follow in the order of role and text, nulls of turn first; repeated rows are
    duplicates; rows without a conv_id are one conversation. A role without initial s, u or a
    cannot be kept. Gaps beyond a long are its largest value. An empty table gives no rows."""
    first = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), F.asc("role")]
    ordered = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
        (F.col(times_col) if times_col else F.lit(1)).cast("int").alias("times")) \
        .repartitionByRange(*first, F.substring("text", 1, 16).asc()) \
        .sortWithinPartitions(*first, F.asc("text")) \
        .withColumn("part", F.spark_partition_id().cast("long"))
    done = stored(ordered.mapInArrow(lambda it: cut(it, block_rows), CUT), "turns")
    names = ["conv_id", *[c.split()[0] for c in RESULT.split(", ")]]
    return done.where("place IS NULL").select(names).union(
        joined_blocks(done.where("place IS NOT NULL")).select(names))
