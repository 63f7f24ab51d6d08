"""Secret scan: patterns of keys and passwords, and stretches of high Shannon entropy.

Base kinds are found by pattern. Beside them, the maximal runs of a character class are
candidate strings; a window of fixed length slides over each, and its entropy follows from
incremental counts: as a symbol enters or leaves, the sum of c * log2(c) over the counts c changes
by one table entry. Windows at or above the class's limit are joined into spans. Candidates on
the allow-list (numbers, words, examples, published digests) give no span; base spans stay.

Sums are whole numbers (c * log2(c) in units of 2**-20), so results do not depend on the order of
additions.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakejobs.llm import arrow_text

# The base patterns, in the order in which kinds are listed.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_VALUE = 12
ACCESS = "AKIA[A-Z0-9]+"
ACCESS_LENGTH = 18
HEX_LENGTH = 16

# Kind, characters of the class, window, least bits a character.
CLASSES = [
    ("hex-entropy", "0-9A-Fa-f", 24, 3.0),
    ("base64-entropy", "A-Za-z0-9+/_-", 24, 4.0),
]
BASE_KINDS = ["assign", "access", "hex"]
KINDS = BASE_KINDS + [name for name, _, _, _ in CLASSES]

# Candidates that are no secrets, and what stands before a published digest.
ALLOWED = "|".join([
    "^[0-9]+$", "^[A-Za-z+/_-]+$", "(?i:example|sample|placeholder|xxxx|abcdefghij|0123456789)",
    "^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$",
    "^(?i:sha(1|224|256|384|512)|md5)[_-]"])
ALLOWED_BEFORE = (r"""(?i:sha-?(1|224|256|384|512)|md5|checksum|digest|integrity|commit|revision)"""
                  r"""["']?\x20*[:=@]?\x20*["']?""")
BEFORE = 24  # characters in front of a candidate that ALLOWED_BEFORE sees

UNIT = 1 << 20
SPAN = "array<struct<kind:string,start:long,end:long>>"


def cost_table(window: int) -> list[int]:
    """c * log2(c) in whole units, for counts up to the window."""
    return [0, 0] + [round(c * math.log2(c) * UNIT) for c in range(2, window + 1)]


def most_cost(window: int, bits: float) -> int:
    """The largest sum of c * log2(c) at which a window has that many bits a character."""
    return math.floor(window * (math.log2(window) - bits) * UNIT)


@dataclass(frozen=True)
class EntropyClass:
    kind: str
    inside: np.ndarray
    window: int
    costs: np.ndarray
    limit: int


def entropy_classes(classes=None) -> list[EntropyClass]:
    out = []
    for kind, characters, window, bits in classes or CLASSES:
        inside = np.array([bool(re.match(f"[{characters}]", chr(b))) if b < 128 else False
                           for b in range(256)])
        out.append(EntropyClass(kind, inside, window, np.array(cost_table(window), np.int64),
                                most_cost(window, bits)))
    return out


def window_costs(symbols: np.ndarray, window: int, costs: np.ndarray) -> np.ndarray:
    """The sum of c * log2(c) over the counts of every window, by incremental counts.

    How often a symbol stood in the stretch before it enters, and after it leaves, is a
    difference of ranks among the places of the same symbol."""
    n = len(symbols)
    here = np.arange(n, dtype=np.int64)
    keys = np.sort(symbols.astype(np.int64) * (n + 1) + here)

    def earlier(symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        return np.searchsorted(keys, symbol.astype(np.int64) * (n + 1) + place)

    rank = earlier(symbols, here)
    entering = rank - earlier(symbols, np.maximum(here - window + 1, 0))
    change = costs[entering + 1] - costs[entering]
    # A symbol leaves before the one that follows the window enters.
    gone = here[:max(0, n - window)]
    staying = earlier(symbols[gone], gone + window) - rank[gone] - 1
    change[window:] += costs[staying] - costs[staying + 1]
    return np.cumsum(change)[window - 1:]


def joined(starts: np.ndarray, window: int) -> Iterator[tuple[int, int]]:
    """Windows that overlap or touch, as spans."""
    cut = np.flatnonzero(np.diff(starts) > window)
    for first, last in zip(np.r_[0, cut + 1], np.r_[cut, len(starts) - 1], strict=True):
        yield int(starts[first]), int(starts[last]) + window


class SecretScanner:
    """Base patterns and entropy classes over the UTF-8 bytes of texts."""

    def __init__(self, classes=None):
        self.classes = entropy_classes(classes)
        # Over bytes, letters match in either case only within ASCII.
        self.assign = re.compile(b"(?i:" + ASSIGN.encode() + b")")
        self.access = re.compile(ACCESS.encode())
        self.hex = np.zeros(256, bool)
        self.hex[48:58] = self.hex[97:103] = True
        self.allowed = re.compile(ALLOWED.encode())
        self.before = re.compile(ALLOWED_BEFORE.encode() + rb"\Z")
        self.order = {kind: i for i, kind in enumerate(
            BASE_KINDS + [c.kind for c in self.classes])}

    def _lead(self, raw: np.ndarray, text_begin: int, begin: int) -> bytes:
        """The last characters before a place in its text."""
        lead = raw[max(text_begin, begin - 4 * BEFORE):begin]
        starts = np.flatnonzero((lead & 0xC0) != 0x80)
        return lead[starts[-BEFORE]:].tobytes() if len(starts) > BEFORE else lead.tobytes()

    def _by_entropy(self, raw: np.ndarray, at: np.ndarray):
        for one in self.classes:
            begin, end, text = arrow_text.runs(one.inside[raw], at)
            long = np.flatnonzero(end - begin >= one.window)
            for b, e, t in zip(begin[long], end[long], text[long], strict=True):
                hits = np.flatnonzero(
                    window_costs(raw[b:e], one.window, one.costs) <= one.limit)
                if len(hits) and not self.allowed.search(raw[b:e].tobytes()) \
                        and not self.before.search(self._lead(raw, at[t], b)):
                    for first, last in joined(hits, one.window):
                        yield int(t), one.kind, int(b) + first, int(b) + last

    def scan(self, texts: pa.Array) -> list[list[tuple[str, int, int]]]:
        """The spans of each text, in code points, by start and then by kind."""
        raw, at = arrow_text.utf8(texts)
        found: dict[int, list[tuple[int, int, str]]] = {}

        def add(text, kind, begin, end):
            found.setdefault(text, []).append((begin, end, kind))

        begin, end, text = arrow_text.runs(self.hex[raw], at)
        for i in np.flatnonzero(end - begin >= HEX_LENGTH):
            add(int(text[i]), "hex", int(begin[i]), int(end[i]))
        for hit in self._by_entropy(raw, at):
            add(*hit)
        filled = texts.fill_null("")
        words = pc.match_substring_regex(filled, "(?i)password|passwd|secret|token|api_?key")
        for t in np.flatnonzero(words.to_numpy(zero_copy_only=False)):
            for m in self.assign.finditer(raw[at[t]:at[t + 1]].tobytes()):
                if len(m[2]) >= ASSIGN_VALUE:
                    add(int(t), "assign", int(at[t]) + m.start(), int(at[t]) + m.end())
        keys = pc.match_substring(filled, "AKIA")
        for t in np.flatnonzero(keys.to_numpy(zero_copy_only=False)):
            for m in self.access.finditer(raw[at[t]:at[t + 1]].tobytes()):
                if len(m[0]) >= ACCESS_LENGTH:
                    add(int(t), "access", int(at[t]) + m.start(), int(at[t]) + m.end())
        out: list[list] = [[] for _ in range(len(texts))]
        for t, spans in found.items():
            starts = np.concatenate(
                [[0], np.cumsum((raw[at[t]:at[t + 1]] & 0xC0) != 0x80, dtype=np.int64)])
            spans.sort(key=lambda s: (s[0], self.order[s[2]], s[1]))
            out[t] = [(kind, int(starts[b - at[t]]), int(starts[e - at[t]]))
                      for b, e, kind in spans]
        return out


def secrets(text: Column, classes=None) -> Column:
    """All spans of a text: kind, start and end in code points, by start and then by kind.

    A null text is empty and has none. Very long texts are scanned alone, in memory a few times
    their size; one candidate may be as long as its text."""

    @F.arrow_udf(SPAN)
    def run(column: pa.Array) -> pa.Array:
        scanner = run.__dict__.setdefault("scanner", SecretScanner(classes))
        rows = []
        for _, part in arrow_text.slices(column):
            rows += scanner.scan(part)
        kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
        return pa.array([[{"kind": k, "start": s, "end": e} for k, s, e in row] for row in rows],
                        pa.list_(kind))

    return run(text)


def written(spans: Column) -> Column:
    """Spans as kind:start:end, joined by commas; none is empty."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(docs: DataFrame, *, text_col: str = "text", classes=None) -> DataFrame:
    """(doc, spans) of every row: the whole row as a struct, so no name clashes, and its spans.

    Repeated rows and rows without an id are scanned each by itself; an empty table gives none."""
    doc = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    return docs.select(doc, secrets(F.col(f"`{text_col}`"), classes).alias("spans"))
