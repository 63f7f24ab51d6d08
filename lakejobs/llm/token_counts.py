"""Token counts: batches balanced by bytes, encoded in Arrow functions that return lengths only.

Texts are cut at spaces, where no token of a vocabulary that drops white space can cross; the
length of every distinct piece is asked of the tokenizer once and kept in a bounded memo.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

BATCH_CHARS = 1 << 20
MEMO_ENTRIES = 400_000
MEMO_CHARS = 64  # longer pieces are counted and not kept, as they hardly come again
_LOADED: dict[str, PieceLengths] = {}

# Fixed value: how the vocabulary splits text.
SPLIT = {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}
# Letters whose canonical form is their own and that lower-case one to one, then signs but for
# the apostrophe (contractions) and angle brackets (special tokens).
SIMPLE = re.compile(r"([A-Za-zªµºÀ-ÖØ-öø-ÿ]*)([!-&(-/:;=?@\[-`{-~]*)")


def _byte_signs() -> dict[int, int]:
    """The characters that stand for bytes in byte-level vocabularies: printable Latin-1 stands
    for itself, the others follow from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: 256 + i for i, b in enumerate(hidden)}


BYTE_SIGNS = _byte_signs()


def _types(config: dict | None, inner: str) -> list[str]:
    return [x["type"] for x in (config or {}).get(inner, [])]


class PieceLengths:
    """Token counts of pieces without spaces; about ``MEMO_ENTRIES`` of them are kept, none
    longer than ``MEMO_CHARS`` beyond the batch it is in, so the memo is bounded in bytes.

    New pieces are encoded in one call with a special token as border between them. Where the
    vocabulary lower-cases, drops white space and splits letters from signs, a piece of Latin
    letters and signs needs none of its general text handling: its two parts go straight to the
    byte-pair model.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.memo: dict[str, int] = {"": 0}
        special = self.tokenizer.get_added_tokens_decoder()
        self.marker_id, token = max(special.items())
        self.marker = token.content
        self.specials = [t.content for t in special.values()]
        config = json.loads(self.tokenizer.to_str())
        self.model = self.tokenizer.model if (
            _types(config["normalizer"], "normalizers") == ["NFC", "Replace", "Lowercase"]
            and config["pre_tokenizer"].get("pretokenizers", [{}])[0].get("pattern") == SPLIT
        ) else None

    def learn(self, pieces: set[str]) -> None:
        if len(self.memo) + len(pieces) > MEMO_ENTRIES:
            self.memo = {"": 0}
        memo, general = self.memo, []
        for piece in pieces:
            parts = self.model and SIMPLE.fullmatch(piece)
            if parts:
                letters, signs = parts.groups()
                memo[piece] = self.part(letters.lower()) + self.part(signs)
            else:
                general.append(piece)
        plain = []
        for piece in general:
            if "<" in piece and any(s in piece for s in self.specials):
                memo[piece] = len(self.tokenizer.encode(piece, add_special_tokens=False).ids)
            else:
                plain.append(piece)
        if plain:
            joined = self.marker.join(plain) + self.marker
            ids = self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids
            border = np.flatnonzero(np.asarray(ids) == self.marker_id)
            memo.update(zip(plain, (np.diff(border, prepend=-1) - 1).tolist(), strict=True))

    def part(self, part: str) -> int:
        known = self.memo.get(part)
        if known is None:
            shown = part.encode().decode("latin-1").translate(BYTE_SIGNS)
            known = len(self.model.tokenize(shown))
            if len(part) <= MEMO_CHARS:
                self.memo[part] = known
        return known

    def count(self, batch: list[tuple[int, str]], totals: np.ndarray) -> None:
        """Add the tokens of each (row, chunk) to its row."""
        split = [chunk.replace("\n", " ").split(" ") for _, chunk in batch]
        wanted = set().union(*split)
        fresh = wanted.difference(self.memo)
        if len(self.memo) + len(fresh) > MEMO_ENTRIES:  # emptied by learn: all are new again
            fresh = wanted
            self.memo = {"": 0}
        self.learn(fresh)
        known = self.memo.__getitem__
        for (row, _), pieces in zip(batch, split, strict=True):
            totals[row] += sum(map(known, pieces))
        for piece in fresh:
            if len(piece) > MEMO_CHARS:
                del self.memo[piece]


def balanced(texts: list[str | None], limit: int = BATCH_CHARS) -> Iterator[list[tuple[int, str]]]:
    """Batches of (row, chunk) of about ``limit`` characters; long texts are cut at spaces."""
    batch, size = [], 0
    for row, text in enumerate(texts):
        begin = 0
        while text and begin < len(text):
            end = len(text)
            if end - begin > limit:
                end = text.rfind(" ", begin + 1, begin + limit)
                if end < 0:
                    end = text.find(" ", begin + limit)
                if end < 0:
                    end = len(text)
            if size and size + end - begin > limit:
                yield batch
                batch, size = [], 0
            batch.append((row, text[begin:end]))
            size += end - begin
            begin = end
    if batch:
        yield batch


def lengths(texts: pa.Array, path: str) -> pa.Array:
    if path not in _LOADED:
        _LOADED[path] = PieceLengths(path)
    totals = np.zeros(len(texts), np.int64)
    for batch in balanced(texts.to_pylist()):
        _LOADED[path].count(batch, totals)
    return pa.array(totals, pa.int64())


def token_count(text: Column, path: str) -> Column:
    """Tokens of each whole text (null: 0) under a vocabulary file that drops white space; row by
    row, so repeated rows count alike and null keys play no part.

    Special strings inside a text are special tokens, as the library's default has it.
    """

    @F.arrow_udf("long")
    def encoded_length(texts: pa.Array) -> pa.Array:
        return lengths(texts, path)

    return encoded_length(text)
