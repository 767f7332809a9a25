"""Byte-level BPE encoding and decoding with forced-boundary splitting.

Two neighbouring bytes that stand next to each other inside no vocabulary token can never be merged, whatever the
merge order. Every such pair is a certain cut. A pre-token is cut there, each fragment is encoded by itself, and the
fragments' ids are concatenated. Pre-tokens recur, so a worker remembers their ids from task to task.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

#: The byte-level pre-tokenizer's pattern (fixed value of the file format); ``\s`` is spelled out as Unicode White_Space.
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
           r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
#: Pre-tokens remembered by a Python worker (about 200 bytes each); beyond it the memory is emptied, results stay the same.
REMEMBERED = 250_000
#: Ranks after every merge.
NEVER = 1 << 40


def byte_letters() -> dict[str, int]:
    """The byte of each letter that byte-level vocabularies write bytes with: printable ones stand for themselves, the
    others for the code points from 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ForcedBoundaryBpe:
    """The vocabulary of one tokenizer file."""

    def __init__(self, source: str):
        spec = json.loads(source)
        letters, model = byte_letters(), spec["model"]
        added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        if spec.get("normalizer") or spec["pre_tokenizer"].get("add_prefix_space") or model.get("ignore_merges") or any(
                t.get(k) for t in spec.get("added_tokens", []) for k in ("lstrip", "rstrip", "single_word", "normalized")):
            raise ValueError("only plain byte-level BPE files are supported")
        as_bytes = lambda token: bytes(letters[c] for c in token)
        ids = {as_bytes(t): i for t, i in model["vocab"].items() if t not in added}
        self.single = [ids[bytes([b])] for b in range(256)]
        self.merges, self.made = {}, []  # pair of ids -> rank; rank -> id of the merged token
        for rank, pair in enumerate(model["merges"]):
            left, right = map(as_bytes, pair if isinstance(pair, list) else pair.split(" "))
            self.merges[ids[left], ids[right]] = rank
            self.made.append(ids[left + right])
        self.token = [b""] * (max([*ids.values(), *added.values()]) + 1)
        for table in (ids, {k.encode(): v for k, v in added.items()}):
            for token, i in table.items():
                self.token[i] = token
        self.joined = {pair for token in ids for pair in zip(token, token[1:], strict=False)}
        self.added = added
        self.specials = regex.compile("|".join(regex.escape(t) for t in sorted(added, key=len, reverse=True))) if added else None
        self.pattern = regex.compile(PATTERN)
        self.known: dict[str, bytes] = {}

    def cut(self, raw: bytes) -> list[bytes]:
        """The fragments of a pre-token between the pairs that no token holds."""
        at = [0, *[i for i, pair in enumerate(zip(raw, raw[1:], strict=False), 1) if pair not in self.joined], len(raw)]
        return [raw] if len(at) == 2 else [raw[i:j] for i, j in zip(at, at[1:], strict=False)]

    def merge(self, fragment: bytes) -> list[int]:
        """Merges by rank, lowest first, leftmost among equals. A fragment's length is bounded by the text alone, so the
        pairs are kept in a heap over a linked list: n log n even for a run of a million equal letters."""
        ids = [self.single[b] for b in fragment]
        n = len(ids)
        if n < 2:
            return ids
        merges, made = self.merges, self.made
        if n <= 64:
            get = merges.get
            order = [get(pair, NEVER) for pair in zip(ids, ids[1:], strict=False)]
            while order and (best := min(order)) != NEVER:
                i = order.index(best)
                ids[i:i + 2] = [made[best]]
                del order[i]
                if i:
                    order[i - 1] = get((ids[i - 1], ids[i]), NEVER)
                if i < len(order):
                    order[i] = get((ids[i], ids[i + 1]), NEVER)
            return ids
        from heapq import heapify, heappop, heappush
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        heap = [(rank, i, *pair) for i, pair in enumerate(zip(ids, ids[1:], strict=False)) if (rank := merges.get(pair)) is not None]
        heapify(heap)
        alive = [True] * n
        while heap:
            rank, i, a, b = heappop(heap)
            j = after[i]
            if not alive[i] or j < 0 or ids[i] != a or ids[j] != b:
                continue
            ids[i], alive[j], after[i] = made[rank], False, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for left in (before[i], i):
                right = after[left] if left >= 0 else -1
                if right >= 0 and (rank := merges.get((ids[left], ids[right]))) is not None:
                    heappush(heap, (rank, left, ids[left], ids[right]))
        return [x for x, keep in zip(ids, alive, strict=True) if keep]

    def pretoken(self, piece: str) -> bytes:
        out = []
        for fragment in self.cut(piece.encode()):
            out += self.merge(fragment)
        return struct.pack(f"<{len(out)}I", *out)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers. Strings of added tokens become those tokens."""
        if self.specials is None:
            return self.plain(text)
        out, at = [], 0
        for m in self.specials.finditer(text):
            out += [self.plain(text[at:m.start()]), np.array([self.added[m[0]]], "<u4").tobytes()]
            at = m.end()
        return self.plain(text) if not at else b"".join([*out, self.plain(text[at:])])

    def plain(self, text: str) -> bytes:
        known, out = self.known, []
        for piece in self.pattern.findall(text):
            ids = known.get(piece)
            if ids is None:
                ids = self.pretoken(piece)
                if len(piece) <= 64:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[piece] = ids
            out.append(ids)
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """The text of packed ids; ids outside the vocabulary add nothing, broken UTF-8 becomes U+FFFD."""
        token, n = self.token, len(self.token)
        return b"".join([token[i] for i in np.frombuffer(ids, "<u4").tolist() if i < n]).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def _model(source: str) -> ForcedBoundaryBpe:
    return ForcedBoundaryBpe(source)


def _apply(df: DataFrame, tokenizer: str, columns: list[str], schema: str, f) -> DataFrame:
    with open(tokenizer, encoding="utf-8") as file:  # a vocabulary is of fixed size, some MB
        source = df.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(source.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                yield f(model, part)

    return df.select(*columns).mapInArrow(run, schema)


def encode(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, token_ids binary): each text's ids, packed as little-endian unsigned 32-bit integers.

    Null text counts as empty and has no ids. One row in, one row out; repeated rows and null ids stay. Other columns
    of ``df`` are not read. An empty table gives an empty table.
    """
    kind = dict(df.dtypes)[id_col]

    def one(model, part):
        ids = [model.encode(t or "") for t in part.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary())], names=[id_col, "token_ids"])

    return _apply(df, tokenizer, [id_col, text_col], f"`{id_col}` {kind}, token_ids binary", one)


def decode(df: DataFrame, tokenizer: str, id_col: str = "doc_id", ids_col: str = "token_ids") -> DataFrame:
    """(id, token_ids, decoded string): the text of packed ids. Null ids decode to the empty text."""
    kind = dict(df.dtypes)[id_col]

    def one(model, part):
        text = [model.decode(x or b"") for x in part.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(text, pa.string())],
                                          names=[id_col, "token_ids", "decoded"])

    return _apply(df, tokenizer, [id_col, ids_col], f"`{id_col}` {kind}, token_ids binary, decoded string", one)


def round_trip(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, token_ids binary, decoded string): ``decode(encode(df))`` in one pass, with one Python worker and one vocabulary a
    task instead of two. Nulls, repeats and empty tables as there."""
    kind = dict(df.dtypes)[id_col]

    def one(model, part):
        ids = [model.encode(t or "") for t in part.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary()), pa.array([model.decode(x) for x in ids], pa.string())],
                                          names=[id_col, "token_ids", "decoded"])

    return _apply(df, tokenizer, [id_col, text_col], f"`{id_col}` {kind}, token_ids binary, decoded string", one)
