"""Benchmark decontamination by pigeonhole edit matching.

A test item of n words may differ from a passage in up to k = n // TOLERANCE words (edits: a word changed, added or left
out). It is cut into k + 1 pieces: k edits cannot touch them all, so every passage within the budget holds one piece
unchanged. Documents are scanned for exact pieces, and Myers' bit-parallel algorithm measures the distance of the item to
the text around each hit. Words are compared with A-Z lower-cased, by 64-bit hash.

Benchmarks are a stated query set: items travel to the tasks in blocks of ITEMS, one scan of the documents a block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnwatch.llm.text import chunks, grams, words

#: One edit is allowed for so many words; items of fewer words than LEAST are no evidence and never reported.
TOLERANCE, LEAST = 5, 5
#: Items sent to the tasks at once, and the longest gram that pieces are looked up by.
ITEMS, KEY = 20_000, 6


def myers(pattern: list[int], text: list[int], most: int) -> tuple[int, int] | None:
    """(distance, end) of the best match of the whole pattern with some part of the text, the earliest end among equals;
    None beyond ``most``. One big integer holds a column of the edit matrix."""
    at: dict[int, int] = {}
    for i, x in enumerate(pattern):
        at[x] = at.get(x, 0) | 1 << i
    m = len(pattern)
    full, top = (1 << m) - 1, 1 << m - 1
    up, down, score, best = full, 0, m, None
    for end, x in enumerate(text, 1):
        eq = at.get(x, 0)
        xv = eq | down
        xh = (((eq & up) + up) ^ up) | eq
        ph, mh = down | ~(xh | up) & full, up & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph, mh = ph << 1 & full, mh << 1 & full
        up, down = mh | ~(xv | ph) & full, ph & xv
        if score <= most and (best is None or score < best[0]):
            best = score, end
    return best


def pieces(n: int) -> list[tuple[int, int]]:
    """[start, end) of the n // TOLERANCE + 1 pieces of n words, as even as can be."""
    k = n // TOLERANCE
    cuts = [i * n // (k + 1) for i in range(k + 2)]
    return list(zip(cuts, cuts[1:], strict=False))


class Items:
    """A block of items, indexed by the first words of their pieces."""

    def __init__(self, rows: list[tuple[object, str | None]]):
        hashes, row = words(pa.array([t for _, t in rows], pa.string()), lower=True)
        cuts = np.searchsorted(row, np.arange(len(rows) + 1))
        self.ids = [i for i, _ in rows]
        self.words = [hashes[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
        found: dict[int, list[tuple[int, int, int, int]]] = {}
        for item, w in enumerate(self.words):
            if len(w) >= LEAST:
                for a, b in pieces(len(w)):
                    size = min(b - a, KEY)
                    gram, _ = grams(w[a:a + size], np.zeros(size, np.int64), size)
                    found.setdefault(size, []).append((int(gram[0]), item, a, b))
        self.by_size = {}
        for size, hits in found.items():
            hits.sort()
            self.by_size[size] = np.array([h[0] for h in hits], np.uint64), [h[1:] for h in hits]

    def scan(self, hashes: np.ndarray, row: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
        """(row, item, distance, start, end) of each row's best match with each item that it holds, by word number."""
        where: dict[tuple[int, int], list[int]] = {}
        for size, (keys, hits) in self.by_size.items():
            gram, at = grams(hashes, row, size)
            left = np.searchsorted(keys, gram)
            left[left == len(keys)] = 0
            for i in np.flatnonzero(keys[left] == gram).tolist():
                j, p = int(left[i]), int(at[i])
                while j < len(keys) and keys[j] == gram[i]:
                    item, a, b = hits[j]
                    if b - a == size or np.array_equal(hashes[p:p + b - a], self.words[item][a:b]):
                        where.setdefault((int(row[p]), item), []).append(p - a)
                    j += 1
        bounds = np.searchsorted(row, np.arange(int(row[-1]) + 2)) if len(row) else row
        for (r, item), starts in sorted(where.items()):
            w = self.words[item]
            n, k, first, last = len(w), len(w) // TOLERANCE, int(bounds[r]), int(bounds[r + 1])
            pattern, best, done = w.tolist(), None, -1
            starts = sorted(set(starts))
            for i, s in enumerate(starts):
                if s <= done:  # within the text already measured
                    continue
                end = s
                for t in starts[i:]:
                    if t - end > 2 * k + n:
                        break
                    end = t
                a, done = max(first, s - k), end
                part = hashes[a:min(last, end + n + k)].tolist()
                found = myers(pattern, part, k)
                if found and (best is None or found[0] < best[0]):
                    stop = a + found[1]
                    back = myers(pattern[::-1], part[:found[1]][::-1][:n + k], found[0])
                    best = found[0], stop - back[1], stop
            if best:
                yield r, item, best[0], best[1] - first, best[2] - first


def _blocks(benchmark: DataFrame, item_col: str, text_col: str) -> Iterator[Items]:
    b = benchmark.select(F.col(item_col).alias("i"), F.col(text_col).alias("t"))
    n = max(1, -(-b.count() // ITEMS))
    for k in range(n):  # the second factor keeps blocks within the bound when hashes are uneven
        block = b if n == 1 else b.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == k)
        rows = [(r["i"], r["t"]) for r in block.toLocalIterator()]
        for at in range(0, max(1, len(rows)), ITEMS):
            yield Items(rows[at:at + ITEMS])


def matches(documents: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(id, item, distance, start, end): per document and item that it holds, the best passage, in word numbers.

    Null and empty texts hold nothing; repeated documents and items give repeated rows; other columns are not read; an
    empty table on either side gives an empty result. Of equally near passages the earliest counts.
    """
    kind, item_kind = dict(documents.dtypes)[id_col], dict(benchmark.dtypes)[item_col]
    schema = f"`{id_col}` {kind}, `{item_col}` {item_kind}, distance int, start int, `end` int"
    item_type = pa.schema(_arrow(benchmark.select(item_col))).field(0).type
    out = None
    for items in _blocks(benchmark, item_col, item_text_col):
        def run(batches: Iterator[pa.RecordBatch], items=items) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in chunks(batch, text_col):
                    found = list(items.scan(*words(part.column(1), lower=True)))
                    if found:
                        r, item, d, a, b = zip(*found, strict=True)
                        yield pa.RecordBatch.from_arrays(
                            [part.column(0).take(pa.array(r)), pa.array([items.ids[i] for i in item], item_type),
                             *[pa.array(x, pa.int32()) for x in (d, a, b)]], names=[id_col, item_col, "distance", "start", "end"])

        more = documents.select(id_col, text_col).mapInArrow(run, schema)
        out = more if out is None else out.unionByName(more)
    return out


def _arrow(df: DataFrame):
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(df.schema)


def clean(documents: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
          item_text_col: str = "text") -> DataFrame:
    """The rows of ``documents``, all columns, that hold no benchmark item; decided beside the text, without a shuffle."""
    for items in _blocks(benchmark, item_col, item_text_col):
        def run(batches: Iterator[pa.RecordBatch], items=items) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in chunks(batch, text_col):
                    keep = np.ones(part.num_rows, bool)
                    keep[[f[0] for f in items.scan(*words(part.column(part.schema.get_field_index(text_col)), lower=True))]] = False
                    yield part.filter(pa.array(keep))

        documents = documents.mapInArrow(run, documents.schema)
    return documents
