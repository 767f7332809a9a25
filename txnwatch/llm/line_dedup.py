"""Lines that recur in many documents, dropped everywhere: keep bitmaps from one range-partitioned stream of line hashes.

Every distinct line of a document is one row (line hash, document, places). The rows are range-partitioned by (hash,
document) and sorted by hash, document and place inside a partition, so a line's documents pass one after the other and
are counted as a stream of first occurrences. As the range goes on below the hash, a line that a third of all documents
hold is spread over many partitions. What a partition cannot decide alone, its first and its last line, it hands out as
one summary each with fewer rows than the threshold; the summaries of all partitions settle those.

The result holds no text: a document gets a compressed bitmap with one bit a line. ``apply`` reads texts by it.

A document is a (doc_id, text); equal rows are one document and count once, rows without an id are told apart by their
texts. Lines are compared by a 64-bit hash and their length in bytes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnwatch.llm import text as T
from txnwatch.session import ensure_checkpoint_dir

#: A line in so many documents goes, if it has so many code points at least.
DOCUMENTS, LEAST = 10, 1
DROP, OPEN, EDGE = 0, 1, 2
ORDER = ["key", "size", "doc_id", "text_hash", "part"]
LINES = "key long, size int, doc_id long, text_hash long, at binary"
SEEN = "kind int, key long, size int, doc_id long, text_hash long, at binary, part int, n long, last_id long, last_hash long"


def _packed(places: np.ndarray, starts: np.ndarray) -> pa.Array:
    """Binary values: the places from each start to the next one, four bytes each."""
    offsets = (np.r_[starts, len(places)] * 4).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(places.astype("<u4").tobytes())])


def _lines(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in T.chunks(batch, "text"):
                key, size, points, row, number = T.lines(chunk.column("text"))
                held = np.flatnonzero(points >= least)
                held = held[np.lexsort((number[held], size[held], key[held], row[held]))]
                if not len(held):
                    continue
                key, size, row = key[held], size[held], row[held]
                starts = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (size[1:] != size[:-1]) | (row[1:] != row[:-1])])
                of = pa.array(row[starts])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[starts].view(np.int64)), pa.array(size[starts].astype(np.int32)), chunk.column("doc_id").take(of),
                     chunk.column("text_hash").take(of), _packed(number[held], starts)], names=["key", "size", "doc_id", "text_hash", "at"])

    return run


class _Line:
    """The line that a partition's stream is in: its first row, documents so far, and their rows while they are too few."""

    def __init__(self, row: pa.RecordBatch, first: bool):
        self.row, self.first, self.n, self.held, self.last = row, first, 0, [], (None, None)


def _rows(kind: int, rows: list[pa.RecordBatch], part: int, n: int = 0, last: tuple = (None, None)) -> Iterator[pa.RecordBatch]:
    for batch in rows:
        k, long = batch.num_rows, pa.int64()
        yield pa.RecordBatch.from_arrays(
            [pa.array([kind] * k, pa.int32()), *[batch.column(c) for c in ("key", "size", "doc_id", "text_hash", "at")],
             pa.array([part] * k, pa.int32()), pa.array([n] * k, long), pa.array([last[0]] * k, long), pa.array([last[1]] * k, long)],
            names=[x.split()[0] for x in SEEN.split(", ")])


def _seen(most: int):
    """Streams a sorted partition: rows of lines in ``most`` documents, and of its first and last line what is needed to settle
    them. Of a line it holds fewer than ``most`` rows at a time."""
    def add(line: _Line, batch: pa.RecordBatch, fresh: np.ndarray, a: int, z: int, part: int) -> Iterator[pa.RecordBatch]:
        at = a + np.flatnonzero(fresh[a:z])
        if len(at):
            line.held.append(batch.take(pa.array(at)))
            line.n += len(at)
        line.last = (batch.column("doc_id")[z - 1].as_py(), batch.column("text_hash")[z - 1].as_py())
        if line.n >= most:
            yield from _rows(DROP, line.held, part)
            line.held = []

    def leave(line: _Line, end: bool, part: int) -> Iterator[pa.RecordBatch]:
        if line.first or end:
            yield from _rows(OPEN, line.held, part)
            yield from _rows(EDGE, [line.row], part, line.n, line.last)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, line = 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            key, size, texts = (batch.column(c).to_numpy() for c in ("key", "size", "text_hash"))
            ids, known = batch.column("doc_id").fill_null(0).to_numpy(), batch.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
            new = np.r_[True, (key[1:] != key[:-1]) | (size[1:] != size[:-1])]
            fresh = new | np.r_[True, (ids[1:] != ids[:-1]) | (known[1:] != known[:-1]) | (texts[1:] != texts[:-1])]
            if line is None:
                part, line = batch.column("task")[0].as_py(), _Line(batch.slice(0, 1), True)
            elif (line.row.column("key")[0].as_py(), line.row.column("size")[0].as_py()) != (int(key[0]), int(size[0])):
                yield from leave(line, False, part)
                line = _Line(batch.slice(0, 1), False)
            elif line.last == (ids[0] if known[0] else None, texts[0]):
                fresh[0] = False
            bounds = np.r_[np.flatnonzero(new), len(key)]
            yield from add(line, batch, fresh, 0, int(bounds[1]), part)
            if len(bounds) > 2:
                yield from leave(line, False, part)
                # lines that begin and end inside the batch need no state
                counts = np.add.reduceat(fresh.astype(np.int64), bounds[:-1])
                counts[[0, -1]] = 0
                gone = np.flatnonzero(np.repeat(counts >= most, np.diff(bounds)) & fresh)
                if len(gone):
                    yield from _rows(DROP, [batch.take(pa.array(gone))], part)
                line = _Line(batch.slice(int(bounds[-2]), 1), False)
                yield from add(line, batch, fresh, int(bounds[-2]), len(key), part)
        if line is not None:
            yield from leave(line, True, part)

    return run


def _dropped(docs: DataFrame, documents: int, least: int) -> DataFrame:
    """(doc_id, text_hash, at): the places of lines that go, four bytes each; a place may come more than once."""
    ensure_checkpoint_dir(docs.sparkSession)
    rows = docs.mapInArrow(_lines(least), LINES).checkpoint()
    dealt = rows.withColumn("part", F.spark_partition_id()).repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
    seen = dealt.withColumn("task", F.spark_partition_id()).mapInArrow(_seen(documents), SEEN).checkpoint()
    # two edges a partition at most: the last document before a cut and the first one after it may be the same
    same = "lag(struct(last_id, last_hash)) OVER (PARTITION BY key, size ORDER BY part) <=> struct(doc_id, text_hash)"
    edges = seen.where(f"kind = {EDGE}").selectExpr("key", "size", f"n - CAST({same} AS INT) AS n")
    many = edges.groupBy("key", "size").agg(F.sum("n").alias("n")).where(F.col("n") >= documents).select("key", "size")
    settled = seen.where(f"kind = {OPEN}").join(many, ["key", "size"], "left_semi")
    places = ["doc_id", "text_hash", "at"]
    return seen.where(f"kind = {DROP}").select(*places).unionByName(settled.select(*places))


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n_lines = batch.column("n_lines").to_pylist()
        dropped, keep = [], []
        for n, places in zip(n_lines, batch.column("places").to_pylist()):
            bits = np.ones(n, bool)
            for p in places or ():
                bits[np.frombuffer(p, "<u4")] = False
            dropped.append(n - int(bits.sum()))
            keep.append(zlib.compress(np.packbits(bits).tobytes()))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), batch.column("n_lines"),
                                          pa.array(dropped, pa.int64()), pa.array(keep, pa.binary())],
                                         names=["doc_id", "text_hash", "n_lines", "n_dropped", "keep"])


def _known(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn(
        "text_hash", F.xxhash64("text"))


def bitmaps(docs: DataFrame, documents: int = DOCUMENTS, least: int = LEAST, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text_hash, n_lines, n_dropped, keep) of every document: which of its lines stay, as zlib-compressed bits in the
    order of the lines, the first line in the highest bit of the first byte.

    A line goes if its key, the line without white space at its ends and with A-Z lower-cased, has ``least`` code points
    or more and is in ``documents`` documents or more. A null or empty text is one empty line, which stays. Equal rows
    are one document and one row here. An empty table gives no row. Other columns are not read. A text of any length is read
    whole, alone in its chunk; a line that it repeats is one row with all its places.
    """
    docs = _known(docs, doc_id, text)
    places = _dropped(docs, documents, least).groupBy("doc_id", "text_hash").agg(F.collect_list("at").alias("places"))
    n_lines = F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit(""))) + 1
    every = docs.select("doc_id", "text_hash", n_lines.cast("long").alias("n_lines")).distinct()
    return _beside(every, places).mapInArrow(_bitmaps, "doc_id long, text_hash long, n_lines long, n_dropped long, keep binary")


def _beside(left: DataFrame, right: DataFrame) -> DataFrame:
    """``left`` with the columns of the document's row in ``right``, nulls if it has none."""
    r = right.withColumnsRenamed({"doc_id": "_id", "text_hash": "_hash"})
    return left.join(r, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")), "left").drop("_id", "_hash")


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text")
        less = pc.greater(batch.column("n_dropped"), 0)
        done = []
        for text, n, keep in zip(*(batch.column(c).filter(less).to_pylist() for c in ("text", "n_lines", "keep"))):
            bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), count=n)
            done.append("\n".join(line for line, bit in zip(text.split("\n"), bits.tolist()) if bit))
        texts = pc.replace_with_mask(texts, less, pa.array(done, texts.type))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), texts, batch.column("n_lines"), batch.column("n_dropped")],
                                         names=["doc_id", "text", "n_lines", "n_dropped"])


def apply(docs: DataFrame, made: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text, n_lines, n_dropped) of every row of ``docs``: the lines that its bitmap in ``made`` keeps, joined by \\n.
    A null text comes out empty. Other columns are not carried."""
    return _beside(_known(docs, doc_id, text), made).mapInArrow(_kept, "doc_id long, text string, n_lines long, n_dropped long")
