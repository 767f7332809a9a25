"""Which filter removes what, for every order of the filters: wide packed counters.

Every document becomes a mask, one bit for each filter that it fails. With five filters there are 120 orders of five steps;
what happens to a document at each of the 600 steps follows from its mask alone. So every (mask, quality, toxic) maps
to one big integer whose 64-bit fields hold its outcomes at all steps, tasks add up the integers of their
documents by part, and the parts' sums are added and unpacked. A field counts documents, of which there are
fewer than 2^63, so no field runs into the next one.

A text that a smaller id holds too is found by digests (SHA-256): documents are first counted by (digest, part, mask, labels),
which folds any number of copies into a few rows, and of those groups only the ones with the digest's smallest id hold
a document without a smaller copy.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnwatch.llm import text as T

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in itertools.permutations(FILTERS)]
#: What a step counts, in the order of its fields.
OUTCOMES = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]
BITS = 64
#: The thresholds of filters A to C: words, distinct words in 100, capitals in 100 code points; and the signs of filter D.
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS, SIGNS = 100, 80, 10, b"#$%&*|"
#: Partial sums of a part that meet in one task before the last one.
FAN = 32
COUNTS = "part string, count binary"


def outcomes(mask: int, good: bool, toxic: bool) -> list[int]:
    """The 600 x 6 outcomes of one document, in the order of ORDERS, steps and OUTCOMES."""
    out = []
    for order in ORDERS:
        here = True
        for name in order:
            bit = 1 << FILTERS.index(name)
            fails = bool(mask & bit)
            removed = here and fails
            redundant = fails and not here
            here = here and not fails
            out += [here, removed, redundant, mask == bit, removed and good, removed and toxic]
    return [int(x) for x in out]


def packed(counts: list[int]) -> int:
    """One integer whose fields are the counts, the first one lowest."""
    return int.from_bytes(np.array(counts, "<u8").tobytes(), "little")


def unpacked(total: int) -> list[int]:
    return np.frombuffer(total.to_bytes(len(ORDERS) * len(FILTERS) * len(OUTCOMES) * BITS // 8, "little"), "<u8").tolist()


def _masks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bits of filters A to D."""
    sign, capital = np.zeros(256, bool), np.zeros(256, bool)
    sign[list(SIGNS)] = True
    capital[65:91] = True

    def each(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        sums = np.r_[0, np.cumsum(flags)]
        return sums[offsets[1:]] - sums[offsets[:-1]]

    for batch in batches:
        for chunk in T.chunks(batch, "text"):
            rows = chunk.num_rows
            words, row = T.words(chunk.column("text"), lower=False)
            n = np.bincount(row, minlength=rows)
            order = np.lexsort((words, row))
            w, r = words[order], row[order]
            first = np.r_[np.ones(min(1, len(w)), bool), (w[1:] != w[:-1]) | (r[1:] != r[:-1])]
            distinct = np.bincount(r[first], minlength=rows)
            raw, offsets = T.raw_bytes(chunk.column("text"))
            points, capitals = each((raw & 0xC0) != 0x80, offsets), each(capital[raw], offsets)
            fails = [n < LEAST_WORDS, 100 * distinct < LEAST_DISTINCT * n, 100 * capitals > MOST_CAPITALS * points, each(sign[raw], offsets) > 0]
            mask = sum(f.astype(np.int32) << k for k, f in enumerate(fails))
            yield pa.RecordBatch.from_arrays([chunk.column("doc_id"), chunk.column("part"), chunk.column("digest"), pa.array(mask.astype(np.int32))],
                                             names=["doc_id", "part", "digest", "mask"])


def masks(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """(doc_id, part, digest, mask): the failed filters A to D as bits 0 to 3, and the text's SHA-256. Null texts are empty, null
    parts the empty string."""
    t = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(part), F.lit("")).alias("part"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return t.withColumn("digest", F.unhex(F.sha2(F.encode("text", "UTF-8"), 256))).mapInArrow(
        _masks, "doc_id long, part string, digest binary, mask int")


def cells(found: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, good, toxic, n): documents by their failed filters, E (bit 4) among them, and their labels."""
    said = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("label_id")).agg(
        F.expr("coalesce(bool_or(quality = 1), false) AS good"), F.expr("coalesce(bool_or(toxic = 1), false) AS toxic"))
    # rows without an id have no label; the second key deals them out by their texts
    none = F.lit(b"")
    alone = F.when(F.col("doc_id").isNull(), F.col("digest")).otherwise(none)
    d = found.withColumns({"id": F.coalesce("doc_id", F.lit(0)), "alone": alone}).join(
        said.withColumn("none", none), (F.col("id") == F.col("label_id")) & (F.col("alone") == F.col("none")), "left")
    d = d.withColumns({c: F.coalesce(c, F.lit(False)) for c in ("good", "toxic")})
    own = d.groupBy("digest", "part", "mask", "good", "toxic", "doc_id").agg(F.count("*").alias("n"))
    groups = own.groupBy("digest", "part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n"), F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))).alias("least"))
    least = "min(least.doc_id) OVER (PARTITION BY digest)"
    groups = groups.selectExpr("part", "mask", "good", "toxic", "n", "least", f"{least} AS first")
    clean = "CASE WHEN first IS NULL THEN n WHEN least.doc_id = first THEN least.n ELSE 0 END"
    return groups.selectExpr("part", "good", "toxic", f"explode(array(struct(mask AS mask, {clean} AS n), struct(mask + 16 AS mask, n - {clean} AS n))) AS c").where(
        "c.n > 0").selectExpr("part", "c.mask AS mask", "good", "toxic", "c.n AS n")


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One integer a part: the sum of the integers of the task's documents."""
    sums: dict[str, int] = {}
    known: dict[tuple, int] = {}
    for batch in batches:
        for part, *kind, n in zip(*(batch.column(c).to_pylist() for c in ("part", "mask", "good", "toxic", "n"))):
            kind = tuple(kind)
            if kind not in known:
                known[kind] = packed(outcomes(*kind))
            sums[part] = sums.get(part, 0) + n * known[kind]
    yield from _counts(sums)


def _counts(sums: dict[str, int]) -> Iterator[pa.RecordBatch]:
    for part, total in sums.items():
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.string()), pa.array([total.to_bytes((total.bit_length() + 7) // 8, "little")], pa.binary())], names=["part", "count"])


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[str, int] = {}
    for batch in batches:
        for part, count in zip(batch.column("part").to_pylist(), batch.column("count").to_pylist()):
            sums[part] = sums.get(part, 0) + int.from_bytes(count, "little")
    yield from _counts(sums)


def _steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The 600 rows of a part from its integer."""
    where = [(order, k) for order in ORDERS for k in range(len(FILTERS))]
    for batch in batches:
        for part, count in zip(batch.column("part").to_pylist(), batch.column("count").to_pylist()):
            fields = np.array(unpacked(int.from_bytes(count, "little")), np.int64).reshape(len(where), len(OUTCOMES))
            name = [order[k] for order, k in where]
            lost = {f: int(fields[[x == f for x in name], OUTCOMES.index("removed")].sum()) for f in FILTERS}
            columns = [pa.array([part] * len(where)), pa.array([order for order, _ in where]), pa.array([k + 1 for _, k in where], pa.int32()),
                       *(pa.array(fields[:, i]) for i in range(len(OUTCOMES))), pa.array([lost[f] for f in name], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "filter_order", "step", *OUTCOMES, "shapley"])


def audit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley): 600 rows a part.

    Filter A fails a text of under 100 words, B one whose distinct words are under 80 % of its words, C one whose capitals
    A-Z are over 10 % of its code points, D one with any of ``#$%&*|``, E one that a smaller doc_id holds too.
    A null or empty text fails A only, and E where it recurs. Rows that share id and text are counted each, and
    neither is the smaller one; a row without an id is smaller than none, and fails E if a row with an id holds its text.
    Rows of ``labels`` for one id count together; labels without a document, and values other than 1, count for
    nothing. A table without rows gives none. Other columns are not read. Texts of any length are measured whole.
    """
    sums = cells(masks(docs, doc_id, text, part), labels).mapInArrow(_summed, COUNTS)
    # a part has a row for each task: two levels of additions
    met = sums.repartition("part", F.pmod(F.spark_partition_id(), F.lit(FAN))).mapInArrow(_added, COUNTS)
    return met.repartition("part").mapInArrow(_added, COUNTS).mapInArrow(
        _steps, "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in [*OUTCOMES, "shapley"]))
