"""Ranked lexical search by pipelined term partitioning: bundles of items pass the owners of the terms, stage after stage.

The documents are indexed in blocks: a block is a run of documents in one task, and its row holds the postings of all query
terms in them. The terms are dealt to successive owners, rare ones first, each with an equal share of the postings. A
bundle is all items of a round together with one block, and carries the block's document scores of each item as sparse
accumulators. In each stage the bundles are cogrouped by block with what the stage's owner holds, which adds its terms'
integer contributions. The last stage selects every bundle's best documents, a window over these each item's.

Between two stages a bundle leaves behind documents that cannot be selected any more: every contribution is under weight
x 10^6, so a document whose score falls short of the block's k-th one by more than the weights to come times 10^6 ends
behind k others of its own block. All integers are exact; nothing else is left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txnwatch.llm import text as T
from txnwatch.session import ensure_checkpoint_dir

#: Documents of a block (their numbers in it take 16 bits), items of a round, owners of the terms.
BLOCK, ITEMS, OWNERS = 4096, 512, 4
#: Up to so many query terms, the index holds only theirs; with more it holds all terms, to the same result.
KNOWN = 1 << 20
#: Contributions are under the term's weight times this.
SCALE = 1_000_000
#: Terms are dealt to owners by steps of df, so many to a doubling.
LEVELS = 8

#: Bytes between terms: the ASCII characters that are neither digits nor letters.
APART = np.zeros(256, bool)
APART[:128] = True
APART[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = False

INDEX = ("block long, n_docs long, n_terms long, ids array<long>, lengths binary, terms array<long>, counts array<int>, "
         "docs binary, tfs binary")
BUNDLE = "block long, ends binary, docs binary, scores binary"


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(item_id, term) of items, a term once a row."""
    for batch in batches:
        for chunk in T.chunks(batch, "text"):
            hashes, row = T.words(chunk.column("text"), True, APART)
            order = np.lexsort((hashes, row))
            h, r = hashes[order], row[order]
            new = np.r_[np.ones(min(1, len(h)), bool), (h[1:] != h[:-1]) | (r[1:] != r[:-1])]
            yield pa.RecordBatch.from_arrays([chunk.column("item_id").take(pa.array(r[new])), pa.array(h[new].view(np.int64))], names=["item_id", "term"])


def _index(known: np.ndarray | None, size: int):
    """A row for each block: its documents' ids and lengths, and the postings of the known terms, by term and document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = 0
        for batch in batches:
            for at in range(0, batch.num_rows, size):
                block = batch.slice(at, size)
                lengths, terms, docs, base = [], [], [], 0
                for chunk in T.chunks(block, "text"):
                    hashes, row = T.words(chunk.column("text"), True, APART)
                    lengths.append(np.bincount(row, minlength=chunk.num_rows))
                    if known is not None and len(hashes):
                        held = known[np.minimum(np.searchsorted(known, hashes), len(known) - 1)] == hashes if len(known) else np.zeros(len(hashes), bool)
                        hashes, row = hashes[held], row[held]
                    terms.append(hashes)
                    docs.append(row + base)
                    base += chunk.num_rows
                length, term, doc = np.concatenate(lengths), np.concatenate(terms), np.concatenate(docs)
                order = np.lexsort((doc, term))
                term, doc = term[order], doc[order]
                fresh = np.r_[np.ones(min(1, len(term)), bool), term[1:] != term[:-1]]
                new = np.flatnonzero(fresh | np.r_[np.zeros(min(1, len(doc)), bool), doc[1:] != doc[:-1]])
                tfs = np.diff(np.r_[new, len(doc)])
                term, doc = term[new], doc[new]
                starts = np.flatnonzero(np.r_[np.ones(min(1, len(term)), bool), term[1:] != term[:-1]])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([(block.column("task")[0].as_py() << 32) + made]), pa.array([int((length > 0).sum())]), pa.array([int(length.sum())]),
                     pa.array([block.column("doc_id")], pa.list_(pa.int64())), pa.array([length.astype("<i4").tobytes()], pa.binary()),
                     pa.array([term[starts].view(np.int64)], pa.list_(pa.int64())), pa.array([np.diff(np.r_[starts, len(term)]).astype(np.int32)], pa.list_(pa.int32())),
                     pa.array([doc.astype("<u2").tobytes()], pa.binary()), pa.array([tfs.astype("<i4").tobytes()], pa.binary())],
                    names=[x.split()[0] for x in INDEX.split(", ")])
                made += 1

    return run


def _owned(terms: np.ndarray):
    """The index's rows with the postings of these terms (sorted) alone."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                have, counts = (row.column(c).flatten().to_numpy() for c in ("terms", "counts"))
                mine = np.isin(have, terms)
                wide = np.repeat(mine, counts)
                docs, tfs = np.frombuffer(row.column("docs")[0].as_py(), "<u2"), np.frombuffer(row.column("tfs")[0].as_py(), "<i4")
                yield pa.RecordBatch.from_arrays(
                    [*(row.column(c) for c in ("block", "n_docs", "n_terms", "ids", "lengths")), pa.array([have[mine]], pa.list_(pa.int64())),
                     pa.array([counts[mine]], pa.list_(pa.int32())), pa.array([docs[wide].tobytes()], pa.binary()), pa.array([tfs[wide].tobytes()], pa.binary())],
                    names=batch.schema.names)

    return run


def contributions(weight: np.ndarray, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a term adds to a document's score; all 64-bit integers."""
    return weight * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))


def _stage(items: list[tuple], n_docs: int, n_terms: int, k: int, last: bool):
    """The step of one owner. items: for each item its id, the owner's terms of it with their weights, and the weights to come."""
    def run(bundles: pa.Table, owned: pa.Table) -> pa.Table:
        own, bundle = owned.slice(0, 1).to_pylist()[0], bundles.slice(0, 1).to_pylist()[0]
        length = np.frombuffer(own["lengths"], "<i4").astype(np.int64)
        doc, tf = np.frombuffer(own["docs"], "<u2"), np.frombuffer(own["tfs"], "<i4").astype(np.int64)
        ends, carried, had = np.frombuffer(bundle["ends"], "<i4"), np.frombuffer(bundle["docs"], "<u2"), np.frombuffer(bundle["scores"], "<i8")
        add = contributions(1, tf, (50 + (50 * length * n_docs) // n_terms)[doc])
        ends_at = np.cumsum(own["counts"]) if own["counts"] else np.zeros(0, np.int64)
        place = {t: (int(z) - c, int(z)) for t, c, z in zip(own["terms"], own["counts"], ends_at)}
        kept, begin, out = [], 0, []
        for i, (item, terms, rest) in enumerate(items):
            score = np.zeros(len(length), np.int64)
            if len(ends):
                score[carried[begin:ends[i]]] = had[begin:ends[i]]
                begin = ends[i]
            for t, w in terms:
                if t in place:
                    a, z = place[t]
                    score[doc[a:z]] += w * add[a:z]
            held = np.flatnonzero(score)
            if len(held) > k:
                least = np.partition(score[held], len(held) - k)[len(held) - k]
                held = held[score[held] + (0 if last else rest * SCALE) >= least]
            if not last:
                kept.append((held, score[held]))
            elif len(held):
                ids = np.array([own["ids"][d] or 0 for d in held], np.int64)
                known = np.array([own["ids"][d] is not None for d in held])
                best = np.lexsort((ids, known, -score[held]))[:k]
                out.append(pa.table([pa.array([item] * len(best), pa.int64()), pa.array(ids[best], mask=~known[best]), pa.array(score[held][best])],
                                    names=["item_id", "doc_id", "score"]))
        if last:
            return pa.concat_tables(out) if out else pa.table({"item_id": pa.array([], pa.int64()), "doc_id": pa.array([], pa.int64()), "score": pa.array([], pa.int64())})
        docs, scores = (np.concatenate([x[j] for x in kept]) for j in (0, 1))
        return pa.table([pa.array([own["block"]], pa.int64()), pa.array([np.cumsum([len(x[0]) for x in kept]).astype("<i4").tobytes()], pa.binary()),
                         pa.array([docs.astype("<u2").tobytes()], pa.binary()), pa.array([scores.astype("<i8").tobytes()], pa.binary())],
                        names=["block", "ends", "docs", "scores"])

    return run


def _owners(found: DataFrame, owners: int) -> DataFrame:
    """(term, df, owner): terms by df, each owner with about the same share of the postings. At most LEVELS x 64 rows come to
    the driver."""
    found = found.withColumn("level", F.floor(F.log2("df") * LEVELS).cast("int"))
    shares = [(r.level, r.n) for r in found.groupBy("level").agg(F.sum("df").alias("n")).orderBy("level").collect()]
    total, seen, cuts = sum(n for _, n in shares), 0, []
    for level, n in shares:
        while len(cuts) < owners - 1 and seen + n > total * (len(cuts) + 1) / owners and seen:
            cuts.append(level)
        seen += n
    owner = sum((F.when(F.col("level") >= c, 1).otherwise(0) for c in cuts), F.lit(0))
    return found.select("term", "df", owner.alias("owner"))


def _round(index: DataFrame, asked: list, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """(item_id, doc_id, score): each block's best documents for the items of a round (item_id, term, weight, owner)."""
    by: dict = {}
    for r in asked:
        by.setdefault(r.item_id, []).append((r.owner, r.term, r.weight))
    owners = sorted({r.owner for r in asked})
    bundles = index.select("block", *[F.lit(b"").alias(c) for c in ("ends", "docs", "scores")])
    for owner in owners:
        items = [(item, [(t, w) for o, t, w in terms if o == owner], sum(w for o, _, w in terms if o > owner)) for item, terms in by.items()]
        mine = np.array(sorted({r.term for r in asked if r.owner == owner}), np.int64)
        last = owner == owners[-1]
        step = _stage(items, n_docs, n_terms, k, last)
        bundles = bundles.groupBy("block").cogroup(index.mapInArrow(_owned(mine), INDEX).groupBy("block")).applyInArrow(
            step, "item_id long, doc_id long, score long" if last else BUNDLE)
    return bundles


def search(docs: DataFrame, items: DataFrame, k: int = 50, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
           item_text: str = "text", owners: int = OWNERS, block: int = BLOCK) -> DataFrame:
    """(item_id, rank, doc_id, score): for each item its ``k`` documents of the highest scores above 0, equal scores by doc_id.

    Terms are runs of characters other than ASCII signs and controls, A-Z lower-cased; a term counts once an item. Rows of
    ``items`` with the same id are one item. Every row of ``docs`` is a document: rows that share an id are ranked each;
    an id that is null comes before others of the same score. Null and empty texts have no term: such a document is
    never found and does not count, such an item gives no row, and so does any item where no document holds a term. Empty
    tables give no row. Other columns are not read. Texts of any length are read whole, one alone in its chunk.

    Of the items, the driver holds the terms of one round (about ITEMS items) at a time; of the documents, nothing.
    """
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    asked = items.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).alias("text")).mapInArrow(
        _terms, "item_id long, term long").distinct().checkpoint()
    some = asked.select("term").distinct().limit(KNOWN + 1).toArrow().column("term").to_numpy()
    known = np.sort(some.view(np.uint64)) if len(some) <= KNOWN else None
    index = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), F.spark_partition_id().alias("task")).mapInArrow(
        _index(known, block), INDEX).checkpoint()
    total = index.agg(F.sum("n_docs").alias("n_docs"), F.sum("n_terms").alias("n_terms")).first()
    n_docs, n_terms = total.n_docs or 0, total.n_terms or 0
    found = index.select(F.explode(F.arrays_zip("terms", "counts")).alias("t")).groupBy(F.col("t.terms").alias("term")).agg(
        F.sum("t.counts").alias("df")).join(asked.select("term").distinct(), "term")
    weight = F.expr(f"floor(1000 * ln((2 * {n_docs}D + 2) / (2 * df + 1)))").cast("long")
    of = asked.join(_owners(found, owners), "term").select("item_id", "term", weight.alias("weight"), "owner").checkpoint()
    rounds = max(1, -(-of.select("item_id").distinct().count() // ITEMS))
    best = None
    for r in range(rounds):
        mine = of.where(F.pmod(F.xxhash64("item_id"), F.lit(rounds)) == r).collect()
        if mine:
            made = _round(index, mine, n_docs, n_terms, k)
            best = made if best is None else best.unionByName(made)
    if best is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    rank = F.row_number().over(Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
