"""Exact n-gram Jaccard join by T-occurrence search, as connected components over whole document collections.

Documents with equal shingle sets are one class. Classes can only link if they share one of their rarest
``n - ceil(0.8 n) + 1`` shingles (prefix), so only prefixes are dealt out by shingle, and only shingles that two classes
have make inverted lists. Links are then found in two steps that together miss none:

1. Stars. Each list's first class is compared with the others of the list; the links' components are contracted. This
   takes one comparison a list member, and melts large groups of near copies into one component or a few.
2. Search. Lists whose classes still lie in different components are searched with DivideSkip: classes are dealt into
   blocks, each block holds inverted lists of its classes' prefixes, and every class queries the blocks it meets for
   classes of larger components that share at least the T prefix shingles that a link between sets of these sizes
   needs. Short lists are merged with a heap; long ones are only probed, by bisection, for what the merge has found.
   Of the classes found in a block the FEW best are compared first and their links contracted, as a large group of
   near copies may still be in many components, and a query would bring candidates of each. Then the search is made again,
   and the FEW best of each other component are compared; a query that links with none of them goes once to the
   component's blocks of whole sets, where all the others are compared.

Sets are compared whole. Shingles are 64-bit hashes (48 bits in the comparison), classes 64-bit hashes of their sets.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnwatch.llm import filters
from txnwatch.llm.components import connected
from txnwatch.llm.text import chunks, shingles, words
from txnwatch.session import ensure_checkpoint_dir

#: Words of a shingle and the similarity, in percent, from which two sets link.
SHINGLE, PERCENT = 5, 80
#: Shingles whose counts are known to all tasks; they only order the prefixes, any order gives the same links.
KNOWN = 1 << 19
#: Shingles that a task holds to see which come twice.
SEEN = 1 << 20
#: Members of a list that are compared by size; a longer list is left as it is.
COMPARED = 1 << 18
#: Places of a prefix whose order keys are kept, and the count from which shingles are equally frequent.
MARKS, FREQUENT = 8, (1 << 15) - 1
#: Classes in a block, candidates compared first, length from which a list is probed.
BLOCK, FEW, LONG = 1024, 8, 24


def prefix_length(n: np.ndarray | int) -> np.ndarray | int:
    """Of two linked sets, each has a shared shingle among its first so many in any common order."""
    return n - (n * PERCENT + 99) // 100 + 1


def needed(n: int, m: int) -> int:
    """Shared shingles that sets of n and m need: 100 i >= PERCENT (n + m - i)."""
    return -(-PERCENT * (n + m) // (100 + PERCENT))


def _sets(batch: pa.RecordBatch, text_col: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, distinct shingles sorted by row and value, their rows, set sizes, class of each row) for runs of rows."""
    for part in chunks(batch, text_col):
        value, row = shingles(*words(part.column(part.schema.get_field_index(text_col)), lower=True), SHINGLE)
        order = np.lexsort((value, row))
        value, row = value[order], row[order]
        if len(value):
            new = np.r_[True, (value[1:] != value[:-1]) | (row[1:] != row[:-1])]
            value, row = value[new], row[new]
        n = np.bincount(row, minlength=part.num_rows)
        cls = np.zeros(part.num_rows, np.uint64)
        if len(value):
            # two sums of differently mixed hashes: equal for equal sets, whatever the order
            starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
            a = np.add.reduceat(value * np.uint64(0xD6E8FEB86659FD93), starts)
            b = np.bitwise_xor.reduceat((value ^ (value >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F), starts)
            mixed = (a ^ (b >> np.uint64(32)) ^ (b << np.uint64(32))) * np.uint64(0xE7037ED1A0B428DB)
            cls[row[starts]] = mixed ^ (mixed >> np.uint64(32))
        yield part, value, row, n, cls


def _map(df: DataFrame, schema: str, f) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from f(batch)

    return df.mapInArrow(run, schema)


def _batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _known(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(shingles, counts), sorted by shingle: the at most KNOWN most frequent of those that some task saw twice."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def told() -> pa.RecordBatch:
            value, count = np.unique(np.concatenate(held or [np.empty(0, np.uint64)]), return_counts=True)
            held.clear()
            return _batch(s=_signed(value[count > 1]), n=pa.array(count[count > 1]))

        for batch in batches:
            for _, value, _, _, _ in _sets(batch, "t"):
                held.append(value)
                if sum(map(len, held)) > SEEN:
                    yield told()
        yield told()

    counted = docs.mapInArrow(run, "s bigint, n bigint").groupBy("s").agg(F.sum("n").alias("n")).checkpoint()
    sizes = counted.groupBy(F.least("n", F.lit(1 << 16)).alias("n")).count().orderBy(F.desc("n")).collect()
    total, least = 0, 1 << 62
    for r in sizes:
        total += r["count"]
        if total > KNOWN:
            break
        least = r["n"]
    rows = counted.where(F.col("n") >= least).toPandas()
    value = rows["s"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(value)
    return value[order], rows["n"].to_numpy(np.int64)[order]


def _order_keys(value: np.ndarray, known: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The place of shingles in the common order: by known count, then by hash (48 bits of it; equal keys may come in any
    order)."""
    frequent, counts = known
    times = np.zeros(len(value), np.uint64)
    if len(frequent) and len(value):
        at = np.minimum(np.searchsorted(frequent, value), len(frequent) - 1)
        times = np.where(frequent[at] == value, np.minimum(counts[at], FREQUENT), 0).astype(np.uint64)
    return times << np.uint64(48) | value >> np.uint64(16)


def marks(keys: list[int], n: int) -> list[int]:
    """Of the sorted order keys of a set of n, those at MARKS places spread over its prefix, the last one included."""
    return [keys[i] for i in mark_places(n)]


def mark_places(n: int) -> list[int]:
    p = int(prefix_length(n))
    return [(k + 1) * p // MARKS - 1 if p >= MARKS else min(k, p - 1) for k in range(MARKS)]


def beyond(n: int, x: list[int], m: int, y: list[int]) -> int:
    """At most so many shared shingles of sets of n and m with marks x and y are not in both prefixes. Let x's prefix end
    first: what is shared up to its end is in both prefixes, the rest is among the shingles of either set after that end,
    n minus its prefix of the one, and of the other all but those known to lie before the end."""
    if x[-1] > y[-1]:
        n, x, m, y = m, y, n, x
    before = 0
    for key, place in zip(y, mark_places(m), strict=True):
        if key < x[-1]:
            before = place + 1
    return min(n - int(prefix_length(n)), m - before)


def _prefixes(docs: DataFrame, known) -> DataFrame:
    """(s, c, n): the prefix shingles s of class c with n shingles; a class is repeated for its documents of other batches.
    ``known``: the broadcast result of ``_known``, at most KNOWN pairs of numbers."""
    def one(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        told: set[int] = set()
        for part, value, row, n, cls in _sets(batch, "t"):
            first = np.array([not (c in told or told.add(c)) for c in cls.tolist()], bool)
            mine = first[row]
            value, row = value[mine], row[mine]
            if not len(value):
                continue
            order = np.lexsort((value, _order_keys(value, known.value), row))
            value, row = value[order], row[order]
            place = np.arange(len(row)) - np.searchsorted(row, row)
            head = place < prefix_length(n)[row]
            yield _batch(s=_signed(value[head]), c=_signed(cls[row[head]]), n=pa.array(n[row[head]].astype(np.int32)))

    return _map(docs, "s bigint, c bigint, n int", one)


def _lists(prefixes: DataFrame) -> DataFrame:
    """(s, c, n): members c of the lists with two classes or more.

    Rows are dealt out and sorted by shingle and read as a stream. A shingle's share of the rows is at most one over the
    length of the shortest prefix that has it, so a third of all documents being near copies does not make a hot key.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, told = None, True  # the row before, and whether it has been told
        for batch in batches:
            s, c, n = (batch.column(i).to_numpy() for i in range(3))
            if not len(s):
                continue
            keep = np.r_[last is None or (s[0], c[0]) != last[:2], (s[1:] != s[:-1]) | (c[1:] != c[:-1])]
            s, c, n = s[keep], c[keep], n[keep]
            if not len(s):
                continue
            before = np.r_[last is not None and last[0] == s[0], s[1:] == s[:-1]]
            member = before | np.r_[before[1:], False]
            out = [x[member] for x in (s, c, n)]
            if before[0] and not told:
                out = [np.r_[y, x] for x, y in zip(out, last, strict=True)]
            last, told = (s[-1], c[-1], n[-1]), bool(member[-1])
            yield _batch(s=pa.array(out[0].astype(np.int64)), c=pa.array(out[1].astype(np.int64)), n=pa.array(out[2].astype(np.int32)))

    return prefixes.repartition("s").sortWithinPartitions("s", "n", "c").mapInArrow(run, "s bigint, c bigint, n int")


def _may_link(n: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Which members of one list, of n shingles and in ``own`` lists each, have another member there that they may link with:
    both must be in as many lists as a link of their sizes needs shared prefix shingles. Members of one size are
    told by their largest two counts."""
    sizes, at, times = np.unique(n, return_inverse=True, return_counts=True)
    most = np.zeros(len(sizes), np.int64)
    np.maximum.at(most, at, own)
    x, y = sizes[:, None].astype(np.int64), sizes[None, :].astype(np.int64)
    need = -(-PERCENT * (x + y) // (100 + PERCENT))
    least = np.maximum(1, need - np.maximum(x - prefix_length(x), y - prefix_length(y)))
    fits = (need <= np.minimum(x, y)) & (most[None, :] >= least)
    alone = (times == 1) & np.eye(len(sizes), dtype=bool)
    least = np.where(fits & ~alone, least, 1 << 40)
    return own >= least.min(axis=1)[at]


def _pruned(lists: DataFrame) -> DataFrame:
    """(s, c, n, p, m): the lists without members that can link with no other member, each with the list's first class p of m
    shingles. Two linked classes share as many prefix shingles as their sizes need, so each is in so many lists, and both
    stay in all of these; what goes are accidental meetings, which grow faster than the collection."""
    def tell(s: np.ndarray, c: np.ndarray, n: np.ndarray, own: np.ndarray) -> pa.RecordBatch:
        """Whole lists: pairs at once, longer ones one by one."""
        heads = np.flatnonzero(np.r_[True, s[1:] != s[:-1]])
        size = np.diff(np.r_[heads, len(s)])
        keep = np.zeros(len(s), bool)
        two = heads[size == 2]
        x, y = n[two].astype(np.int64), n[two + 1].astype(np.int64)
        need = -(-PERCENT * (x + y) // (100 + PERCENT))
        least = np.maximum(1, need - np.maximum(x - prefix_length(x), y - prefix_length(y)))
        good = two[(need <= x) & (np.minimum(own[two], own[two + 1]) >= least)]
        keep[good] = keep[good + 1] = True
        for a, k in zip(heads[size > 2].tolist(), size[size > 2].tolist()):
            keep[a:a + k] = _may_link(n[a:a + k], own[a:a + k])
        s, c, n = s[keep], c[keep], n[keep]
        first = np.flatnonzero(np.r_[np.ones(min(1, len(s)), bool), s[1:] != s[:-1]])
        at = np.repeat(first, np.diff(np.r_[first, len(s)]))
        return _batch(s=pa.array(s), c=pa.array(c), n=pa.array(n), p=pa.array(c[at]), m=pa.array(n[at]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, long = None, None  # rows of the list that may go on; the first member of one too long to compare
        for batch in batches:
            rows = [batch.column(i).to_numpy() for i in range(4)]
            if held is not None:
                rows = [np.r_[x, y] for x, y in zip(held, rows)]
            if not len(rows[0]):
                continue
            cut = int(np.searchsorted(rows[0], rows[0][-1]))
            if long is not None:
                end = int(np.searchsorted(rows[0], long[0], side="right"))
                yield _batch(s=pa.array(rows[0][:end]), c=pa.array(rows[1][:end]), n=pa.array(rows[2][:end]),
                             p=pa.array(np.full(end, long[1])), m=pa.array(np.full(end, long[2], np.int32)))
                if end == len(rows[0]):
                    held = None
                    continue
                rows, cut, long = [x[end:] for x in rows], cut - end, None
            if cut:
                yield tell(*(x[:cut] for x in rows))
            held = [x[cut:] for x in rows]
            if len(held[0]) > COMPARED:
                long = (held[0][0], held[1][0], held[2][0])
                yield _batch(s=pa.array(held[0]), c=pa.array(held[1]), n=pa.array(held[2]),
                             p=pa.array(np.full(len(held[0]), long[1])), m=pa.array(np.full(len(held[0]), long[2], np.int32)))
                held = None
        if held is not None and len(held[0]):
            yield tell(*held)

    own = lists.groupBy("c").agg(F.count("*").alias("own"))
    return lists.join(own, "c").select("s", "c", "n", "own").repartition("s").sortWithinPartitions("s", "n", "c").mapInArrow(
        run, "s bigint, c bigint, n int, p bigint, m int")


def _whole_sets(docs: DataFrame, lists: DataFrame, known) -> DataFrame:
    """(c, v, q): the sets, 6 bytes a shingle, and the prefix marks of the classes in lists; a class is repeated for its
    documents of other batches."""
    meets = docs.sparkSession.sparkContext.broadcast(filters.gather(lists.select("c")))  # of fixed size

    def one(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        told: set[int] = set()
        for _, value, row, n, cls in _sets(batch, "t"):
            hit = filters.may_hold(meets.value, cls) & (n > 0)
            ends = np.cumsum(n)
            rows = [i for i in np.flatnonzero(hit).tolist() if not (int(cls[i]) in told or told.add(int(cls[i])))]
            sets = [value[ends[i] - n[i]:ends[i]] for i in rows]
            packed = [x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes() for x in sets]
            places = [marks(np.sort(_order_keys(x, known.value)), len(x)) for x in sets]
            yield _batch(c=_signed(cls[rows]), v=pa.array(packed, pa.binary()),
                         q=pa.array([[int(k) for k in m] for m in places], pa.list_(pa.int64())))

    return _map(docs, "c bigint, v binary, q array<bigint>", one)


def _unpack(v: bytes) -> np.ndarray:
    out = np.zeros((len(v) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(v, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def _joint(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether two sets link."""
    both = np.concatenate([x, y])
    both.sort()
    return int((both[1:] == both[:-1]).sum()) >= needed(len(x), len(y))


def _linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of classes whose whole sets link. Only the sets of these classes are dealt out."""
    pairs = pairs.checkpoint()
    sets = _only(sets.select("c", "v"), "c bigint, v binary", pairs.select("a").unionByName(pairs.select(F.col("b").alias("a"))))
    sets = sets.groupBy("c").agg(F.first("v").alias("v"))
    both = pairs.join(sets.select(F.col("c").alias("a"), F.col("v").alias("va")), "a").join(
        sets.select(F.col("c").alias("b"), F.col("v").alias("vb")), "b").select("a", "b", "va", "vb")

    def one(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            good = []
            for x, y in zip(part.column(2), part.column(3), strict=True):
                good.append(_joint(_unpack(x.as_buffer()), _unpack(y.as_buffer())))
            yield part.select([0, 1]).filter(pa.array(good, pa.bool_()))

    return _map(both, "a bigint, b bigint", one)


class Block:
    """Inverted lists over the prefixes of a block's classes, by size class."""

    def __init__(self):
        self.sizes: dict[int, dict] = {}

    def add(self, c: int, n: int, key: tuple, tokens: list[int], q: list[int]) -> None:
        entry = self.sizes.setdefault(n.bit_length() * 8 + (n * 8 >> n.bit_length()), {"lists": {}, "rows": []})
        at = len(entry["rows"])
        entry["rows"].append((c, n, key, q))
        for t in tokens:
            entry["lists"].setdefault(t, []).append(at)

    def search(self, n: int, key: tuple, tokens: list[int], q: list[int]) -> Iterator[tuple[int, tuple, int]]:
        """(class, component key, shared prefix shingles) of the classes of larger keys that may link: T-occurrence
        search per size class."""
        for entry in self.sizes.values():
            rows = entry["rows"]
            lows = [m for _, m, k, _ in rows if k > key and needed(n, m) <= min(n, m)]
            if not lows:
                continue
            lists = sorted((entry["lists"][t] for t in tokens if t in entry["lists"]), key=len)
            least = min(shared_prefix(n, m) for m in set(lows))
            if len(lists) < least:
                continue
            longs = 0
            while longs < least - 1 and len(lists[-1 - longs]) > LONG:
                longs += 1
            short, long = lists[:len(lists) - longs], lists[len(lists) - longs:]
            count, previous = 0, -1
            for at in [*heapq.merge(*short), -1]:
                if at == previous:
                    count += 1
                    continue
                if previous >= 0 and count >= least - longs:
                    c, m, k, marked = rows[previous]
                    if k > key and needed(n, m) <= min(n, m):
                        for probe in long:
                            i = bisect_left(probe, previous)
                            count += i < len(probe) and probe[i] == previous
                        if count >= max(1, needed(n, m) - beyond(n, q, m, marked)):
                            yield c, k, count
                previous, count = at, 1


def shared_prefix(n: int, m: int) -> int:
    """Shared prefix shingles that a link between sets of n and m needs at least, whatever their marks (``beyond`` is at
    most the larger rest)."""
    return max(1, needed(n, m) - max(n - prefix_length(n), m - prefix_length(m)))


def _heads(lists: DataFrame, sets: DataFrame) -> DataFrame:
    """(c, n, tokens, q): the classes in lists with their prefix shingles there and their marks. All prefix shingles that
    two classes share are among these."""
    heads = lists.groupBy("c", "n").agg(F.sort_array(F.collect_list("s")).alias("tokens"))
    return heads.join(sets.groupBy("c").agg(F.first("q").alias("q")), "c")


def _stars(lists: DataFrame, heads: DataFrame) -> DataFrame:
    """(a, b): the lists' members with their lists' first classes, where sizes and shared prefix shingles allow a link."""
    pairs = lists.where("c <> p AND 100 * least(n, m) >= 80 * greatest(n, m)").select(
        F.least("c", "p").alias("a"), F.greatest("c", "p").alias("b")).distinct()
    side = lambda x: heads.select(*[F.col(c).alias(f"{c}{x}") for c in ("c", "n", "tokens", "q")]).withColumnRenamed(f"c{x}", x)
    both = pairs.join(side("a"), "a").join(side("b"), "b").select(
        "a", "b", "na", "qa", "nb", "qb", F.size(F.array_intersect("tokensa", "tokensb")).alias("common"))

    def one(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        good = [common >= needed(n, m) - beyond(n, x, m, y)
                for n, x, m, y, common in zip(*(batch.column(i).to_pylist() for i in range(2, 7)), strict=True)]
        yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))

    return _map(both, "a bigint, b bigint", one)


def _named(heads: DataFrame, labels: DataFrame) -> DataFrame:
    """``heads`` with the component (label) and its number of classes (members) so far; a class without a link is alone."""
    sizes = labels.groupBy("label").agg(F.count("*").alias("members"))
    found = labels.join(sizes, "label").select(F.col("node").alias("c"), "label", "members")
    return heads.join(found, "c", "left").withColumn("label", F.coalesce("label", "c")).withColumn(
        "members", F.coalesce("members", F.lit(1)))


def _only(df: DataFrame, schema: str, keys: DataFrame) -> DataFrame:
    """The rows of ``df`` (c, ...) whose class is in the only column of ``keys`` (a filter of fixed size lets some others
    pass), so that the others are not dealt out."""
    meets = df.sparkSession.sparkContext.broadcast(filters.gather(keys))  # of fixed size

    def some(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        yield batch.filter(pa.array(filters.may_hold(meets.value, batch.column(0).to_numpy().view(np.uint64))))

    return _map(df, schema, some)


def _candidates(heads: DataFrame, labels: DataFrame, apart: bool = True) -> DataFrame:
    """(a, b, more): queries a with the FEW best classes b of each other component that they may link with; ``more`` where
    there were others. Not ``apart``: the FEW best of a block, whatever their components."""
    light = _named(heads.select("c", F.get("tokens", F.lit(0)).alias("rarest")), labels)
    light = light.withColumn("home", F.when(F.col("members") >= BLOCK, F.col("label")).otherwise(F.col("rarest")))
    crowd = light.groupBy("home").agg(F.ceil(F.count("*") / BLOCK).alias("shares"))
    light = light.join(crowd, "home").select("c", "label", "members", F.xxhash64("home", F.pmod("c", "shares")).alias("block"))
    classes = heads.join(light, "c").checkpoint()
    rows = classes.select(F.explode("tokens").alias("s"), "c", "block", F.struct("members", "label").alias("own"))
    targets = rows.groupBy("s", "block").agg(F.max("own").alias("most"))
    asks = rows.drop("block").join(targets, "s").where(F.col("most") > F.col("own")).select("c", "block").distinct()
    queries = asks.join(classes.drop("block"), "c").select("block", F.lit(1).alias("asks"), "c", "n", "label", "members", "tokens", "q")
    index = classes.select("block", F.lit(0).alias("asks"), "c", "n", "label", "members", "tokens", "q")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, block = None, None
        for batch in batches:
            found = []
            for b, asks_, c, n, label, members, tokens, q in zip(*(batch.column(i).to_pylist() for i in range(8)), strict=True):
                if b != held:
                    held, block = b, Block()
                if not asks_:
                    block.add(c, n, (members, label), tokens, q)
                    continue
                best: dict[tuple | None, list] = {}
                for other, key, count in block.search(n, (members, label), tokens, q):
                    best.setdefault(key if apart else None, []).append((-count, other))
                for hits in best.values():
                    found += [(c, other, len(hits) > FEW) for _, other in heapq.nsmallest(FEW, hits)]
            yield _batch(a=pa.array([x[0] for x in found], pa.int64()), b=pa.array([x[1] for x in found], pa.int64()),
                         more=pa.array([x[2] for x in found], pa.bool_()))

    return index.unionByName(queries).repartition("block").sortWithinPartitions("block", "asks").mapInArrow(
        run, "a bigint, b bigint, more boolean")


def _rest(heads: DataFrame, labels: DataFrame, asked: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b): links of the queries of ``asked`` (a, b, more) that had more candidates in a component than were compared
    and are still not in it. The component's classes are dealt into blocks with their whole sets, and a query goes once
    to every block: candidates are found by the same search and compared on the spot until one links. Only the sets of
    these components and queries are dealt out."""
    at = labels.select(F.col("node").alias("c"), "label")
    at = heads.select("c", "n").join(at, "c", "left").withColumn("label", F.coalesce("label", "c"))
    side = lambda x: at.select(F.col("c").alias(x), F.col("label").alias(f"l{x}"))
    open_ = asked.where("more").join(side("a"), "a").join(side("b"), "b").where("la <> lb").select("a", "lb").distinct().checkpoint()
    if open_.isEmpty():
        return open_.select("a", F.col("lb").alias("b"))
    named = at.join(open_.select(F.col("lb").alias("label")).distinct(), "label")
    shares = named.groupBy("label").agg(F.ceil(F.sum("n") / (BLOCK * 512)).cast("int").alias("shares"))
    index = named.join(shares, "label").select(F.xxhash64("label", F.pmod("c", "shares")).alias("block"), F.lit(0).alias("asks"), "c")
    spots = F.explode(F.transform(F.sequence(F.lit(0), F.col("shares") - 1), lambda k: F.xxhash64("lb", k.cast("long"))))
    queries = open_.join(shares, open_["lb"] == shares["label"]).select("a", spots.alias("block")).select(
        "block", F.lit(1).alias("asks"), F.col("a").alias("c"))
    both = index.unionByName(queries).checkpoint()
    wanted = both.select("c").distinct().checkpoint()
    whole = _only(sets.select("c", "v"), "c bigint, v binary", wanted).groupBy("c").agg(F.first("v").alias("v"))
    known = _only(heads.select("c", "n", "tokens", "q"), "c bigint, n int, tokens array<bigint>, q array<bigint>", wanted)
    both = both.join(known, "c").join(whole, "c").select("block", "asks", "c", "n", "tokens", "q", "v")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, block, own = None, None, {}
        for batch in batches:
            found = []
            for b, asks_, c, n, tokens, q, v in zip(*(batch.column(i).to_pylist() for i in range(7)), strict=True):
                if b != held:
                    held, block, own = b, Block(), {}
                if not asks_:
                    block.add(c, n, (1,), tokens, q)
                    own[c] = v
                    continue
                mine = _unpack(v)
                for _, other in sorted((-count, other) for other, _, count in block.search(n, (0,), tokens, q)):
                    if _joint(mine, _unpack(own[other])):
                        found.append((c, other))
                        break
            yield _batch(a=pa.array([x for x, _ in found], pa.int64()), b=pa.array([y for _, y in found], pa.int64()))

    return both.repartition("block").sortWithinPartitions("block", "asks").mapInArrow(run, "a bigint, b bigint")


def classes(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, cls): set size and class of each row; rows without a shingle have class 0."""
    kind = dict(documents.dtypes)[id_col]
    docs = documents.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"))

    def one(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part, _, _, n, cls in _sets(batch, "t"):
            yield _batch(id=part.column(0), n_shingles=pa.array(n.astype(np.int64)), cls=_signed(cls))

    return _map(docs, f"id {kind}, n_shingles bigint, cls bigint", one)


def links(documents: DataFrame, text_col: str = "text") -> DataFrame:
    """(node, label): components of the classes that link with another class; classes not listed are alone."""
    ensure_checkpoint_dir(documents.sparkSession)
    docs = documents.select(F.col(text_col).alias("t")).where(F.col("t").isNotNull())
    known = documents.sparkSession.sparkContext.broadcast(_known(docs))  # at most KNOWN pairs of numbers
    lists = _pruned(_lists(_prefixes(docs, known)).checkpoint()).checkpoint()
    sets = _whole_sets(docs, lists, known).checkpoint()
    heads = _heads(lists, sets).checkpoint()
    found = _linked(_stars(lists, heads), sets).checkpoint()
    labels = connected(found)
    for apart in (False, True):
        asked = _candidates(heads, labels, apart).checkpoint()
        more = _linked(asked.select("a", "b").distinct(), sets).checkpoint()
        if not more.isEmpty():
            found = found.unionByName(more)
            labels = connected(found)
    rest = _rest(heads, labels, asked, sets).checkpoint()
    return labels if rest.isEmpty() else connected(found.unionByName(rest))


def join(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id) per row: the smallest id reachable by links, the row's own included.

    Null and empty texts have no shingle and are linked with nothing; a text of fewer than five words has its whole word
    sequence as its only shingle. Repeated rows are copies of each other. Null ids count as larger than any other. Other
    columns are not read; an empty table gives an empty one.
    """
    ensure_checkpoint_dir(documents.sparkSession)
    rows = classes(documents, id_col, text_col).checkpoint()
    least = rows.where("n_shingles > 0").groupBy("cls").agg(F.min("id").alias("least"))
    merged = links(documents, text_col)
    by_class = least.join(merged, least["cls"] == merged["node"], "left").select(
        "cls", F.coalesce("label", "cls").alias("label"), "least")
    component = by_class.groupBy("label").agg(F.min("least").alias("component_id"))
    by_class = by_class.join(component, "label").select("cls", "component_id")
    linked = rows.where("n_shingles > 0").join(by_class, "cls").select("id", "n_shingles", "component_id")
    alone = rows.where("n_shingles = 0").select("id", "n_shingles", F.col("id").alias("component_id"))
    return linked.unionByName(alone).withColumnRenamed("id", id_col)
