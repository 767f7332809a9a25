"""Line dedup against brute force: hot lines over many partitions, repeats, nulls, empty and long texts, clashing columns."""

import collections
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from txnwatch.llm import line_dedup, text

STRIP = " \t\n\v\f\r"
LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def brute(rows, documents, least):
    """{(doc_id, text): (n_lines, n_dropped, kept text)} by the definition; a document is a (doc_id, text)."""
    lines = {(i, t or ""): (t or "").split("\n") for i, t in rows}
    key = lambda x: x.strip(STRIP).translate(LOWER)
    met = collections.Counter(k for ls in lines.values() for k in {key(x) for x in ls})
    gone = {k for k, n in met.items() if n >= documents and len(k) >= least}
    return {d: (len(ls), sum(key(x) in gone for x in ls), "\n".join(x for x in ls if key(x) not in gone)) for d, ls in lines.items()}


def corpus(seed, n=120):
    rng = random.Random(seed)
    hot = ["Subscribe  now", " subscribe  NOW\t", "İstanbul", "x", "É", "é", "", "  ", "\x0b"]
    rows = []
    for i in range(n):
        ls = [rng.choice(hot) if rng.random() < 0.5 else f"line {rng.randrange(40)}" for _ in range(rng.randrange(0, 12))]
        rows.append((i if i % 17 else None, "\n".join(ls) if i % 23 else None))
    rows += [rows[5]] * 9 + [(None, "Subscribe  now")] * 30 + [(5, "another text of the same id\nx")]
    rows.append((1000, "\n".join(["rare one"] * 3000 + ["x"] * 3000 + [f"line {k % 50}" for k in range(3000)])))
    return rows


@pytest.mark.parametrize("documents,least,parts", [(10, 1, 23), (2, 1, 1), (3, 2, 7), (1000, 1, 5)])
def test_equals_brute_force(spark, documents, least, parts):
    rows = corpus(documents)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        made = line_dedup.bitmaps(df, documents, least)
        got = line_dedup.apply(df, made).collect()
        held = made.collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    want = brute(rows, documents, least)
    assert len(held) == len(want) and sum(r.n_dropped for r in held) == sum(d for _, d, _ in want.values())
    for r in held:  # the bits themselves
        assert int(np.unpackbits(np.frombuffer(zlib.decompress(r.keep), np.uint8), count=r.n_lines).sum()) == r.n_lines - r.n_dropped
    expected = collections.Counter((i, *want[i, t or ""]) for i, t in rows)
    assert collections.Counter((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in got) == expected


def test_a_stream_may_be_cut_anywhere():
    """Partitions and batches cut at random places settle the same lines."""
    rng = random.Random(4)
    rows = sorted({(rng.randrange(6), 1, rng.randrange(9), rng.randrange(2)) for _ in range(60)} | {(7, 1, d, 0) for d in range(40)})
    rows = sorted(rows + [rows[3]] * 4 + [(7, 1, 5, 0)] * 6)
    met = collections.Counter(r[:2] for r in set(rows))
    want = {r for r in rows if met[r[:2]] >= 5}
    for seed in range(30):
        rng = random.Random(seed)
        cuts = sorted(rng.choices(range(len(rows) + 1), k=seed % 7))
        dropped, opened, edges = set(), [], collections.defaultdict(list)
        for p, (a, z) in enumerate(zip([0, *cuts], [*cuts, len(rows)])):
            batches, at = [], a
            while at < z:
                to = min(z, at + rng.randrange(1, 20))
                k, s, d, t = zip(*rows[at:to])
                batches.append(pa.RecordBatch.from_arrays(
                    [pa.array(k, pa.int64()), pa.array(s, pa.int32()), pa.array([None if x == 0 else x for x in d], pa.int64()), pa.array(t, pa.int64()),
                     pa.array([b"0000"] * (to - at), pa.binary()), pa.array([p] * (to - at), pa.int32())], names=["key", "size", "doc_id", "text_hash", "at", "task"]))
                at = to
            for out in line_dedup._seen(5)(iter(batches)):
                for r in out.to_pylist():
                    row = (r["key"], r["size"], r["doc_id"] or 0, r["text_hash"])
                    if r["kind"] == line_dedup.DROP:
                        dropped.add(row)
                    elif r["kind"] == line_dedup.OPEN:
                        opened.append(row)
                    else:
                        edges[row[:2]].append((r["part"], r["n"], row[2:], (r["last_id"] or 0, r["last_hash"])))
        total = {k: sum(n for _, n, _, _ in v) - sum(x[3] == y[2] for x, y in zip(sorted(v), sorted(v)[1:])) for k, v in edges.items()}
        dropped |= {r for r in opened if total[r[:2]] >= 5}
        assert dropped == want


def test_line_keys_of_odd_rows():
    texts = ["a\n\n A ", None, "", "\n", "É\nx", "  ", "ab\r\nAB"]
    key, size, points, row, number = text.lines(pa.array(texts))
    want = [(r, k, x.strip(STRIP).translate(LOWER)) for r, t in enumerate(texts) for k, x in enumerate((t or "").split("\n"))]
    assert [(int(a), int(b)) for a, b in zip(row, number)] == [w[:2] for w in want]
    assert size.tolist() == [len(w[2].encode()) for w in want] and points.tolist() == [len(w[2]) for w in want]
    same = collections.defaultdict(set)
    for k, w in zip(key.tolist(), want):
        same[w[2]].add(k)
    assert all(len(v) == 1 for v in same.values()) and len(set.union(*same.values())) == len(same)


def test_empty_tables_clashing_columns_and_other_names(spark):
    schema = "doc_id long, text string, keep string, n_lines string, text_hash string, places int, part int, kind int, at int, key string, size int"
    empty = spark.createDataFrame([], schema)
    assert line_dedup.bitmaps(empty).collect() == [] and line_dedup.apply(empty, line_dedup.bitmaps(empty)).collect() == []
    rows = [(i, "same\nown " + str(i), "k", "n", "h", 1, 2, 3, 4, "y", 5) for i in range(12)]
    df = spark.createDataFrame(rows, schema)
    got = line_dedup.apply(df, line_dedup.bitmaps(df))
    assert got.columns == ["doc_id", "text", "n_lines", "n_dropped"]
    assert sorted(map(tuple, got.collect())) == [(i, f"own {i}", 2, 1) for i in range(12)]
    named = df.select(F.col("doc_id").alias("n"), F.col("text").alias("body"))
    assert line_dedup.bitmaps(named, doc_id="n", text="body").agg(F.sum("n_dropped")).first()[0] == 12
