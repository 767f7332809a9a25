"""Filter audit against brute force: every order applied step by step, ties, repeats, nulls, empty tables, clashing columns."""

import collections
import itertools
import random
import re

from txnwatch.llm import filter_audit as A

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, labels):
    """The result by applying each order to the documents, filter after filter."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    docs = []
    for i, t, part in rows:
        t = t or ""
        w = WORD.findall(t)
        smaller = any(j is not None and (u or "") == t and (i is None or j < i) for j, u, _ in rows)
        fails = {"A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
                 "D": bool(re.search(r"[#$%&*|]", t)), "E": smaller}
        docs.append((part or "", {f for f in fails if fails[f]}, i in good, i in toxic))
    out = []
    for part in {d[0] for d in docs}:
        for order in itertools.permutations("ABCDE"):
            here = [d for d in docs if d[0] == part]
            for k, f in enumerate(order):
                gone = [d for d in here if f in d[1]]
                here = [d for d in here if f not in d[1]]
                failing = [d for d in docs if d[0] == part and f in d[1]]
                out.append([part, "".join(order), k + 1, len(here), len(gone), len(failing) - len(gone), sum(d[1] == {f} for d in failing),
                            sum(d[2] for d in gone), sum(d[3] for d in gone)])
    shapley = collections.Counter()
    for r in out:
        shapley[r[0], r[1][r[2] - 1]] += r[4]
    return sorted((*r, shapley[r[0], r[1][r[2] - 1]]) for r in out)


def corpus(seed):
    rng = random.Random(seed)
    rows = []
    for i in range(150):
        n = rng.choice([0, 3, 99, 100, 101, 250])
        words = rng.choices([f"w{k}" for k in range(rng.choice([60, 100, 5000]))], k=n)
        if rng.random() < 0.3:
            words = [w.upper() for w in words]
        if rng.random() < 0.2:
            words.append(rng.choice("#$%&*|"))
        rows.append((i if rng.random() < 0.9 else None, " ".join(words) if rng.random() < 0.95 else None, rng.choice(["en", "de", None])))
    rows += [(rng.choice([None, *range(200)]), rng.choice(rows)[1], rng.choice(["en", "fr"])) for _ in range(80)]
    rows += [rows[7]] * 5 + [(3, "A" * 50000, "en"), (None, "only without id", "xx"), (None, "only without id", "xx")]
    labels = [(rng.choice([None, *range(220)]), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(150)]
    return rows, labels


def test_equals_brute_force(spark):
    for seed in (1, 2):
        rows, labels = corpus(seed)
        docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
        said = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
        assert sorted(map(tuple, A.audit(docs, said).collect())) == brute(rows, labels)


def test_packed_fields_do_not_run_into_each_other():
    n = len(A.ORDERS) * 5 * len(A.OUTCOMES)
    assert n == 600 * len(A.OUTCOMES)
    rng = random.Random(3)
    counts = [rng.choice([0, 1, (1 << 62) - 1]) for _ in range(n)]
    assert A.unpacked(A.packed(counts)) == counts
    assert A.unpacked(A.packed(counts) + A.packed(counts)) == [2 * c for c in counts]
    every = [A.outcomes(m, True, False) for m in range(32)]
    total = sum(10**15 * A.packed(o) for o in every)
    assert A.unpacked(total) == [10**15 * sum(c) for c in zip(*every)]


def test_empty_tables_and_clashing_columns(spark):
    schema = "doc_id long, text string, lang string, quality string, part int, mask string, digest int, n string, good int, id int, alone int, least int"
    empty = spark.createDataFrame([], schema)
    said = spark.createDataFrame([], "doc_id long, quality int, toxic int, part string, good string")
    assert A.audit(empty, said).collect() == []
    rows = [(1, "a #", "en", "q", 1, "m", 2, "n", 3, 4, 5, 6)] * 2
    got = A.audit(spark.createDataFrame(rows, schema), said).collect()
    assert sorted(map(tuple, got)) == brute([r[:3] for r in rows], [])
    assert got[0].__fields__ == ["part", "filter_order", "step", *A.OUTCOMES, "shapley"]
