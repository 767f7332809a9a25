"""The join against brute force: real documents' shapes, large near-copy groups, shared passages, odd rows."""

import random
import re

import numpy as np
import pytest

from txnwatch.llm import jaccard


def brute(rows):
    sets = {}
    for i, t in rows:
        w = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.setdefault(i, frozenset(tuple(w[j:j + 5]) for j in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []))
    ids, parent = sorted(sets), {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    holders = {}
    for i in ids:
        for s in sets[i]:
            holders.setdefault(s, []).append(i)
    for i in ids:
        shared = {}
        for s in sets[i]:
            for j in holders[s]:
                if j < i:
                    shared[j] = shared.get(j, 0) + 1
        for j, n in shared.items():
            if 100 * n >= 80 * (len(sets[i]) + len(sets[j]) - n):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return sorted((i, len(sets[i]), root(i)) for i in ids)


def corpus(seed, n=260):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefgh", k=3))
    text = lambda k: " ".join(word() for _ in range(k))
    base, passage, rows = text(90), text(40), []
    for _ in range(n):
        kind = rng.random()
        if kind < 0.35:  # near copies of one text, about as far apart as a link allows
            w = base.split()
            for _ in range(rng.choice([0, 1, 2, 3, 4])):
                w[rng.randrange(len(w))] = word()
            t = " ".join(w)
        elif kind < 0.55:
            t = text(rng.randrange(5, 60)) + " " + passage
        elif kind < 0.65 and rows:
            t = rng.choice(rows)
        else:
            t = text(rng.randrange(0, 12))
        rows.append(t.upper() if rng.random() < 0.05 else t)
    return [(3 * i + 7, t) for i, t in enumerate(rows)] + [(1, None), (2, ""), (4, " \n\t"), (5, "a b c"), (6, "A  b\nc"), (8, "a b c d")]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    monkeypatch.setattr(jaccard, "FEW", 1)
    rows = corpus(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert sorted(map(tuple, jaccard.join(df).collect())) == brute(rows)


def test_sets_next_to_the_threshold():
    for n in range(1, 60):
        for m in range(n, 80):
            need = jaccard.needed(n, m)
            assert 100 * need >= 80 * (n + m - need) and 100 * (need - 1) < 80 * (n + m - need + 1)
            if need <= n:  # the bounds that prune must never exceed what a link may have
                assert jaccard.shared_prefix(n, m) <= jaccard.prefix_length(n)


def test_block_search_loses_no_link():
    rng = random.Random(5)
    for _ in range(60):
        base = rng.sample(range(1, 1 << 40), 80)
        sets = []
        for c in range(40):
            own = sorted({*rng.sample(base, rng.randrange(5, 75)), *(rng.randrange(1 << 40) for _ in range(rng.randrange(4)))})
            if rng.random() < 0.6 and sets:
                own = sorted({*rng.choice(sets)[:-rng.randrange(1, 9)], *(rng.randrange(1 << 40) for _ in range(rng.randrange(6)))})
            sets.append(own if len(own) >= 5 else [1, 2, 3, 4, 5])
        head = lambda s: s[:int(jaccard.prefix_length(len(s)))]
        block = jaccard.Block()
        for c, s in enumerate(sets[1:], 1):
            block.add(c, len(s), (1, c), head(s), jaccard.marks(s, len(s)))
        x = sets[0]
        got = {c: k for c, _, k in block.search(len(x), (0, 0), head(x), jaccard.marks(x, len(x)))}
        for c, s in enumerate(sets[1:], 1):
            common, shared = len({*x} & {*s}), len({*head(x)} & {*head(s)})
            assert common - shared <= jaccard.beyond(len(x), jaccard.marks(x, len(x)), len(s), jaccard.marks(s, len(s)))
            if 100 * common >= 80 * (len(x) + len(s) - common):
                assert got[c] == shared
            elif c in got:
                assert got[c] == shared


def test_empty_tables_and_clashing_columns(spark):
    schema = "doc_id long, text string, cls string, n_shingles string, label int, component_id string"
    assert jaccard.join(spark.createDataFrame([], schema)).collect() == []
    rows = [(1, "a b c d e f", "x", "y", 2, "z"), (1, "a b c d e f", "x", "y", 2, "z"), (0, "q r s t u", "x", None, 2, "z")]
    got = jaccard.join(spark.createDataFrame(rows, schema))
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted(map(tuple, got.collect())) == [(0, 1, 0), (1, 2, 1), (1, 2, 1)]


def test_pruning_keeps_every_member_that_may_link():
    rng = random.Random(9)
    for _ in range(300):
        k = rng.randrange(1, 9)
        n = np.array(sorted(rng.choice([5, 9, 50, 100, 101, 125, 126, 400]) for _ in range(k)), np.int32)
        own = np.array([rng.randrange(1, 12) for _ in range(k)], np.int64)
        fit = lambda i, j: jaccard.needed(n[i], n[j]) <= min(n[i], n[j]) and min(own[i], own[j]) >= jaccard.shared_prefix(int(n[i]), int(n[j]))
        want = [any(fit(i, j) for j in range(k) if j != i) for i in range(k)]
        got = jaccard._may_link(n, own).tolist()
        assert all(g or not w for g, w in zip(got, want))  # none is lost; a member alone of its size is told exactly
        sizes = [n.tolist().count(x) for x in n.tolist()]
        assert all(g == w for g, w, t in zip(got, want, sizes) if t == 1)


def test_comparisons_of_a_large_group_of_near_copies(spark, monkeypatch):
    # few of the group link with all others, so its first links leave many components
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=5))
    base, rows, compared = [word() for _ in range(150)], [], []
    for i in range(300):
        w = list(base)
        for k in rng.sample(range(150), 1 if rng.random() < 0.03 else 2):
            w[k] = word()
        rows.append((i, " ".join(w)))
    linked = jaccard._linked

    def counted(pairs, sets):
        pairs = pairs.checkpoint()
        compared.append(pairs.count())
        return linked(pairs, sets)

    monkeypatch.setattr(jaccard, "_linked", counted)
    got = jaccard.join(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert sorted(tuple(r) for r in got.collect()) == brute(rows)
    assert sum(compared) <= 20 * len(rows)  # with all components' candidates at once 22,717
