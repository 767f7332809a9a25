"""Each stage of corpus_pipeline against a plain version over the stage's own input, at sf0.001."""

import re

import corpus_pipeline as C
from tokenizers import Tokenizer

from txnwatch.llm import pii, queries
from txnwatch.llm.decontaminate import TOLERANCE

from .test_jaccard import brute

SF = "/root/testdata/sf0.001"


def words(t):
    return re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def nearest(item, text):
    row = [0] * (len(text) + 1)
    for i, x in enumerate(item, 1):
        new = [i]
        for j, y in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)


def test_stages_take_effect(spark):
    assert [n for n, _ in C.STAGES] == ["quality rules", "n-gram Jaccard join", "benchmark decontamination", "PII", "BPE encoding and decoding"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    verdict = {r.doc_id: r.kept for r in queries.op3_quality_rules(spark, SF).collect()}
    before = {r.doc_id: r for r in docs.collect()}
    one = C.STAGES[0][1](spark, docs, SF)
    assert one.columns == docs.columns
    kept = {r.doc_id: r for r in one.collect()}
    assert set(kept) == {i for i, k in verdict.items() if k} and all(kept[i] == before[i] for i in kept) and len(kept) < len(before)

    one = spark.createDataFrame(list(kept.values()), docs.schema)
    two = C.STAGES[1][1](spark, one, SF)
    roots = {c for _, _, c in brute([(i, r.text) for i, r in kept.items()])}
    left = {r.doc_id: r for r in two.select(docs.columns).collect()}
    assert set(left) == roots and len(left) < len(kept)

    two = spark.createDataFrame(list(left.values()), docs.schema)
    items = [words(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = {r.doc_id: r for r in C.STAGES[2][1](spark, two, SF).collect()}
    dirty = set(left) - set(clean)
    grams = {tuple(w[i:i + 4]) for w in items for i in range(len(w) - 3)}
    for i, r in left.items():
        t = words(r.text)
        near = len(t) < 2000 and any(tuple(t[j:j + 4]) in grams for j in range(len(t)))
        assert (i in dirty) == (near and any(nearest(w, t) <= len(w) // TOLERANCE for w in items if len(w) >= 5)), i

    three = spark.createDataFrame(list(clean.values()), docs.schema)
    safe = {r.doc_id: r for r in C.STAGES[3][1](spark, three, SF).collect()}
    assert set(safe) == set(clean)
    for i, r in safe.items():
        assert not pii.pattern_spans(r.text) and r.n_chars == len(r.text)
        assert bool(pii.pattern_spans(clean[i].text)) <= (r.text != clean[i].text)

    four = spark.createDataFrame(list(safe.values()), docs.schema)
    ids = {r.doc_id: r for r in C.STAGES[4][1](spark, four, SF).collect()}
    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    assert set(ids) == set(safe)
    for i, r in ids.items():
        import numpy as np
        assert np.frombuffer(r.token_ids, "<u4").tolist() == tokenizer.encode(safe[i].text, add_special_tokens=False).ids
        assert r.text == safe[i].text and r.n_tokens * 4 == len(r.token_ids)


def test_run(spark):
    got = C.run(spark, SF)
    assert got.columns == ["doc_id", "n_tokens", "token_ids", "text"] and got.count() > 50


ODD = "doc_id long, text string, lang string, source string, n_chars long, label string, kept string, row string, spans int, c long"


def test_stages_with_odd_rows(spark):
    body = " ".join(f"word{i}" for i in range(40))
    rows = [(1, body, "en"), (1, body, "en"), (1, "other " + " ".join(f"x{i}" for i in range(40)), "en"), (2, body + " end", None), (None, body, "en"),
            (None, None, None), (3, None, "en"), (4, "", "de"), (5, "short", "fr"), (6, "w " * 9000 + "a@b.cd", "en")]
    docs = spark.createDataFrame([(*r, "s", 7, "l", "k", "r", 1, 2) for r in rows], ODD)
    for name, stage in C.STAGES:
        empty = stage(spark, docs.limit(0), SF)
        assert empty.collect() == []
        if name != C.STAGES[-1][0]:
            assert empty.columns == docs.columns
            assert stage(spark, docs, SF).columns == docs.columns
    # the first id of the copies stays, with both of its texts; rows without an id stay
    left = sorted(((r.doc_id, r.text) for r in C.near_duplicates(spark, docs, SF).collect()), key=repr)
    assert left == sorted({(r[0], r[1]) for r in rows if r[0] != 2}, key=repr)
    safe = C.redaction(spark, docs, SF)
    assert safe.count() == len(rows) and all(r.n_chars == (len(r.text) if r.text is not None else None) for r in safe.collect())
    assert "n_chars" not in C.redaction(spark, docs.drop("n_chars"), SF).columns
    assert C.encoding(spark, docs, SF).count() == len(rows)
