"""The queries of operators that SQL can express equal their DuckDB SQL on the sf0.001 tables."""

import random

import duckdb
import pytest

from check_oracle import TABLES, digest
from txnwatch.llm.oracle import ORACLE
from txnwatch.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    got = digest(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(ORACLE[name])
    assert got == digest([d[0] for d in cur.description], cur.fetchall())


def test_quality_sql_where_cutoffs_decide(spark, tmp_path):
    rng = random.Random(5)
    docs, labels = [], []
    for i in range(1500):
        good = rng.random() < 0.8
        words = [f"w{rng.randrange(10**6)}" for _ in range(rng.choice([12, 30, 40]))]
        if not good:
            kind = rng.randrange(4)
            words = [w + "#" * (kind == 0) + "!?" * (kind == 1) for w in words]
            words = [w.upper() * 2 for w in words] if kind == 2 else words
            words = words + words[:10] if kind == 3 else words
        elif rng.random() < 0.02:
            words[0] += "$" * rng.randrange(40)
        docs.append((i, ("\n" if i % 5 else " ").join(words) if i % 100 else None, rng.choice(["en", "en", "en", "de", None])))
        labels.append((i, int(good) if i % 7 else None, 0))
    spark.createDataFrame(docs, "doc_id long, text string, lang string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").coalesce(1).write.parquet(f"{tmp_path}/labels.parquet")
    df = QUERIES["op3_quality_rules"](spark, str(tmp_path))
    rows = [tuple(r) for r in df.collect()]
    c = duckdb.connect()
    for t in ("documents", "labels"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    cur = c.execute(ORACLE["op3_quality_rules"])
    assert digest(df.columns, rows) == digest([d[0] for d in cur.description], cur.fetchall())
    by = df.columns.index("base_failed"), df.columns.index("kept")
    assert sum(not r[by[0]] and not r[by[1]] for r in rows) > 100
