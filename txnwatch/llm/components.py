"""Connected components of a link table, by contraction: links never leave Spark."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnwatch.session import ensure_checkpoint_dir

#: Links of a task, and nodes that one of several tasks holds at once.
LINKS, NODES = 1 << 16, 1 << 18


def _melted(links: DataFrame, tasks: int) -> DataFrame:
    """(a, b): the components within each task's links as stars, a their smallest node and b each other one. Fewer links
    that connect the same nodes; with one task these are the components."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            top = x
            while (up := parent.setdefault(top, top)) != top:
                top = up
            while x != top:
                parent[x], x = top, parent[x]
            return top

        def stars() -> pa.RecordBatch:
            pairs = [(root(x), x) for x in parent]
            parent.clear()
            return pa.RecordBatch.from_arrays([pa.array([v[i] for v in pairs if v[0] != v[1]], pa.int64()) for i in (0, 1)], names=["a", "b"])

        for batch in batches:
            for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                x, y = root(x), root(y)
                parent[max(x, y)] = min(x, y)
                if tasks > 1 and len(parent) > NODES:
                    yield stars()
        yield stars()

    return links.coalesce(tasks).mapInArrow(run, "a bigint, b bigint")


def connected(links: DataFrame) -> DataFrame:
    """(node, label): the smallest node of each node's component, for all nodes of ``links`` (a, b; 64-bit, no nulls).

    Each round first every task joins the nodes of its own links; tasks are as many as the links that are left need. If
    that is more than one, every node joins its smallest neighbour, and links between joined nodes vanish. Node numbers
    that are hashes make the number of rounds logarithmic; other numberings only need more rounds. A node with a third of
    all links is one row after the partial minimum, and its links are dealt out again by the joins' skew handling.
    """
    ensure_checkpoint_dir(links.sparkSession)
    edges = links.where("a <> b").select("a", "b").checkpoint()
    labels = None
    while (n := edges.count()) or labels is None:
        tasks = max(1, -(-n // LINKS))
        edges = _melted(edges, tasks).checkpoint()
        if tasks == 1:
            parents = edges.select(F.col("b").alias("a"), F.col("a").alias("parent")).unionByName(
                edges.select("a", F.col("a").alias("parent")).distinct())
        else:
            both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
            parents = both.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("parent"))
        to = lambda name: parents.select(F.col("a").alias(name), F.col("parent").alias(f"{name}_parent"))
        if labels is None:
            labels = parents.select(F.col("a").alias("node"), F.col("parent").alias("label")).checkpoint()
        else:
            labels = labels.join(to("label"), "label", "left").select("node", F.coalesce("label_parent", "label").alias("label")).checkpoint()
        if tasks == 1:
            break
        edges = edges.join(to("a"), "a").join(to("b"), "b").select(
            F.least("a_parent", "b_parent").alias("a"), F.greatest("a_parent", "b_parent").alias("b")).where("a <> b").distinct().checkpoint()
    # a label is the root of its component, and as every join went to a smaller node, its smallest one
    return labels
