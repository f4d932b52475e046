"""Connected components of a graph held in tables."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monsoon.llm.common import Scratch, rekey

#: A graph of at most so many edges is finished in one task (some 50 MB there).
ONE_TASK_EDGES = 200_000


def _union(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            p, q = find(a), find(b)
            if p != q:
                parent[max(p, q)] = min(p, q)
    nodes = list(parent)
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([find(x) for x in nodes], pa.int64())], ["node", "root"])


def components(scratch: Scratch, edges: DataFrame) -> DataFrame:
    """(node, root) of every node of edges (a, b: long); root is one node of its component.

    Each round maps a node to the least of its closed neighbourhood and contracts the edges; ids should be in random
    order (hash them first), so that a round shrinks long chains by a constant factor.  Only aggregations with partial
    sums and joins are used: a node with any number of edges never meets in one task.  What ONE_TASK_EDGES edges are left
    is finished in one task.  Nulls and loops are ignored; an empty table of edges gives an empty result.
    """
    pairs = edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    rest = scratch.table(pairs, "edges")
    labels = None
    while rest.count() > ONE_TASK_EDGES:
        both = rest.unionByName(rest.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hop = scratch.table(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("v"), F.least("a", "b").alias("m")), "hop")
        left = hop.select(rekey(F.col("v")).alias("ka"), F.col("m").alias("ma"))
        right = hop.select(rekey(F.col("v")).alias("kb"), F.col("m").alias("mb"))
        moved = rest.select(rekey(F.col("a")).alias("ka"), rekey(F.col("b")).alias("kb")).join(left, "ka").join(right, "kb")
        after = scratch.table(
            moved.where("ma <> mb").select(F.least("ma", "mb").alias("a"), F.greatest("ma", "mb").alias("b")).distinct(), "edges"
        )
        if labels is None:
            named = hop.select(F.col("v").alias("node"), F.col("m").alias("root"))
        else:
            named = (
                labels.withColumn("ka", rekey(F.col("root")))
                .join(left, "ka", "left")
                .select("node", F.coalesce("ma", "root").alias("root"))
            )
        labels, old = scratch.table(named, "labels"), (rest, hop, labels)
        for table in old:
            if table is not None:
                scratch.drop(table)
        rest = after
    last = scratch.table(rest.select("a", "b").coalesce(1).mapInArrow(_union, "node long, root long"), "labels")
    if labels is None:
        return last
    named = labels.withColumn("k", rekey(F.col("root"))).join(last.select(rekey(F.col("node")).alias("k"), F.col("root").alias("r")), "k", "left")
    return scratch.table(named.select("node", F.coalesce("r", "root").alias("root")), "labels")
