"""Connected components by alternating large and small stars."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm.common import saved

TASK_EDGES = 300_000  # edges that one task can finish by itself (some 100 MB)


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, label) of the edges of one task."""
    above: dict[int, int] = {}

    def top(x: int) -> int:
        while (y := above.setdefault(x, x)) != x:
            above[x] = above[y]
            x = y
        return x

    for batch in batches:
        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            u, v = top(u), top(v)
            above[max(u, v)] = min(u, v)
    nodes = list(above)
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([top(x) for x in nodes], pa.int64())], names=["node", "label"])


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, label): for every node of an edge the smallest node it is connected to.

    A large star hangs a node's greater neighbours on its smallest one, a small star its smaller neighbours; the number
    of rounds grows with the logarithm of the longest path. Minima are taken inside each partition first. Every round is
    written. Up to ``TASK_EDGES`` distinct edges are joined in one task, at once. No edges give no rows.
    """
    smaller, greater = F.least(a, b), F.greatest(a, b)
    now = saved(edges.select(greater.alias("u"), smaller.alias("v")).where("u <> v").distinct(), "edges")
    if now.count() <= TASK_EDGES:
        return saved(now.coalesce(1).mapInArrow(_forest, "node long, label long"), "components")
    before = None
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u")
        small = moved.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").union(moved.select("u", F.col("m").alias("v")))
        now = saved(small.distinct(), "edges")
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    ends = now.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return saved(ends.union(now.select(F.col("v").alias("node"), F.col("v").alias("label"))).distinct(), "components")
