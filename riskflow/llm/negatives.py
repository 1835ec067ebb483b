"""Hard negatives of anchors by exact inner-product search in cover trees."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskflow.llm.common import parallelism, saved

LAST = (1 << 63) - 1  # stands for a null id: after every other
TREE_ROWS = 2048  # rows of one tree
BUFFER_NUMBERS = 1 << 22  # components that a task sorts by label before it cuts trees
LEAF_ROWS = 8
SHELF_TREES = 32  # trees that one task searches
SLICE_ANCHORS = 4096  # anchors that one task searches for
EXACT = float(1 << 52)  # up to this product of norms doubles hold every inner product exactly

ROW = np.dtype([("uid", "i8"), ("id", "i8"), ("label", "i8")])
NODE = np.dtype([("row", "i4"), ("first", "i4"), ("last", "i4"), ("radius", "f8"), ("low", "i8"), ("high", "i8")])


def cover_tree(vectors: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """The nodes of a cover tree over rows of integers, each node's children next to each other.

    Rows get one more coordinate that gives all of them the norm of the longest, so the nearest rows to (query, 0) are
    those with the largest inner products. A node stands for a row and holds rows within ``radius`` of it, the exact largest
    distance. Its children's centres, the node's own among them, are more than half the radius apart and each of its
    rows is within half the radius of one of them: the farthest row becomes a centre until none is left outside. Nodes of
    few or equal rows have rows as children; a node without children is a row. ``low`` and ``high`` bound the labels.
    """
    x = vectors.astype(np.float64)
    norms = (x**2).sum(axis=1)
    x = np.column_stack([x, np.sqrt(norms.max() - norms)])
    squares = (x**2).sum(axis=1)
    away = np.sqrt(np.maximum(squares[:, None] + squares - 2 * (x @ x.T), 0))
    np.fill_diagonal(away, 0)
    slack = 1e-3 + 1e-6 * squares.max() ** 0.5  # more than rounding can take from a distance
    nodes, held = [], [(0, np.arange(len(x)))]
    at = 0
    while at < len(held):
        centre, rows = held[at]
        reach = away[centre, rows]
        radius, first = reach.max(), len(held)
        own = labels[rows]
        if len(rows) == 1:
            first = 0
        elif len(rows) <= LEAF_ROWS or radius <= 1:
            held += [(int(r), np.array([r])) for r in rows]
        else:
            owner, centres = np.zeros(len(rows), np.int64), [centre]
            while reach[far := int(reach.argmax())] > radius / 2:
                new = away[rows[far], rows]
                closer = new < reach
                owner[closer], reach = len(centres), np.minimum(reach, new)
                centres.append(int(rows[far]))
            held += [(c, rows[owner == k]) for k, c in enumerate(centres)]
        nodes.append((centre, first, len(held) if first else 0, radius + slack if first else 0.0, own.min(), own.max()))
        at += 1
    return np.array(nodes, NODE)


class Forest:
    """Trees searched together, best node first."""

    def __init__(self, trees: list[tuple[bytes, bytes, bytes]], dims: int):
        rows, vectors, nodes, self.roots = [], [], [], []
        n_rows = n_nodes = 0
        for row, vector, node in trees:
            rows.append(np.frombuffer(row, ROW))
            vectors.append(np.frombuffer(vector, np.int64 if len(vector) == 8 * dims * len(rows[-1]) else np.int32).reshape(-1, dims))
            node = np.frombuffer(bytearray(node), NODE)
            inner = node["last"] > 0
            node["first"][inner] += n_nodes
            node["last"][inner] += n_nodes
            node["row"] += n_rows
            self.roots.append(n_nodes)
            nodes.append(node)
            n_rows, n_nodes = n_rows + len(rows[-1]), n_nodes + len(node)
        self.rows, self.nodes, x = np.concatenate(rows), np.concatenate(nodes), np.concatenate(vectors)
        longest = float((x.astype(np.float64) ** 2).sum(axis=1).max()) ** 0.5
        self.longest, self.x = longest, x.astype(np.float64)[self.nodes["row"]]
        self.whole = x.astype(np.int64)[self.nodes["row"]] if longest >= EXACT**0.5 / 64 else None
        self.leaf = self.nodes["last"] == 0
        self.seen = 0  # rows whose exact score was looked at

    def scores(self, q: np.ndarray, at: slice | np.ndarray) -> np.ndarray:
        """Exact inner products, as int64 where doubles might round."""
        if self.whole is not None and self.longest * float((q.astype(np.float64) ** 2).sum()) ** 0.5 >= EXACT:
            return self.whole[at] @ q
        return self.x[at] @ q.astype(np.float64)

    def search(self, q: np.ndarray, uid: int, label: int, same: bool, low: np.ndarray, high: np.ndarray, k: int) -> list[list[tuple[int, int]]]:
        """Per window [low, high] the first k (score, id) of rows of the same or of another label than ``label``, but for the row ``uid``.

        With |q| r as the most that any row of a node can differ from its centre in score, a node is left out when that keeps it
        outside of all windows or below the k-th score found in each it meets.
        """
        norm, low, nodes = float((q.astype(np.float64) ** 2).sum()) ** 0.5, low.copy(), self.nodes
        found: list[list[tuple[int, int]]] = [[] for _ in low]
        heap: list[tuple[float, int]] = []

        def offer(at: np.ndarray, scores: np.ndarray) -> None:
            """Put the nodes of ``at`` that may hold a result on the heap, and rows among the results."""
            n = nodes[at]
            fits = (n["low"] <= label) & (n["high"] >= label) if same else (n["low"] != label) | (n["high"] != label)
            slack = norm * n["radius"]
            top, bottom = scores + slack, scores - slack
            best = np.full(len(at), -np.inf)
            for a, b in zip(low, high):
                best = np.maximum(best, np.where((top >= a) & (bottom <= b), np.minimum(top, float(b)), -np.inf))
            fits &= best > -np.inf
            for i in np.flatnonzero(fits & ~self.leaf[at]):
                heapq.heappush(heap, (-best[i], int(at[i])))
            rows = np.flatnonzero(fits & self.leaf[at])
            self.seen += int(self.leaf[at].sum())
            if not len(rows):
                return
            r = self.rows[n["row"][rows]]
            value = scores[rows]
            if same:
                own = r["uid"] != uid
                r, value = r[own], value[own]
            for w, (a, b) in enumerate(zip(low, high)):
                inside = np.flatnonzero((value >= a) & (value <= b))
                if not len(inside):
                    continue
                if len(inside) > k:
                    cut = np.partition(value[inside], -k)[-k]
                    inside = inside[value[inside] >= cut]
                both = [*found[w], *((-int(v), int(i)) for v, i in zip(value[inside], r["id"][inside]))]
                found[w] = heapq.nsmallest(k, both)
                if len(found[w]) == k:
                    low[w] = -found[w][-1][0]

        roots = np.array(self.roots)
        offer(roots, self.scores(q, roots))
        while heap:
            best, at = heapq.heappop(heap)
            if -best < low.min():
                break
            first, last = int(nodes["first"][at]), int(nodes["last"][at])
            offer(np.arange(first, last), self.scores(q, slice(first, last)))
        return [[(-s, i) for s, i in w] for w in found]


def _trees(dims: int, scale: int):
    """Trees of a task's rows, sorted by label in blocks of bounded size, and the anchors among the rows."""
    names = ["kind", "uid", "id", "label", "vector", "rows", "nodes"]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), *[pa.binary()] * 3]
    pack = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
    most = max(TREE_ROWS, BUFFER_NUMBERS // max(1, dims))

    def cut(rows: np.ndarray, x: np.ndarray) -> Iterator[pa.RecordBatch]:
        order = np.argsort(rows["label"], kind="stable")
        for i in range(0, len(order), TREE_ROWS):
            part = order[i : i + TREE_ROWS]
            own, v = rows[part], x[part]
            small = np.abs(v).max(initial=0) < 1 << 31
            yield pack([("tree", int(own["uid"][0]), None, None, v.astype(np.int32 if small else np.int64).tobytes(), own.tobytes(), cover_tree(v, own["label"]).tobytes())])

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uid, kept = TaskContext.get().partitionId() << 40, []
        for batch in batches:
            for i in range(0, batch.num_rows, most):
                part = batch.slice(i, most)
                sizes = np.array([len(v) for v in part.column("__vector")])
                x = np.zeros((len(sizes), dims))
                x[np.arange(dims) < sizes[:, None]] = np.floor(part.column("__vector").flatten().to_numpy(zero_copy_only=False) * scale)
                if np.abs(x).max(initial=0) >= 1 << 40 or float((x**2).sum(axis=1).max(initial=0)) >= float(1 << 62):
                    raise ValueError("vectors so long that an inner product may not fit 64 bits")
                x = x.astype(np.int64)
                rows = np.empty(len(x), ROW)
                rows["uid"], rows["id"], rows["label"] = np.arange(uid, uid + len(x)), part.column("__id").to_numpy(), part.column("__label").to_numpy()
                uid += len(x)
                chosen = np.flatnonzero(part.column("__anchor").to_numpy(zero_copy_only=False).astype(bool))
                if len(chosen):
                    yield pack([("anchor", *rows[i].tolist(), x[i].tobytes(), None, None) for i in chosen])
                kept.append((rows, x))
                if sum(len(r) for r, _ in kept) >= most:
                    yield from cut(np.concatenate([r for r, _ in kept]), np.concatenate([v for _, v in kept]))
                    kept = []
        if kept:
            yield from cut(np.concatenate([r for r, _ in kept]), np.concatenate([v for _, v in kept]))

    return of


def _searched(dims: int, same: bool, k: int):
    def of(anchors: pa.Table, trees: pa.Table) -> pa.Table:
        out = []
        if anchors.num_rows and trees.num_rows:
            forest = Forest(list(zip(*(trees[c].to_pylist() for c in ("rows", "vectors", "nodes")))), dims)
            for uid, label, raw, low, high in zip(*(anchors[c].to_pylist() for c in ("uid", "label", "vector", "low", "high"))):
                windows = forest.search(np.frombuffer(raw, np.int64), uid, label, same, np.array(low), np.array(high), k)
                out += [(uid, w, int(s), i) for w, rows in enumerate(windows) for s, i in rows]
        columns = list(zip(*out)) or [[]] * 4
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
        return pa.table({n: pa.array(c, t) for n, c, t in zip(("uid", "window", "score", "id"), columns, kinds)})

    return of


def _grid(anchors: DataFrame, trees: DataFrame, slices: int, shelves: int, search) -> DataFrame:
    """Every slice of anchors meets every shelf of trees in one group; both are of bounded size."""
    left = anchors.withColumn("slice", F.pmod(F.xxhash64("uid"), slices)).withColumn("shelf", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shelves - 1).cast("long"))))
    right = trees.withColumn("shelf", F.pmod(F.xxhash64("tree"), shelves)).withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slices - 1).cast("long"))))
    return left.groupBy("slice", "shelf").cogroup(right.groupBy("slice", "shelf")).applyInArrow(search, "uid long, window int, score long, id long")


def _first(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("uid", "window").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(
    df: DataFrame,
    is_anchor: Column,
    *,
    positives: int = 5,
    negatives: int = 10,
    low_percent: int = 30,
    high_percent: int = 90,
    scale: int = 256,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score), all scores exact.

    Components become floor(``scale`` x), a score is an inner product of such integers; higher scores come first, then smaller
    ids. An anchor (a row where ``is_anchor`` is true) has as positives its first rows of the same label but itself; each
    positive has as negatives the first rows of other labels with ``low_percent`` to ``high_percent`` of its score.

    Rows become cover trees of at most 2,048 rows where they are read, without a shuffle. Slices of anchors meet shelves of
    trees in groups of bounded size, first for the positives, then, with all windows of an anchor at once, for the negatives; a task
    hands on what may still be among the first. Every row is compared or excluded by a bound.

    Rows with a null label, a null vector or a component that is null or not finite take no part. Shorter vectors count as if filled
    with zeros, an empty one as zeros only. Rows that repeat an id are rows of their own: a copy of an anchor is another
    row of its label. A null id is no anchor unless ``is_anchor`` says so, and comes after all others. Ids and labels are integers.
    No rows or no anchors give no rows. Vectors so long that a score may not fit 64 bits are an error.
    """
    spark = df.sparkSession
    rows = df.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("__id"),
        F.col(label_col).cast("long").alias("__label"),
        F.col(vector_col).cast("array<double>").alias("__vector"),
        F.coalesce(is_anchor, F.lit(False)).alias("__anchor"),
    )
    finite = F.forall("__vector", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    rows = rows.where(F.col("__label").isNotNull() & F.col("__vector").isNotNull()).where(finite)
    dims = rows.agg(F.max(F.size("__vector"))).first()[0] or 1
    schema = "kind string, uid long, id long, label long, vector binary, rows binary, nodes binary"
    written = saved(rows.mapInArrow(_trees(dims, scale), schema), "cover_trees", ["kind"])
    trees = written.where("kind = 'tree'").select(F.col("uid").alias("tree"), F.col("vector").alias("vectors"), F.col("rows").alias("rows"), F.col("nodes").alias("nodes"))
    anchors = written.where("kind = 'anchor'").select("uid", "id", "label", "vector")
    counts = {r["kind"]: r["count"] for r in written.groupBy("kind").count().collect()}
    n_trees = counts.get("tree", 0)
    shelves, slices = max(1, min(n_trees, parallelism(spark)), -(-n_trees // SHELF_TREES)), max(1, -(-counts.get("anchor", 0) // SLICE_ANCHORS))

    everything = anchors.withColumn("low", F.array(F.lit(-LAST))).withColumn("high", F.array(F.lit(LAST)))
    near = saved(_first(_grid(everything.drop("id"), trees, slices, shelves, _searched(dims, True, positives)), positives).select("uid", "rank", "score", "id"), "positives")
    # score = 100 a + b, so no product leaves 64 bits.
    split = near.withColumn("b", F.pmod("score", F.lit(100))).withColumn("a", F.expr("(score - b) div 100"))
    low = F.expr(f"{low_percent} * a + ({low_percent} * b + 99) div 100").alias("low")
    high = F.expr(f"{high_percent} * a + ({high_percent} * b) div 100").alias("high")
    bounds = split.select("uid", F.struct("rank", low, high).alias("w"))
    windows = bounds.groupBy("uid").agg(F.sort_array(F.collect_list("w")).alias("w")).select("uid", F.col("w.low").alias("low"), F.col("w.high").alias("high"))
    asked = anchors.drop("id").join(windows, "uid")
    mined = _first(_grid(asked, trees, slices, shelves, _searched(dims, False, negatives)), negatives)
    pairs = near.select("uid", (F.col("rank") - 1).alias("window"), F.col("score").alias("positive_score"), F.col("id").alias("positive_id"))
    named = mined.withColumnsRenamed({"id": "negative_id", "score": "negative_score"}).join(pairs, ["uid", "window"]).join(anchors.select("uid", F.col("id").alias("anchor_id")), "uid")
    null = lambda c: F.when(F.col(c) != LAST, F.col(c)).alias(c)
    return named.select(null("anchor_id"), null("positive_id"), "rank", null("negative_id"), "positive_score", "negative_score")
