import numpy as np
import pytest
from pyspark.sql import functions as F

from riskflow.llm import negatives as N

KIND = "vec_id long, embedding array<double>, label int, uid long, rank int, score long, kind string, slice int"


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3, "k", 4) for r in rows], KIND)


def plain(rows, every=10, scale=256, positives=5, negatives=10):
    """All scores of all anchors, sorted."""
    last = lambda i: float("inf") if i is None else i
    kept = [(i, [int(np.floor(x * scale)) for x in v], y) for i, v, y in rows if y is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for a, (i, v, y) in enumerate(kept):
        if i is None or i % every:
            continue
        scored = sorted(((sum(p * q for p, q in zip(v, w)), j, z) for b, (j, w, z) in enumerate(kept) if b != a), key=lambda r: (-r[0], last(r[1])))
        for s, j, _ in [r for r in scored if r[2] == y][:positives]:
            inside = [r for r in scored if r[2] != y and 30 * s <= 100 * r[0] <= 90 * s][:negatives]
            out += [(i, j, k, n, s, t) for k, (t, n, _) in enumerate(inside, 1)]
    return sorted(out, key=lambda r: tuple((v is not None, str(type(v)), v) for v in r))


def check(spark, rows, given, **more):
    found = rows(N.hard_negatives(table(spark, given), F.col("vec_id") % 10 == 0, **more))
    assert found == plain(given, **more)
    return found


def cloud(n, seed=2, dims=12, centres=8, spread=0.3, labels=4):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, dims))
    at = rng.integers(centres, size=n)
    return [(i, (middle[at[i]] + spread * rng.normal(size=dims)).tolist(), int(at[i] % labels if rng.random() < 0.7 else rng.integers(labels))) for i in range(n)]


@pytest.mark.parametrize("trees", [16, 2048])
def test_equals_comparing_all(spark, rows, trees, monkeypatch):
    monkeypatch.setattr(N, "TREE_ROWS", trees)
    monkeypatch.setattr(N, "SLICE_ANCHORS", 7)
    assert len(check(spark, rows, cloud(400))) > 500


def test_ties_and_repeated_rows(spark, rows):
    given = [(i % 90, [float(i % 3), float(i % 2), 1.0], i % 4) for i in range(300)]
    assert check(spark, rows, given)


def test_rows_left_out(spark, rows):
    nan, inf = float("nan"), float("inf")
    odd = [(10, None, 1), (20, [nan] * 12, 1), (30, [inf] + [0.0] * 11, 1), (40, [None] + [1.0] * 11, 2), (50, [1.0] * 12, None), (None, [0.4] * 12, 1), (None, [0.4] * 12, 2), (60, [], 1), (70, [0.5] * 3, 1), (80, [-1.0] * 12, 3)]
    check(spark, rows, [*odd, *cloud(120, seed=4)])


def test_scores_beyond_doubles(spark, rows):
    """Inner products of some 2**58 that differ in their last bits."""
    rng = np.random.default_rng(8)
    given = [(i, [float(x) for x in (1 << 28) + rng.integers(0, 3, 4) - (i % 2) * (1 << 26)], i % 2) for i in range(60)]
    assert check(spark, rows, given, scale=1)


def test_no_rows(spark):
    assert N.hard_negatives(table(spark, []), F.col("vec_id") % 10 == 0).collect() == []
    assert N.hard_negatives(table(spark, [(1, [1.0], 1), (2, [1.0], 2)]), F.col("vec_id") % 10 == 0).collect() == []
    assert N.hard_negatives(table(spark, [(10, [1.0], 1), (2, [1.0], 2)]), F.col("vec_id") % 10 == 0).collect() == []


def test_too_long_vectors(spark):
    with pytest.raises(Exception, match="64 bits"):
        N.hard_negatives(table(spark, [(10, [1e9] * 4, 1)]), F.col("vec_id") % 10 == 0)


def forest(n=600, **more):
    given = cloud(n, **more)
    x = np.floor(np.array([v for _, v, _ in given]) * 256).astype(np.int64)
    rows = np.array([(i, i, y) for i, _, y in given], N.ROW)
    tree = N.cover_tree(x, rows["label"])
    return x, rows, tree, N.Forest([(rows.tobytes(), x.tobytes(), tree.tobytes())], x.shape[1])


def test_cover_tree_holds_its_promises():
    x, rows, tree, _ = forest()
    y = np.column_stack([x, np.sqrt((x**2).sum(axis=1).max() - (x**2).sum(axis=1))])

    def below(at):
        return [int(tree["row"][at])] if not tree["last"][at] else [r for c in range(tree["first"][at], tree["last"][at]) for r in below(c)]

    assert sorted(below(0)) == list(range(len(x)))
    for at in np.flatnonzero(tree["last"]):
        n, held = tree[at], below(at)
        assert np.linalg.norm(y[held] - y[n["row"]], axis=1).max() <= n["radius"]
        assert n["low"] == rows["label"][held].min() and n["high"] == rows["label"][held].max()
        inner = [c for c in range(n["first"], n["last"]) if tree["last"][c]]
        assert all(tree["radius"][c] <= n["radius"] / 2 + 1 for c in inner)
        if n["last"] - n["first"] < len(held):
            assert n["row"] in tree["row"][n["first"] : n["last"]]


def test_bounds_skip_rows():
    x, rows, _, f = forest(2000, spread=0.05)
    for a in range(0, 200, 10):
        near = f.search(x[a], a, int(rows["label"][a]), True, np.array([-N.LAST]), np.array([N.LAST]), 5)[0]
        scores = sorted(((-int(s), i) for i, s in enumerate(x @ x[a]) if i != a and rows["label"][i] == rows["label"][a]))[:5]
        assert near == [(-s, i) for s, i in scores]
    assert f.seen < 0.5 * 20 * len(x)
