import hashlib
from collections import Counter

import numpy as np
import pytest

from riskflow.llm import vector_codes as V

KIND = "vec_id long, embedding array<float>, label int, code string, error long, part int, state binary, n long"


def table(spark, rows):
    return spark.createDataFrame([(*r, "c", 1, 2, b"s", 3) for r in rows], KIND)


def plain(rows, rounds=4):
    """[(id, code, error, label error)] and the codebooks, by comparing everything with integers."""
    kept = [(i, np.floor(np.array(v, np.float32).astype(float) * 1024).astype(int), y) for i, v, y in rows if v and all(x is not None and np.isfinite(x) for x in v)]
    seeds = {}
    for i, v, _ in kept:
        if i is not None and (i not in seeds or tuple(v) < tuple(seeds[i])):
            seeds[i] = v
    books = np.array([seeds[i] for i in sorted(seeds)[:256]]).reshape(-1, 4, len(kept[0][1]) // 4).swapaxes(0, 1)
    x = np.array([v for _, v, _ in kept]).reshape(len(kept), 4, -1)

    def nearest():
        return np.stack([((x[:, p, None] - books[p][None]) ** 2).sum(axis=2) for p in range(4)], axis=1)

    for _ in range(rounds):
        at, new = nearest().argmin(axis=2), books.copy()
        for p in range(4):
            for e in set(at[:, p]):
                new[p, e] = x[at[:, p] == e, p].sum(axis=0) // (at[:, p] == e).sum()
        books = new
    d = nearest()
    error, by_label = d.min(axis=2).sum(axis=1), Counter()
    for (_, _, y), e in zip(kept, error):
        by_label[y] += int(e)
    return [(i, bytes(d[k].argmin(axis=1).astype(np.uint8)).hex(), int(error[k]), by_label[y]) for k, (i, _, y) in enumerate(kept)], books


def check(spark, rows, given):
    coded, books = V.encode(table(spark, given))
    expected, entries = plain(given)
    assert (books.entries == entries).all()
    assert rows(V.with_label_error(coded), "vec_id", "code", "error", "label_error") == sorted(expected, key=lambda r: tuple((v is not None, str(type(v)), v) for v in r))
    return books


def cloud(n, seed=1, dims=16, centres=40, spread=0.05):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, dims))
    return [(i, [float(x) for x in middle[rng.integers(centres)] + spread * rng.normal(size=dims)], int(i % 3) if i % 7 else None) for i in range(n)]


@pytest.mark.parametrize("n", [1, 5, 256, 900])
def test_equals_comparing_everything(spark, rows, n):
    check(spark, rows, cloud(n))


def test_bounds_save_distances(spark, rows):
    books = check(spark, rows, cloud(1500))
    assert books.scans[0] == books.possible[0]
    assert books.scans[3] < 0.8 * books.possible[3]


def test_ties_and_repeated_rows(spark, rows):
    given = [(i % 300, [float(x) / 1024 for x in (i % 2, 0, i % 3, 1, 0, 0, i % 5, 2)], 1) for i in range(700)]
    check(spark, rows, given)


def test_rows_left_out(spark, rows):
    nan, inf = float("nan"), float("inf")
    odd = [(1000, None, 1), (1001, [1.0, None, 0.0, 0.0] * 4, 1), (0, [nan] * 16, 1), (1003, [inf] + [0.0] * 15, 1), (1004, [-inf] + [0.0] * 15, 1), (1005, [], 2)]
    given = [*odd, (None, [0.5] * 16, None), *cloud(300)]
    check(spark, rows, given)
    coded, _ = V.encode(table(spark, [*given, (2000, [1.0] * 12, 1)]))  # as long as no other
    assert coded.count() == 301 and coded.where("vec_id = 2000").count() == 0


def test_no_rows(spark):
    for given in ([], [(1, None, 1)], [(1, [float("nan")] * 4, 1)]):
        coded, books = V.encode(table(spark, given))
        assert coded.columns == ["vec_id", "label", "code", "error"] and coded.count() == 0 and books.text() == ""
        assert V.with_label_error(coded).count() == 0


def test_outside_the_domain(spark):
    with pytest.raises(ValueError, match="equal parts"):
        V.encode(table(spark, [(1, [1.0] * 6, 1)]))
    with pytest.raises(Exception, match="a component is at least"):
        V.encode(table(spark, [(1, [1e9] * 8, 1)]))


def test_net_displacement_is_tighter_than_drifts():
    """An entry that goes there and back has no net displacement; summed steps would make every bound useless."""
    rng = np.random.default_rng(5)
    base = rng.integers(-3000, 3000, (1, 64, 4))
    history = [base, base + 900, base.copy()]
    x = (base[0][rng.integers(64, size=500)] + rng.integers(-20, 20, (500, 4)))[:, None].astype(float)
    state = np.zeros(500, V.Assignment(history[:1]).state)
    first, all_groups = V.Assignment(history[:1])(x, state)
    again, scans = V.Assignment(history)(x, state)
    assert all_groups == 500 * 4 and scans < 0.4 * all_groups and (first == again).all()
    assert (state["at"][:, 0] == ((x - base[0][None]) ** 2).sum(axis=2).argmin(axis=1)).all()


def test_digest_of_codebooks():
    assert hashlib.sha256(V.Codebooks([np.arange(-2, 6).reshape(2, 2, 2)]).text().encode()).hexdigest() == hashlib.sha256(b"-2,-1,0,1,2,3,4,5").hexdigest()
