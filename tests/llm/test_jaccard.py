import random
from collections import defaultdict

import numpy as np
import pytest

from riskflow.llm import jaccard as J
from riskflow.llm.graph import components


def shingle_set(text, width=5):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))) if w else frozenset()


def plain(rows, width=5, num=75, den=100):
    sets = [shingle_set(t, width) for _, t in rows]
    label = list(range(len(rows)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and den * both >= num * len(sets[i] | sets[j]):
                label[find(i)] = find(j)
    least = defaultdict(lambda: float("inf"))
    for i, (key, _) in enumerate(rows):
        least[find(i)] = min(least[find(i)], key)
    return sorted((key, len(sets[i]), least[find(i)]) for i, (key, _) in enumerate(rows))


def got(df):
    return sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect())


def edited(rng, text, times):
    w = text.split()
    for _ in range(times):
        i = rng.randrange(len(w) + 1)
        w[i : i + rng.choice([0, 1, 1])] = rng.choice([[], ["new"], ["other%d" % rng.randrange(99)]])
    return " ".join(w)


def test_matches_all_pairs(documents, odd, prose):
    """Chains of edits around the threshold at all sizes, copies, and a passage that many share."""
    rng, rows, common = random.Random(5), [], prose(40)
    for size in [2, 4, 5, 6, 7, 8, 9, 10, 11, 12, 14, 18, 24, 35, 36, 40, 46, 60, 90, 140, 300]:
        for _ in range(3):
            text = prose(size)
            for _ in range(6):
                rows.append((len(rows) + 1000, text))
                text = edited(rng, text, max(1, rng.randrange(max(2, size // 12))))
    rows += [(len(rows) + 1000 + i, common + " " + prose(rng.choice([3, 8, 20, 60]))) for i in range(40)]
    rows += odd
    rng.shuffle(rows)
    assert got(J.near_duplicates(documents(rows).repartition(7))) == plain(rows)


def test_other_width_and_similarity(documents, prose):
    rng = random.Random(9)
    rows = [(i, edited(rng, t, i % 9)) for t in (prose(60), prose(25)) for i in range(12)]
    rows = [(k, t) for k, (_, t) in enumerate(rows)]
    assert got(J.near_duplicates(documents(rows), width=3, similarity=(60, 100))) == plain(rows, 3, 60, 100)


@pytest.mark.parametrize("n", [3, 4, 5, 6, 7, 8, 9, 15, 16, 17, 31, 32, 40, 63, 64, 65, 100, 128, 170, 300])
def test_similar_sets_meet_in_their_lists(n):
    """The pigeonhole itself: at the greatest difference that is still similar, some list is common to both."""
    rng, scheme = np.random.default_rng(n), J.Scheme(3, 4)
    for _ in range(30):
        other = int(rng.integers(n, scheme.largest(n) + 1))
        both = -(-3 * (n + other) // 7)
        if both > n:
            continue
        pool = np.unique(J.mix64(rng.integers(1, 2**63, 4 * other).astype(np.uint64)))
        rng.shuffle(pool)
        a = np.sort(pool[:n])
        b = np.sort(np.concatenate([pool[:both], pool[n : n + other - both]]))
        assert scheme.similar(a, b)
        lists = [{(end, int(s)) for end, bound, _ in scheme.places(len(x)) for s in J.signatures(x, end, bound, scheme)[0]} for x in (a, b)]
        assert len(a) == len(b) == both or lists[0] & lists[1]


def test_repeated_and_null_ids_and_empty_table(documents, prose):
    assert J.near_duplicates(documents([])).collect() == []
    t = prose(30)
    out = J.near_duplicates(documents([(4, t), (4, t), (None, t), (6, t + " x"), (4, "a b"), (None, "")])).collect()
    assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in out) == [
        ("4", 1, "4"), ("4", 26, "4"), ("4", 26, "4"), ("6", 27, "4"), ("None", 0, "None"), ("None", 26, "4"),
    ]


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(100)] + [(500, i) for i in range(400, 450)] + [(7, 7), (900, 901), (901, 900)]
    found = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert all(found[i] == 0 for i in range(101)) and all(found[i] == 400 for i in [*range(400, 450), 500]) and found[901] == 900
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").collect() == []
