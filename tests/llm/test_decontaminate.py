import random
import re

from riskflow.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def plain(docs, items, size=13):
    windows = {}
    for item, text in items:
        w = words(text)
        k = min(size, len(w))
        for i in range(len(w) - k + 1 if k else 0):
            windows.setdefault(tuple(w[i : i + k]), set()).add(str(item))
    lengths, out = {len(w) for w in windows}, []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for k in lengths:
            for i in range(len(w) - k + 1):
                if (x := windows.get(tuple(w[i : i + k]))) is not None:
                    hit |= set(range(i, i + k))
                    found |= x
        out.append((doc, len(w), len(hit), tuple(sorted(found))))
    return sorted(out)


def bench(spark, items):
    return spark.createDataFrame([(*i, 1, "x") for i in items], "item_id long, text string, term long, words string")


def got(spark, documents, docs, items, **k):
    found = D.find_benchmark(documents(docs), bench(spark, items), **k)
    return sorted((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["item_ids"])) for r in found.collect())


def test_matches_plain_version(spark, documents, odd):
    rng = random.Random(3)
    vocabulary = ["the", "of", "and", "É", "rare1", "rare2", "x9", "ß"] + [f"w{i}" for i in range(12)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(rng.choice([1, 2, 3, 12, 13, 14, 40]))) for i in range(30)] + [(90, None), (91, ""), (92, "- -"), (93, "the the the the"), (94, "the of " * 10), (94, "rare1 rare2")]
    docs = [(1000 + i, f"{text(50)}, {rng.choice(items)[1] or ''}\n{text(20)}") for i in range(60)] + odd + [(2000, items[0][1]), (2001, "THE the The tHe the the")]
    docs += [(3000, "the of " * 60)]
    assert got(spark, documents, docs, items) == plain(docs, items)


def test_empty_tables(spark, documents):
    assert got(spark, documents, [], [(1, "a b")]) == []
    found = D.find_benchmark(documents([(1, "a b"), (None, "c")]), bench(spark, []))
    assert sorted((str(r["doc_id"]), r["n_words"], r["n_hit"]) for r in found.collect()) == [("1", 2, 0), ("None", 1, 0)]


def test_null_and_repeated_ids(spark, documents):
    docs = [(None, "a b c"), (7, "a b c"), (7, "a b c"), (7, "z")]
    found = D.find_benchmark(documents(docs), bench(spark, [(1, "b c")])).collect()
    assert sorted((str(r["doc_id"]), r["n_words"], r["n_hit"]) for r in found) == [("7", 1, 0), ("7", 3, 2), ("7", 3, 2), ("None", 3, 2)]


def test_near_matches_allow_inserted_words(spark, documents):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    items = D.benchmark_items(bench(spark, [(1, item)]))
    terms = D.item_terms(items)
    docs = documents([(1, "x " + item.replace("gamma", "gamma so very")), (2, "alpha x beta"), (3, "kappa iota theta eta zeta epsilon delta gamma beta alpha " * 2)])
    near = D.near_matches(D.postings(docs, terms), terms).collect()
    assert {r["doc"] for r in near} >= {1} and 2 not in {r["doc"] for r in near}


def test_a_twentieth_is_contaminated(spark):
    rows = spark.createDataFrame([(0, 0), (1, 20), (1, 21), (0, 5)], "n_hit long, n_words long")
    assert [r[0] for r in rows.select(D.contaminated()).collect()] == [False, True, False, False]
