import random
import zlib

import numpy as np

from riskflow.llm import toxicity as T

INSULTS = ["idiot", "moron", "scum"]


def labelled(spark, documents, prose, n=600):
    rng, rows, labels = random.Random(1), [], []
    for i in range(n):
        toxic, w = i % 4 == 0, prose(rng.randrange(10, 80)).split()
        for _ in range(rng.randrange(1, 5) if toxic else 0):
            w.insert(rng.randrange(len(w)), rng.choice(INSULTS))
        rows.append((i, " ".join(w)))
        labels.append((i, 1, int(toxic)))
    return documents(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), labels


def test_held_out_accuracy(spark, documents, prose):
    docs, labels, truth = labelled(spark, documents, prose)
    scores = {r["doc_id"]: r["score"] for r in T.score(docs, T.train(docs, labels)).collect()}
    held = [(scores[i], y) for i, _, y in truth if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([(s >= 0.5) == y for s, y in held]) > 0.95 and all(0 <= s <= 1 for s, _ in held)


def test_held_out_labels_are_never_read(spark, documents, prose):
    docs, labels, truth = labelled(spark, documents, prose, 200)
    flipped = [(i, q, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, q, y in truth]
    a, b = T.train(docs, labels), T.train(docs.repartition(3), spark.createDataFrame(flipped, labels.schema))
    assert np.allclose(a.weights, b.weights, atol=1e-5) and abs(a.intercept - b.intercept) < 1e-5


def test_counts_equal_plain_counts(spark, documents, prose):
    """The ratios behind the weights follow from the counts of all labelled rows, whatever the sample."""
    texts = [prose(20) for _ in range(30)]
    f = T.Features(T.Settings())
    for t in texts:
        raw = f" {t.lower()} ".encode()
        grams = {raw[i : i + n] for n in (3, 4, 5) for i in range(len(raw) - n + 1)}
        code = {(int.from_bytes(g, "little") * 0x9E3779B97F4A7C15 % 2**64) >> 46 for g in grams}
        assert set(f(t).tolist()) == code


def test_long_text_equals_its_blocks(monkeypatch, prose):
    text = prose(400)
    whole = set(T.Features(T.Settings())(text).tolist())
    monkeypatch.setattr(T, "BLOCK", 100)
    assert set(T.Features(T.Settings())(text).tolist()) == whole


def test_odd_texts_and_missing_labels(spark, documents, odd, prose):
    docs, labels, _ = labelled(spark, documents, prose, 100)
    model = T.train(docs, labels)
    out = T.score(documents([*odd, (None, "x")]), model).collect()
    assert len(out) == len(odd) + 1 and all(0 <= r["score"] <= 1 for r in out)
    nothing = T.train(docs, labels.where("false"))
    assert all(r["score"] < 0.01 for r in T.score(docs, nothing).collect())
    assert T.score(documents([]), model).collect() == []
    mixed = spark.createDataFrame([(None, 1, 1), (1, 1, None), (2, 1, 5)], labels.schema)
    assert T.train(docs, mixed).weights.any() == False  # noqa: E712
