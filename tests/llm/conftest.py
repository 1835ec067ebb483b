import random

import pytest

CLASHES = {"keep_id": "x", "node": 1, "row": 2, "kind": "k", "host": "h", "digest": "d", "version": 3, "queue": "q", "__text": "t", "__id": 4, "id": 5, "words": "w", "path": "p", "n": 6, "label": 7}
WORDS = [a + b + c for a in ("ka", "ro", "mi", "tu", "zé") for b in ("len", "dor", "vis", "") for c in ("ta", "mo", "x")]


@pytest.fixture(scope="session")
def documents(spark):
    """A documents table from (doc_id, text) or (doc_id, text, source), with extra columns whose names clash."""

    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", 0, *CLASHES.values()) for r in rows]
        kinds = ", ".join(f"`{k}` {'string' if isinstance(v, str) else 'long'}" for k, v in CLASHES.items())
        return spark.createDataFrame(full, f"doc_id long, text string, lang string, source string, n_chars long, {kinds}")

    return make


@pytest.fixture(scope="session")
def prose():
    rng = random.Random(7)
    return lambda n: " ".join(rng.choice(WORDS) + rng.choice(WORDS) for _ in range(n))


ODD = [None, "", " ", "\n\t\r", "a", "É ß 日本", "x" * 300_000, "0" * 50_000, "1 2 " * 30_000, "a b " * 30_000]


@pytest.fixture
def odd():
    """Null, empty, white, very short and very long texts, twice each."""
    return [(i, t) for i, t in enumerate(ODD * 2)]
