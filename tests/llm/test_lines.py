import hashlib
import os
import random
from collections import defaultdict

import numpy as np
import pytest

from riskflow.llm import lines


def plain(rows, least=10):
    """(id, lines, dropped, text) by dictionaries."""
    key = lambda x: "".join(c.lower() if c.isascii() else c for c in x.strip(" \t\n\v\f\r"))
    last = lambda i: float("inf") if i is None else i
    holders = defaultdict(set)
    for i, text, *_ in rows:
        for x in (text or "").split("\n"):
            if len(key(x)) >= least:
                holders[key(x)].add(last(i))
    out = []
    for i, text, *_ in rows:
        all_ = (text or "").split("\n")
        kept = [x for x in all_ if len(holders[key(x)]) < 2 or last(i) == min(holders[key(x)])]
        out.append((i, len(all_), len(all_) - len(kept), "\n".join(kept)))
    return out


def check(documents, rows, given, **more):
    found = rows(lines.drop_repeated_lines(documents(given), **more))
    assert found == sorted(plain(given), key=lambda r: tuple((v is not None, str(type(v)), v) for v in r))


def test_pool_of_lines(documents, rows, prose):
    rng = random.Random(3)
    pool = [prose(rng.randint(1, 9)) for _ in range(60)] + ["short", "ninechars", "ten chars!", "éééééééééé", "ééééééééé", "", " ", "\t Common Line \r"]
    check(documents, rows, [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(0, 30)))) for i in range(300)])


def test_rules(documents, rows):
    given = [
        (5, "The Same Line\nonly here it is\nthe same line"), (3, "  the same line\t\nshort\nÉcole nationale"), (9, "THE SAME LINE\r\nshort\nécole nationale\n"),
        (7, "the same line\nthe same line "), (8, " ten chars!\nten chars!"), (4, "ten chars!"), (6, "\n\n"),
    ]
    check(documents, rows, given)
    kept = {r[0]: r[3] for r in rows(lines.drop_repeated_lines(documents(given)))}
    assert kept[5] == "only here it is" and kept[9] == "short\nécole nationale\n" and kept[8] == " ten chars!"


def test_odd_rows(documents, rows, odd):
    check(documents, rows, odd)


def test_repeated_and_null_ids(documents, rows):
    given = [(1, "a long enough line\nx"), (1, "a long enough line\ny"), (2, "a long enough line\nanother long line"), (None, "another long line"), (None, "held by null ids only"), (None, "held by null ids only")]
    check(documents, rows, given)


def test_no_rows(documents):
    assert lines.drop_repeated_lines(documents([(1, "x")]).limit(0)).collect() == []


@pytest.mark.parametrize("copies", [1, 400])
def test_hot_shards_are_split(documents, rows, prose, copies, monkeypatch):
    """A third of all rows hold one line; a shard is copied to many tasks, the result stays."""
    monkeypatch.setattr(lines, "SHARD_BYTES", lines.SHARD_BYTES // copies if copies == 1 else 400)
    monkeypatch.setattr(lines, "FLUSH_KEYS", 50)
    given = [(i, ("the line that all of them hold\n" if i % 3 == 0 else "") + prose(3)) for i in range(600)]
    check(documents, rows, given, shard_bytes=5000)


def test_perfect_hash():
    keys = np.frombuffer(b"".join(hashlib.md5(str(i).encode()).digest() for i in range(50_000)), np.uint64).reshape(-1, 2)
    for n in (0, 1, 2, 63, 1000, 50_000):
        table = lines.PerfectHash.load(lines.PerfectHash.of(keys[:n]).dump())
        assert sorted(table(keys[:n])) == list(range(n))
        assert n < 1000 or len(table.dump()) * 8 / n < 4.2
    half = keys.copy()
    half[:, 0] = 7  # keys that differ in one half only
    assert sorted(lines.PerfectHash.of(half)(half)) == list(range(50_000))


def test_unknown_keys_and_wide_counts():
    keys = np.frombuffer(os.urandom(16 * 30_000), np.uint64).reshape(-1, 2)
    counts, owners = np.ones(10_000, np.int64), np.arange(10_000)
    counts[::10] = 70_000
    shard = lines.Shard(*lines.Shard.row(keys[:10_000], counts, owners))
    held, owner = shard(keys)
    assert (held[:10_000] == counts).all() and (owner[:10_000][counts > 1] == owners[counts > 1]).all()
    assert (held[10_000:] > 0).sum() <= 1  # by a fingerprint of 32 bits
