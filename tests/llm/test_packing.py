import zlib
from collections import defaultdict
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from riskflow.llm import packing


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


TEXTS = ["", " ", "Hello  world", "it's 日本語 ñ é\r\n\t x", "<|endoftext|>", "a<|endoftext|><|endoftext|> b", "12345 !!??", "a" * 3000, " " * 500, "  x"]


@pytest.mark.parametrize("text", TEXTS)
def test_ids_equal_the_tokenizer_files(tokenizer, text):
    assert packing.encode(text, packing.vocabulary_path()).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_ids_of_any_text(text):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")) if not hasattr(test_ids_of_any_text, "t") else test_ids_of_any_text.t
    test_ids_of_any_text.t = tokenizer
    text = text.encode("utf-8", "ignore").decode()
    assert packing.encode(text, packing.vocabulary_path()).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.text("abc", max_size=2), st.integers(0, 5000), min_size=1, max_size=6), st.integers(1, 700))
def test_schedule_serves_every_window_in_proportion(totals, span):
    plan, total = packing.schedule(totals), sum(totals.values())
    before = [0] * len(totals)
    for t in [*range(0, total, span), total]:
        now = plan.served(t)
        assert sum(now) == t and all(a <= b for a, b in zip(before, now))
        for q, n in zip(plan.queues, now):
            assert abs(n - Fraction(totals[q] * t, max(total, 1))) < len(totals)
        before = now
    assert before == [totals[q] for q in plan.queues]


def test_targets_hold_until_a_queue_runs_dry():
    plan = packing.schedule({"a": 1000, "b": 1000, "c": 10}, {"a": 3, "b": 1})
    assert plan.served(400) == [300, 100, 0]
    assert plan.served(1333)[0] == 1000
    assert plan.served(2005) == [1000, 1000, 5] and plan.served(2010) == [1000, 1000, 10]


def checked(tokenizer, rows, pieces, length):
    ids = {i: np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [0], "<u4") for i, t in rows}
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        own = ids[p["doc_id"]][p["start"] : p["start"] + p["length"]]
        assert bytes(p["ids"]) == own.tobytes() and len(own) == p["length"] > 0 and p["doc_tokens"] == len(ids[p["doc_id"]])
        by_doc[p["doc_id"]].append((p["start"], p["length"]))
        by_sequence[p["sequence_id"]].append((p["offset"], p["length"]))
    for spans, size in [*((by_doc[i], len(x)) for i, x in ids.items()), *((v, None) for v in by_sequence.values())]:
        at = 0
        for start, n in sorted(spans):
            assert start == at
            at += n
        assert at == size if size is not None else at <= length
    sizes = [sum(n for _, n in by_sequence[s]) for s in sorted(by_sequence)]
    assert sorted(by_sequence) == list(range(len(sizes))) and all(n == length for n in sizes[:-1])
    return sizes


def test_pieces_cover_each_id_once(tokenizer, documents, odd, prose):
    rows = [(i, t, ["a", "b", None, ""][i % 4]) for i, t in odd] + [(100 + i, prose(30 * i), "abc"[i % 3]) for i in range(12)] + [(200, "<|endoftext|> x", "z")]
    pieces = packing.pack(documents(rows).repartition(5), length=128, window=4).collect()
    sizes = checked(tokenizer, [r[:2] for r in rows], pieces, 128)
    assert len(sizes) == -(-sum(sizes) // 128)


def test_windows_keep_the_mixture(documents, prose):
    rows = [(i, prose(80), "big" if i % 4 else "small") for i in range(80)]
    pieces = packing.pack(documents(rows).repartition(6), length=64, window=4).collect()
    total = sum(p["length"] for p in pieces)
    share = sum(p["length"] for p in pieces if p["source"] == "small") / total
    for w in range(total // 256):
        own = [p for p in pieces if p["sequence_id"] // 4 == w]
        assert sum(p["length"] for p in own) == 256
        assert abs(sum(p["length"] for p in own if p["source"] == "small") - share * 256) <= 2


def test_many_sources_share_a_queue(tokenizer, documents):
    rows = [(i, f"text {i}", f"s{i}") for i in range(20)]
    pieces = packing.pack(documents(rows), length=16, max_queues=4).collect()
    checked(tokenizer, [r[:2] for r in rows], pieces, 16)
    assert {p["source"] for p in pieces if not p["source"].startswith("=")} == {"other"}


def test_empty_table_and_repeated_ids(documents):
    assert packing.pack(documents([])).collect() == []
    pieces = packing.pack(documents([(1, "a b"), (1, "a b"), (None, "c")])).collect()
    assert sorted((str(p["doc_id"]), p["length"]) for p in pieces) == [("1", 3), ("1", 3), ("None", 2)]
    assert all(zlib.crc32(bytes(p["ids"])) for p in pieces)
