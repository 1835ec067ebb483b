import hashlib
import re

from pyspark.sql import functions as F

from riskflow.llm.exact_dedup import exact_dedup, keep_first


def plain(rows):
    norm = {i: re.sub(r"[\x20\x09-\x0d]+", " ", t or "") for i, t in rows}
    groups = {}
    for i, t in norm.items():
        groups.setdefault(t, []).append(i)
    return sorted((i, min(groups[t]), len(groups[t]), i == min(groups[t]), hashlib.sha256(t.encode()).hexdigest()) for i, t in norm.items())


def got(df):
    return sorted(tuple(r) for r in df.collect())


def test_matches_plain_version(documents, odd):
    rows = odd + [(100, "a  b"), (101, "a\tb"), (102, "a b"), (103, "a b"), (104, "A b")]
    assert got(exact_dedup(documents(rows))) == plain(rows)


def test_colliding_hashes_are_kept_apart(documents, odd):
    weak = lambda text: F.lit("same").cast("string")
    assert got(exact_dedup(documents(odd), content_hash=weak)) == plain(odd)


def test_repeated_and_null_ids(documents):
    rows = [(5, "t"), (5, "t"), (9, "t"), (None, "t"), (None, "u")]
    out = exact_dedup(documents(rows)).collect()
    assert sorted((str(r["doc_id"]), str(r["keep_id"]), r["group_size"], r["kept"]) for r in out) == [
        ("5", "5", 4, True), ("5", "5", 4, True), ("9", "5", 4, False), ("None", "5", 4, False), ("None", "None", 1, True),
    ]


def test_empty_table(documents):
    assert exact_dedup(documents([])).collect() == []


def test_keep_first_keeps_columns(documents):
    docs = documents([(2, "a"), (1, "a"), (3, "b")])
    kept = keep_first(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 3]


def test_no_python_in_the_plan(documents):
    plan = exact_dedup(documents([(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
