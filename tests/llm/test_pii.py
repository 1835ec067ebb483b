import random
import re

import pytest

from riskflow.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def passes(kind, text):
    digits = re.sub("[^0-9]", "", text)
    if kind == "ip":
        return all(len(x.lstrip("0")) <= 3 and int(x) <= 255 for x in text.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 10 <= len(digits) <= 15


def plain(text):
    spans = [(m.start(), k, m.end(), kind) for k, (kind, p) in enumerate(PATTERNS.items()) for m in re.finditer(p, text or "") if passes(kind, m.group())]
    return ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in sorted(spans))


CASES = [
    "a@b.co@d.e", "a@b.co_x@y.z", "x@y @z.w a.b@c-d.e.f. @a.b q@..w q@w..e", "é😀ä%+-@1.2 日本a@b.c", "1.2.3.4.5.6.7.8 256.1.1.1 001.002.3.0255 1.2.3", "999.1.1.1.1.1",
    "4572801887383181 4572 8018 8738 3181 45728018-8738-3181 4572801887383182 0 00 1-", "+1 (407) 555-7710 +12 345 +1 234 567 890 123 456 +1--2 + 1", "+1 (407) 555-7710 4572801887383181 2.3.4.5 a@b.c",
    "1" * 20_000, "1 " * 20_000, "a" * 20_000 + "@b.c", "+1" * 9_000, "1." * 9_000, "-" * 9_000 + "@" + "a." * 9_000 + "z", "é" * 9_000 + " a@b.c 1.2.3.4",
]


def test_seeds_equal_plain_matches(documents, odd):
    rng = random.Random(4)
    pieces = ["a", "B", "9", "12", ".", "@", "-", " ", "+", "(", ")", "%", "_", "é", "😀", "\n", "4572801887383181", "+1 (407) 555-7710", "8.8.8.8", "x.y@z.w"]
    rows = [(i, t) for i, t in enumerate(CASES)] + [(100 + i, "".join(rng.choice(pieces) for _ in range(rng.randrange(60)))) for i in range(400)]
    rows += [(1000 + i, t) for i, t in odd]
    found = pii.personal_data(documents(rows)).select("doc_id", pii.joined("base").alias("base"), pii.joined("spans").alias("spans")).collect()
    assert {r["doc_id"]: r["base"] for r in found} == {i: plain(t) for i, t in rows} and len(found) == len(rows)
    assert all(set(filter(None, r["base"].split(","))) <= set(r["spans"].split(",")) for r in found)


def test_patterns_find_unseen_identifiers(documents):
    rng = random.Random(6)
    address = lambda: f"{rng.randrange(1000)}user@host{rng.randrange(1000)}.example.com"
    rows = [(i, f"Words here, please write to {address()} about item {rng.randrange(10**6)} soon") for i in range(40)]
    rows += [(100, "If so please write to jane9(at)example(dot)org about it"), (101, "version 12b of it"), (102, "see part 7 please")]
    found = {r["doc_id"]: r for r in pii.personal_data(documents(rows)).select("doc_id", pii.joined("base").alias("base"), pii.joined("spans").alias("spans")).collect()}
    text = dict(rows)[100]
    at = text.index("jane9")
    assert found[100]["base"] == "" and found[100]["spans"] == f"email:{at}:{at + len('jane9(at)example(dot)org')}"
    assert found[101]["spans"] == found[102]["spans"] == ""
    assert all(found[i]["spans"] == found[i]["base"] for i in range(40))


def test_seeds_beside_punctuation_and_with_spaces_are_seeds_only(documents):
    rng = random.Random(8)
    rows, found_in = [], {}
    for i in range(12):
        digits = f"{rng.randrange(10**14, 10**15)}"
        digits = next(digits + c for c in "0123456789" if luhn(digits + c))
        card = " ".join(digits[k : k + 4] for k in range(0, 16, 4))
        rows.append((i, f"Do write to u{i}@host{i}.example.com, or log in from ({rng.randrange(1, 255)}.8.4.{i}) and pay by card {card} before noon."))
    cases = {"email": ("Do write to {}, soon", "jane9(at)example(dot)org"), "ip": ("or log in from ({}) and", "10-0-0-7"), "card": ("pay by card {} before", "x4111-1111")}
    for i, (kind, (text, word)) in enumerate(cases.items()):
        rows.append((100 + i, text.format(word)))
        at = rows[-1][1].index(word)
        found_in[100 + i] = f"{kind}:{at}:{at + len(word)}"
    found = {r["doc_id"]: r for r in pii.personal_data(documents(rows)).select("doc_id", pii.joined("base").alias("base"), pii.joined("spans").alias("spans")).collect()}
    assert {i: found[i]["spans"] for i in found_in} == found_in
    assert all(found[i]["spans"] == found[i]["base"] == plain(dict(rows)[i]) and found[i]["base"].count(":") == 6 for i in range(12))


def test_null_and_repeated_ids_and_empty_table(documents):
    assert pii.personal_data(documents([])).collect() == []
    out = pii.personal_data(documents([(None, "a@b.c"), (1, "a@b.c"), (1, "a@b.c"), (2, None)])).select("doc_id", pii.counted("base", "email").alias("n")).collect()
    assert sorted((str(r["doc_id"]), r["n"]) for r in out) == [("1", 1), ("1", 1), ("2", 0), ("None", 1)]


@pytest.mark.parametrize("digits,good", [("4572801887383181", True), ("4572801887383182", False), ("00000000000000", True)])
def test_luhn(spark, digits, good):
    from pyspark.sql import functions as F

    assert spark.createDataFrame([(digits,)], "d string").select(pii.luhn(F.col("d"))).first()[0] == good == luhn(digits)


def test_no_python_in_the_plan(documents):
    found = pii.occurrences(documents([(1, "a@b.c")]))
    for df in (pii.patterns_of(found), pii.personal_data(documents([(1, "a@b.c")]))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
