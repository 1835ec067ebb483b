import hashlib

import pytest

from riskflow.llm import warc

ROWS = [
    (1, "http://a/1", "x" * 200), (2, "http://a/2", "x" * 200), (3, "http://a/\r\nInjected: 1", "short"), (4, None, "short"),
    (5, "http://b", None), (6, "http://b", ""), (7, "http://c", "é" * 60 + "\r\n\r\nWARC/1.1\r\n"), (8, "http://c", "y" * 400_000), (9, "http://c", "y" * 400_000),
]


def pages(spark, rows):
    return spark.createDataFrame([(*r, "z", "d") for r in rows], "page_id long, url string, html string, header string, digest string")


def through(spark, tmp_path, rows):
    path = str(tmp_path / "archive")
    warc.write_archive(warc.bodies(pages(spark, rows)), path)
    return warc.read_archive(spark, path)


def test_round_trip(spark, tmp_path):
    found = {r["page_id"]: r for r in warc.described(through(spark, tmp_path, ROWS)).collect()}
    for page, _, html in ROWS:
        raw = (html or "").encode()
        same = [p for p, _, h in ROWS if (h or "").encode() == raw]
        revisit = len(raw) >= 100 and page != min(same)
        assert tuple(found[page]) == (page, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if revisit else "response", min(same) if revisit else None)
    assert len(found) == len(ROWS)


def test_records_are_whole(spark, tmp_path):
    for r in through(spark, tmp_path, ROWS).collect():
        head, _, rest = bytes(r["record"]).partition(b"\r\n\r\n")
        fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        assert head.startswith(b"WARC/1.1\r\n") and "Injected" not in fields
        assert rest == (b"" if fields["WARC-Type"] == "revisit" else bytes(r["payload"])) + b"\r\n\r\n"
        assert int(fields["Content-Length"]) == len(rest) - 4


def test_payloads_are_stored_once(spark, tmp_path):
    through(spark, tmp_path, ROWS)
    assert spark.read.parquet(str(tmp_path / "archive/payloads")).count() == len({(h or "") for _, _, h in ROWS})


def test_damaged_payload_is_noticed(spark, tmp_path):
    through(spark, tmp_path, ROWS[:2])
    kept = spark.read.parquet(str(tmp_path / "archive/payloads")).selectExpr("digest", "cast('other' as binary) payload", "records")
    kept.write.parquet(str(tmp_path / "bad/payloads"))
    spark.read.parquet(str(tmp_path / "archive/headers")).write.parquet(str(tmp_path / "bad/headers"))
    with pytest.raises(Exception, match="does not match its digest"):
        warc.read_archive(spark, str(tmp_path / "bad")).collect()


def test_null_and_repeated_ids_and_empty_table(spark, tmp_path):
    rows = [(None, "u", "x" * 100), (3, "u", "x" * 100), (3, "u", "x" * 100)]
    out = warc.described(through(spark, tmp_path, rows)).collect()
    assert sorted((str(r["page_id"]), r["record_type"], r["refers_to"]) for r in out) == [("3", "response", None), ("3", "response", None), ("None", "revisit", 3)]
    assert warc.described(through(spark, tmp_path / "empty", [])).collect() == []
