"""A content-addressed WARC archive: payload bytes once per digest, record headers apart, records rebuilt by a join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.llm.common import saved

CRLF = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _line(name: str, value: Column) -> Column:
    """A header line; none for a null value. Line ends within a value are percent-encoded, so they can't end the line."""
    plain = F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), plain, F.lit(CRLF)), F.lit(""))


def bodies(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", body_col: str = "html") -> DataFrame:
    """One row per page: ``id``, ``url``, ``digest``, ``size`` in bytes, ``payload``. A null body is an empty payload."""
    body = pages.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(body_col).cast("binary"), F.lit("").cast("binary")).alias("payload"),
    )
    return body.select("id", "url", F.sha2("payload", 256).alias("digest"), F.octet_length("payload").alias("size"), "payload")


def headers(body: DataFrame, *, date: str = "1970-01-01T00:00:00Z", min_revisit_bytes: int = 100) -> DataFrame:
    """One WARC header per row of ``bodies``: ``header`` (exact bytes as text, up to and including the empty line), ``digest``.

    Of the rows with equal payloads of at least ``min_revisit_bytes``, that with the smallest id is the response, the
    others are revisits that refer to it; smaller payloads are all responses. A null url leaves its line out. Rows that
    repeat the smallest id are all responses; a null id is never the smallest. No payload is moved for this.
    """
    rows = body.select("id", "url", "digest", "size")
    first = (
        rows.where(F.col("size") >= min_revisit_bytes)
        .groupBy(F.col("digest").alias("__digest"))
        .agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
    )
    revisit = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    uri = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    header = F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _line("WARC-Record-ID", uri("id")),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        _line("WARC-Refers-To", F.when(revisit, uri("first"))),
        _line("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        _line("Content-Type", F.lit("text/html; charset=utf-8")),
        _line("Content-Length", F.when(revisit, F.lit(0)).otherwise(F.col("size")).cast("string")),
        F.lit(CRLF),
    )
    groups = saved(first, "first_pages")
    return rows.join(groups, F.col("digest") == F.col("__digest"), "left").select(header.alias("header"), "digest")


def write_archive(body: DataFrame, path: str, **choices) -> None:
    """Headers and payloads of ``bodies`` below ``path``. A digest is stored once; the payload is part of the grouping
    key, so equal digests are verified byte by byte, and two payloads of one digest stop the reader. Copies are collapsed
    inside each input partition before anything is sent."""
    headers(body, **choices).write.parquet(f"{path}/headers")
    body.groupBy("digest", "payload").agg(F.count(F.lit(1)).alias("records")).write.parquet(f"{path}/payloads")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """The original records: ``header``, ``digest``, ``payload`` (full, for revisits too), ``record`` (the record's own
    bytes; a revisit has an empty block). Every payload is hashed again and must match its digest."""
    kept = spark.read.schema("digest string, payload binary, records long").parquet(f"{path}/payloads")
    proved = kept.select(
        F.when(F.sha2("payload", 256) == F.col("digest"), F.col("digest"))
        .otherwise(F.raise_error(F.lit("a stored payload does not match its digest")).cast("string"))
        .alias("digest"),
        "payload",
    )
    heads = spark.read.schema("header string, digest string").parquet(f"{path}/headers")
    end = F.lit(CRLF + CRLF).cast("binary")
    block = F.when(field("WARC-Type") == "revisit", F.lit("").cast("binary")).otherwise(F.col("payload"))
    return heads.join(proved, "digest").withColumn("record", F.concat(F.col("header").cast("binary"), block, end))


def field(name: str, header: str = "header") -> Column:
    """The value of a header line, null where there is none."""
    found = F.regexp_extract(header, rf"\r\n{name}: ([^\r\n]*)\r\n", 1)
    return F.when(F.contains(F.col(header), F.lit(f"{CRLF}{name}: ")), found)


def page_of(name: str, header: str = "header") -> Column:
    number = F.regexp_extract(field(name, header), r"^<urn:page:(-?[0-9]+)>$", 1)
    return F.when(number != "", number).cast("long")


def described(rows: DataFrame, id_col: str = "page_id") -> DataFrame:
    """What the records read from an archive say, one row per record; sizes and digests are taken from the payload."""
    return rows.select(
        page_of("WARC-Record-ID").alias(id_col),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_digest"),
        field("WARC-Type").alias("record_type"),
        page_of("WARC-Refers-To").alias("refers_to"),
    )
