"""Exact deduplication by content hash, with a comparison of bytes inside the groups."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.llm.common import WHITE, saved, text_of


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    content_hash: Callable[[Column], Column] = F.md5,
) -> DataFrame:
    """One row per input row: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when they are the same bytes after each run of white space became one space. Rows are grouped by
    the 128-bit content hash; the text itself is part of the grouping key, so rows of one hash are compared byte by
    byte and a collision gives two groups. The grouping starts inside each input partition: of a text that a third of
    all rows share, a task sends one copy. Groups of two or more are written, then rows find theirs by (hash, SHA-256),
    in a join whose large keys adaptive execution can split; two different texts with both values equal would stop the job.

    Null and empty texts are equal. The smallest id stays; rows that repeat it are all marked kept. Null ids never
    win over others, and form a kept group if there is no other id. An empty table gives no rows. Further columns of
    ``docs`` are ignored, whatever their names.
    """
    texts = docs.select(F.col(id_col).alias("__id"), F.regexp_replace(text_of(text_col), WHITE, " ").alias("__text"))
    keyed = texts.select("__id", content_hash(F.col("__text")).alias("__hash"), F.sha2("__text", 256).alias("__sha"), "__text")
    classes = (
        keyed.groupBy("__hash", "__sha", "__text")
        .agg(F.min("__id").alias("__keep"), F.count(F.lit(1)).alias("__n"))
        .groupBy("__hash", "__sha")
        .agg(F.min("__keep").alias("__keep"), F.sum("__n").alias("__n"), F.count(F.lit(1)).alias("__texts"))
        .select(
            "__hash",
            "__sha",
            "__keep",
            F.when(F.col("__texts") == 1, F.col("__n"))
            .otherwise(F.raise_error(F.lit("two texts share both digests")).cast("long"))
            .alias("__n"),
        )
        .where("__n > 1")
    )
    groups = saved(classes, "groups")
    alone = F.col("__n").isNull()
    return keyed.drop("__text").join(groups, ["__hash", "__sha"], "left").select(
        F.col("__id").alias(id_col),
        F.when(alone, F.col("__id")).otherwise(F.col("__keep")).alias("keep_id"),
        F.coalesce("__n", F.lit(1)).cast("long").alias("group_size"),
        (alone | F.col("__id").eqNullSafe(F.col("__keep"))).alias("kept"),
        F.col("__sha").alias("text_sha256"),
    )


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    kept = exact_dedup(docs, id_col, text_col).where("kept").select(F.col(id_col).alias("__kept_id")).distinct()
    return docs.join(kept, docs[id_col].eqNullSafe(F.col("__kept_id")), "left_semi")
