"""Profiles of a table that are kept per partition and merged, so that a new month is the only one read again.

``partition_profiles`` gives one row per partition and column: counts, moments of numbers and a sketch of the distinct
values. ``merge_profiles`` adds such rows up, over the whole store or any part of it. ``value_counts_of`` is the exact
form: one row per partition, column and value, from which distinct values and the most frequent ones follow.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from riskflow.functions import scalars as S
from riskflow.operators.ordered import wide_as_long

LG_K = 12  # a sketch has 2^12 registers: one standard error is below 1.6 %


def sketch_error(lg_k: int = LG_K) -> float:
    """Relative standard error of a sketch, or of any union of sketches, for large counts."""
    return 1.04 / 2 ** (lg_k / 2)


def partition_profiles(df: DataFrame, by: Sequence[str], columns: Sequence[str] | None = None, lg_k: int = LG_K) -> DataFrame:
    """(by, column, n_rows, missing_count, n_numbers, mean, m2, low, high, sketch), from one aggregate by partition.

    ``m2`` is the sum of squared deviations from the mean. NaN is a value but no number; columns of other types have no
    numbers. Values are told apart by 64-bit hashes of their text: sketches pass over empty texts themselves. An empty table has no profile.
    """
    columns = [c for c in (columns or df.columns) if c not in by]
    numeric = {f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)}
    empty = F.lit(None).cast("double")
    outputs: list[Column] = [F.count(F.lit(1)).alias("n")]
    fields: dict[str, dict[str, str]] = {}
    for i, c in enumerate(columns):
        x = F.nanvl(F.col(c).cast("double"), empty) if c in numeric else empty
        parts = {
            "missing_count": F.count_if(F.col(c).isNull()),
            "n_numbers": F.count(x),
            "mean": F.avg(x),
            "m2": F.var_pop(x) * F.count(x),
            "low": F.min(x),
            "high": F.max(x),
            "sketch": F.hll_sketch_agg(F.when(F.col(c).isNotNull(), F.xxhash64(F.col(c).cast("string"))), lg_k),
        }
        outputs += [part.alias(f"{name}{i}") for name, part in parts.items()]
        fields[c] = {"n_rows": "n", **{name: f"{name}{i}" for name in parts}}
    return wide_as_long(df.groupBy(*by).agg(*outputs), fields, keep=by)


def merge_profiles(profiles: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Profiles of several partitions as one per (by, column), in the same form. Merging in steps gives the same counts and
    moments as merging at once; estimates of a sketch depend on the order of unions, within its error. Deviations are added around the common mean, not as differences of squares."""
    group = [*by, "column"]
    whole = Window.partitionBy(*group)
    total = F.sum("n_numbers").over(whole)
    common = F.sum(F.col("n_numbers") * F.col("mean")).over(whole) / F.nullif(total, F.lit(0))
    off = F.col("mean") - F.col("common")
    return (
        profiles.withColumn("common", common)
        .groupBy(*group)
        .agg(
            F.sum("n_rows").alias("n_rows"),
            F.sum("missing_count").alias("missing_count"),
            F.sum("n_numbers").alias("n_numbers"),
            F.first("common", ignorenulls=True).alias("mean"),
            F.sum(F.col("m2") + F.col("n_numbers") * off * off).alias("m2"),
            F.min("low").alias("low"),
            F.max("high").alias("high"),
            F.hll_union_agg("sketch").alias("sketch"),
        )
    )


def read_profile(merged: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by, column, n_rows, missing_count, missing_pct, mean, std, min, max, approx_distinct) of merged profiles."""
    n = F.col("n_numbers")
    return merged.select(
        *by,
        "column",
        "n_rows",
        "missing_count",
        (S.ratio("missing_count", "n_rows") * 100).alias("missing_pct"),
        "mean",
        F.when(n > 1, F.sqrt(F.col("m2") / (n - 1))).alias("std"),
        F.col("low").alias("min"),
        F.col("high").alias("max"),
        F.hll_sketch_estimate("sketch").alias("approx_distinct"),
    )


def store_completeness(merged: DataFrame) -> DataFrame:
    """One row for a whole store: rows, columns, share of null cells."""
    cells = F.sum("n_rows")
    return merged.agg(
        F.max("n_rows").alias("n_rows"),
        F.count(F.lit(1)).alias("n_columns"),
        (F.sum("missing_count") / F.nullif(cells, F.lit(0))).alias("null_share"),
    )


def value_counts_of(df: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """(by, column, value, n): rows per known value, as text. Counted before the shuffle, once for all columns."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    long = df.select(*by, F.inline(pairs)).where("value IS NOT NULL")
    return long.groupBy(*by, "column", "value").agg(F.count(F.lit(1)).alias("n"))


def exact_distinct(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by, column, n_distinct, top_value, top_n, n_repeated): distinct values, the most frequent one (ties: the smallest) and
    how many values occur more than once, from the value counts of any partitions."""
    once = counts.groupBy(*by, "column", "value").agg(F.sum("n").alias("n"))
    most = F.min(F.struct((-F.col("n")).alias("minus"), "value"))
    found = once.groupBy(*by, "column").agg(F.count(F.lit(1)).alias("n_distinct"), most.alias("most"), F.count_if(F.col("n") > 1).alias("n_repeated"))
    return found.select(*by, "column", "n_distinct", F.col("most.value").alias("top_value"), (-F.col("most.minus")).alias("top_n"), "n_repeated")
