"""Data-quality and exploration tables."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskflow.functions import scalars as S
from riskflow.operators.ordered import exact_quantiles, one_row, wide_as_long

QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}


# ---- completeness ----


def missing_summary(df: DataFrame, columns: Sequence[str] | None = None, only_missing: bool = False) -> DataFrame:
    """Null count and percentage of every column, from one aggregate."""
    columns = list(columns or df.columns)
    wide = df.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(c).isNull()).alias(f"m{i}") for i, c in enumerate(columns)])
    long = wide_as_long(wide, {c: {"n_rows": "n", "missing_count": f"m{i}"} for i, c in enumerate(columns)})
    out = long.select(
        "column",
        "missing_count",
        F.when(F.col("n_rows") > 0, F.col("missing_count") * 100 / F.col("n_rows")).alias("missing_pct"),
    )
    return out.where("missing_count > 0") if only_missing else out


def data_quality(df: DataFrame, key: str) -> DataFrame:
    """One row: rows, columns, duplicate rows, distinct keys, rows per key. Equal rows are folded first."""
    rows = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__n"))
    out = rows.agg(
        F.sum("__n").alias("n_rows"),
        F.sum(F.col("__n") - 1).alias("duplicate_rows"),
        F.countDistinct(key).alias("n_keys"),
    )
    return out.withColumns({"n_columns": F.lit(len(df.columns)), "rows_per_key": S.ratio("n_rows", "n_keys")})


def duplicate_groups(df: DataFrame, keys: Sequence[str], more_than: int = 1) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > more_than)


def store_quality(df: DataFrame, label: str | None = None) -> DataFrame:
    """Completeness of a store in one row: rows, share of null cells, labels outside 0/1."""
    nulls = F.lit(0)
    for c in df.columns:
        nulls = nulls + F.col(c).isNull().cast("int")
    outputs = [
        F.count(F.lit(1)).alias("n_rows"),
        (F.sum(nulls) / F.nullif(F.count(F.lit(1)) * len(df.columns), F.lit(0))).alias("null_share"),
    ]
    if label:
        outputs.append(F.count_if(F.col(label).isNull() | ~F.col(label).isin(0, 1)).alias("invalid_labels"))
    return df.agg(*outputs)


def schema_differences(frames: Mapping[str, DataFrame]) -> list[tuple[str, str, str, str]]:
    """(column, partition, type there, type in the first partition) for every column that differs."""
    names = list(frames)
    first = {f.name: f.dataType.simpleString() for f in frames[names[0]].schema.fields}
    out = []
    for name in names[1:]:
        here = {f.name: f.dataType.simpleString() for f in frames[name].schema.fields}
        for c in sorted(first.keys() | here.keys()):
            if first.get(c) != here.get(c):
                out.append((c, name, here.get(c, "absent"), first.get(c, "absent")))
    return out


def schema_table(spark: SparkSession, frames: Mapping[str, DataFrame]) -> DataFrame:
    """(column, partition, type, common_type, differs): the type of every column in every partition (``absent`` where it has
    none) beside the one that most partitions have, ties by name. Only schemas are read."""
    types = {name: {f.name: f.dataType.simpleString() for f in df.schema.fields} for name, df in frames.items()}
    columns = sorted({c for t in types.values() for c in t})
    rows = []
    for c in columns:
        here = {name: t.get(c, "absent") for name, t in types.items()}
        common = min(here.values(), key=lambda t: (-list(here.values()).count(t), t))
        rows += [(c, name, t, common, t != common) for name, t in here.items()]
    return spark.createDataFrame(rows, "column string, partition string, type string, common_type string, differs boolean")


# ---- customers over tables ----


def coverage(frames: Mapping[str, DataFrame], key: str) -> DataFrame:
    """One row per key of any table, with a flag per table. One shuffle for all tables."""
    tagged = None
    for name, df in frames.items():
        part = df.select(key, *[F.lit(int(n == name)).alias(n) for n in frames]).where(F.col(key).isNotNull())
        tagged = part if tagged is None else tagged.unionByName(part)
    return tagged.groupBy(key).agg(*[F.max(n).alias(n) for n in frames])


def common_keys(frames: Mapping[str, DataFrame], key: str) -> DataFrame:
    """Keys that occur in all tables."""
    everywhere = coverage(frames, key)
    for name in frames:
        everywhere = everywhere.where(F.col(name) == 1)
    return everywhere.select(key)


# ---- time ----


def rows_per_date(df: DataFrame, date: str = "snapshot_date") -> DataFrame:
    return df.groupBy(date).agg(F.count(F.lit(1)).alias("n_rows"))


def date_span(df: DataFrame, date: str = "snapshot_date") -> DataFrame:
    return df.agg(
        F.min(date).alias("first_date"), F.max(date).alias("last_date"), F.countDistinct(date).alias("n_dates")
    )


# ---- distributions ----


def value_counts(df: DataFrame, column: str, keep_null: bool = False, top: int | None = None) -> DataFrame:
    rows = df if keep_null else df.where(F.col(column).isNotNull())
    counts = rows.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.asc_nulls_last(column))
    return counts.limit(top) if top else counts


def top_categories(df: DataFrame, columns: Sequence[str], k: int = 10) -> DataFrame:
    """The k most frequent values of each column, nulls included. The long list of values is cut to k per task
    before it is shuffled by column."""
    long = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot([], list(columns), "column", "value")
    counts = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    window = Window.partitionBy("column").orderBy(F.desc("n"), F.asc_nulls_last("value"))
    return counts.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)


def describe(df: DataFrame, columns: Sequence[str], groups: Sequence[str] = ()) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles and maximum, one row per (groups, column)."""
    stats = {"n": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    known = df.select(*groups, *[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(c) for c in columns])
    wide = known.groupBy(*groups).agg(
        *[f(c).alias(f"{name}{i}") for i, c in enumerate(columns) for name, f in stats.items()]
    )
    fields = {c: {name: f"{name}{i}" for name in stats} for i, c in enumerate(columns)}
    moments = wide_as_long(wide, fields, keep=groups)
    return moments.join(exact_quantiles(df, columns, QUARTILES, groups), [*groups, "column"], "left")


def distinct_counts(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """Number of distinct non-null values of every column."""
    count = F.approx_count_distinct if approximate else F.countDistinct
    wide = df.agg(*[count(F.col(c)).alias(f"d{i}") for i, c in enumerate(columns)])
    return wide_as_long(wide, {c: {"n_distinct": f"d{i}"} for i, c in enumerate(columns)})


def histogram(df: DataFrame, column: str, bins: int = 50, low: float | None = None, high: float | None = None) -> DataFrame:
    """Rows per equal-width bin between the smallest and the largest value, the last bin closed."""
    x = F.col(column).cast("double")
    kept = df.where(x.isNotNull() & ~F.isnan(x))
    span = one_row(kept.agg(F.min(x).alias("lo"), F.max(x).alias("hi"))) if low is None or high is None else None
    lo = span["lo"] if low is None else F.lit(float(low))
    hi = span["hi"] if high is None else F.lit(float(high))
    if low is not None or high is not None:
        kept = kept.where(x.between(lo, hi))
    slot = F.when(hi > lo, F.least(F.floor((x - lo) / (hi - lo) * bins), F.lit(bins - 1))).otherwise(0)
    return kept.groupBy(slot.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def quantile_bounds(df: DataFrame, column: str, low: float = 0.01, high: float = 0.99) -> DataFrame:
    """One row: the two exact quantiles."""
    return exact_quantiles(df, [column], {"low": low, "high": high}).select("low", "high")


def clip_to_quantiles(df: DataFrame, column: str, low: float = 0.01, high: float = 0.99) -> DataFrame:
    bounds = one_row(quantile_bounds(df, column, low, high))
    return df.withColumn(column, S.clip(F.col(column).cast("double"), bounds["low"], bounds["high"]))


def interval_counts(df: DataFrame, column: str, edges: Sequence[float], labels: Sequence[str]) -> DataFrame:
    """Rows per right-closed interval, outside values left out."""
    band = S.interval_label(column, edges, labels).alias("band")
    return df.groupBy(band).agg(F.count(F.lit(1)).alias("n")).where("band IS NOT NULL")


# ---- relation to the label ----


def rate_by(df: DataFrame, by: Column | str, label: str = "label") -> DataFrame:
    """Rows, mean label and default rate in percent per category."""
    category = (F.col(by) if isinstance(by, str) else by).alias("category")
    return (
        df.groupBy(category)
        .agg(F.count(label).alias("n"), F.avg(label).alias("mean_label"))
        .withColumn("default_rate", F.round(F.col("mean_label") * 100, 2))
    )


def correlation(a: str, b: str) -> Column:
    """Pearson correlation over the rows where both are known; null if one of them does not vary (the native
    function divides by zero there)."""
    x, y = F.col(a).cast("double"), F.col(b).cast("double")
    spread = F.stddev_pop(F.when(y.isNotNull(), x)) * F.stddev_pop(F.when(x.isNotNull(), y))
    return F.when(spread > 0, F.covar_pop(x, y) / spread)


def correlation_with(df: DataFrame, label: str, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every column with the label, from one aggregate."""
    wide = df.agg(*[correlation(c, label).alias(f"r{i}") for i, c in enumerate(columns)])
    return wide_as_long(wide, {c: {"corr": f"r{i}"} for i, c in enumerate(columns)}, "feature")


def top_correlated(correlations: DataFrame, k: int = 20) -> DataFrame:
    return correlations.where("corr IS NOT NULL").orderBy(F.abs("corr").desc(), F.asc("feature")).limit(k)


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Correlation of every pair of columns (each pair once) over the rows where both are known; null and NaN are not.

    The plan does not grow with the number of pairs: each task adds up the moments of its rows as matrix products, shifted
    by the columns' means, and sends one row per pair; Spark adds these.
    """
    columns = list(columns)
    wide = df.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(columns)])
    known = wide.agg(*[F.avg(F.when(~F.isnan(c), F.col(c))).alias(c) for c in wide.columns]).first()
    means = np.array([0.0 if m is None else m for m in known])
    first, second = np.triu_indices(len(columns))

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((4, len(columns), len(columns)))
        for batch in batches:
            x = np.column_stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(len(columns))]) - means
            there = (~np.isnan(x)).astype(float)
            x = np.nan_to_num(x, nan=0.0)
            total += np.stack([there.T @ there, x.T @ there, (x * x).T @ there, x.T @ x])
        n, s, q, p = total
        a, b = first, second
        sums = [n[a, b], s[a, b], s[b, a], q[a, b], q[b, a], p[a, b]]
        yield pa.RecordBatch.from_arrays([pa.array(v) for v in (a, b, *sums)], names=["a", "b", "n", "sa", "sb", "qa", "qb", "p"])

    parts = wide.mapInArrow(moments, "a long, b long, n double, sa double, sb double, qa double, qb double, p double")
    sums = parts.groupBy("a", "b").agg(*[F.sum(c).alias(c) for c in ("n", "sa", "sb", "qa", "qb", "p")])
    spread = lambda s, q: F.col(q) - F.col(s) * F.col(s) / F.col("n")
    both = F.sqrt(spread("sa", "qa")) * F.sqrt(spread("sb", "qb"))
    some = F.least(spread("sa", "qa") / F.col("qa"), spread("sb", "qb") / F.col("qb")) > 1e-12  # else constant, but for rounding
    names = F.array(*map(F.lit, columns))
    return sums.select(
        F.get(names, F.col("a").cast("int")).alias("col_a"),
        F.get(names, F.col("b").cast("int")).alias("col_b"),
        F.when((F.col("n") > 0) & (F.col("qa") > 0) & (F.col("qb") > 0) & some, (F.col("p") - F.col("sa") * F.col("sb") / F.col("n")) / both).alias("corr"),
    )


def class_balance(df: DataFrame, label: str = "label", low: float = 0.1, high: float = 0.9) -> DataFrame:
    """One row: rows, default rate, whether it is below ``low`` or above ``high``."""
    return df.agg(F.count(label).alias("n"), F.avg(label).alias("default_rate")).withColumn(
        "imbalanced", (F.col("default_rate") < low) | (F.col("default_rate") > high)
    )


# ---- risk flags ----


def payment_flags(due: str = "due_amt", paid: str = "paid_amt", overdue: str = "overdue_amt") -> dict[str, Column]:
    share = F.try_divide(F.col(paid).cast("double"), F.col(due).cast("double"))
    late = F.col(overdue) > 0
    return {
        "has_overdue": F.coalesce(late, F.lit(False)),
        "payment_ratio": share,
        "potential_default": F.coalesce(late, F.lit(False)) | F.coalesce(share < 0.5, F.lit(False)),
    }


def high_risk(
    mix: str = "Credit_Mix", delay: str = "Delay_from_due_date", use: str = "Credit_Utilization_Ratio"
) -> Column:
    tests = [F.col(mix) == "Bad", F.col(delay) > 30, F.col(use) > 80]
    out = F.lit(False)
    for test in tests:
        out = out | F.coalesce(test, F.lit(False))
    return out


# ---- leakage ----


def leakage_counts(
    features: DataFrame,
    applications: DataFrame,
    *,
    key: str = "Customer_ID",
    date: str = "snapshot_date",
    app_date: str = "application_date",
) -> DataFrame:
    """Pairs of feature row and application of one customer by how their dates compare: feature on the same
    day, after it, before it. Rows without customer form no pair. Pairs are counted from running totals per day, never built."""
    f = features.groupBy(key, F.col(date).cast("date").alias("day")).agg(F.count(F.lit(1)).alias("n_f"))
    a = applications.groupBy(key, F.col(app_date).cast("date").alias("day")).agg(F.count(F.lit(1)).alias("n_a"))
    days = f.unionByName(a, allowMissingColumns=True).groupBy(key, "day").agg(
        F.coalesce(F.sum("n_f"), F.lit(0)).alias("n_f"), F.coalesce(F.sum("n_a"), F.lit(0)).alias("n_a")
    )
    customer = Window.partitionBy(key)
    upto = customer.orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen, all_f = F.sum("n_f").over(upto), F.sum("n_f").over(customer)
    pairs = days.where(F.col("day").isNotNull() & F.col(key).isNotNull()).select(
        (F.col("n_a") * F.col("n_f")).alias("same"),
        (F.col("n_a") * (seen - F.col("n_f"))).alias("before"),
        (F.col("n_a") * (all_f - seen)).alias("after"),
    )
    return pairs.agg(
        F.coalesce(F.sum("same"), F.lit(0)).alias("pairs_same_day"),
        F.coalesce(F.sum("before"), F.lit(0)).alias("pairs_before"),
        F.coalesce(F.sum("after"), F.lit(0)).alias("pairs_after"),
    )


def same_day_rows(
    features: DataFrame,
    applications: DataFrame,
    *,
    key: str = "Customer_ID",
    date: str = "snapshot_date",
    app_date: str = "application_date",
) -> DataFrame:
    """Feature rows taken on the day of an application of the same customer."""
    days = applications.select(key, F.col(app_date).alias(date)).distinct()
    return features.join(days, [key, date], "left_semi")
