"""From stores to training data: time windows, exact stratified split, imputation, scaling, selection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskflow.constants import KEYS, OOT_MONTHS, SPLIT_SEED, TRAIN_RATIO, TRAIN_TEST_MONTHS
from riskflow.functions import scalars as S
from riskflow.operators.cleaning import columns_by_kind
from riskflow.operators.ordered import exact_quantiles, one_row, wide_as_long


# ---- time ----


def months_before(day: date, months: int) -> date:
    """Same day some months earlier, or the last day of that month."""
    index = day.year * 12 + day.month - 1 - months
    year, month = divmod(index, 12)
    following = date(year + (month + 1) // 12, (month + 1) % 12 + 1, 1)
    last = (following - timedelta(days=1)).day
    return date(year, month + 1, min(day.day, last))


@dataclass(frozen=True)
class TimeSplit:
    train_test_start: date
    train_test_end: date
    oot_start: date
    oot_end: date


def time_split(train_date: date | str, train_test_months: int = TRAIN_TEST_MONTHS, oot_months: int = OOT_MONTHS) -> TimeSplit:
    """Out-of-time window just before the training date, train/test window just before that."""
    day = date.fromisoformat(train_date) if isinstance(train_date, str) else train_date
    oot_start = months_before(day, oot_months)
    return TimeSplit(
        months_before(oot_start, train_test_months), oot_start - timedelta(days=1), oot_start, day - timedelta(days=1)
    )


def tag_time_split(df: DataFrame, split: TimeSplit, column: str = "snapshot_date") -> DataFrame:
    """Rows of both windows with a ``period`` column: oot or train_test."""
    day = F.col(column)
    inside = df.where(day.between(F.lit(split.train_test_start), F.lit(split.oot_end)))
    return inside.withColumn("period", F.when(day >= F.lit(split.oot_start), "oot").otherwise("train_test"))


def assemble(
    labels: DataFrame, features: DataFrame, on: Sequence[str] = ("Customer_ID", "snapshot_date"), label: str = "label"
) -> DataFrame:
    """Labels joined with feature rows. Columns that both sides have, other than the keys, come from features."""
    kept = [c for c in labels.columns if c in on or c == label or c not in features.columns]
    return labels.select(*kept).join(features, list(on), "inner")


def feature_columns(df: DataFrame, extra: Sequence[str] = ("label", "label_def", "period", "split")) -> list[str]:
    return columns_by_kind(df, [*KEYS, *extra])[0]


# ---- exact stratified split ----


def stratified_split(
    df: DataFrame,
    label: str,
    key: str,
    ratio: float = TRAIN_RATIO,
    seed: int = SPLIT_SEED,
    strata: Sequence[int] = (0, 1),
    column: str = "split",
) -> DataFrame:
    """Add train/test so that each class has exactly floor(ratio * n) training rows. Rows of no class have no split.

    Rows are ordered by a hash of their key (``key`` is unique). Counting rows per hash prefix finds, for each
    class, the prefix in which the quota is reached; within it a longer prefix is found the same way, and only the
    rows with that one, one in 16 million, are ranked. The result is one cut-off per class, at most
    ``len(strata)`` rows, which is broadcast. The table itself is not shuffled.
    """
    tagged = df.withColumn("__hash", F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed)))))
    known = tagged.where(F.col(label).isin(list(strata))).select(label, "__hash", F.col(key).alias("__key"))
    known = known.withColumns({"__p1": F.substring("__hash", 1, 3), "__p2": F.substring("__hash", 4, 3)})
    whole = Window.partitionBy(label)

    def edge(sizes: DataFrame, prefix: str, quota: Column) -> DataFrame:
        """Per class: the prefix in which the quota is reached, and how many of its rows are needed."""
        upto = whole.orderBy(prefix).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return (
            sizes.withColumns({"__quota": quota, "__upto": F.sum("__n").over(upto)})
            .where("__upto >= __quota AND __upto - __n < __quota")
            .select(label, prefix, (F.col("__quota") - F.col("__upto") + F.col("__n")).alias("__take"))
        )

    count = F.count(F.lit(1)).alias("__n")
    share = F.floor(F.lit(float(ratio)) * F.sum("__n").over(whole))
    outer = edge(known.groupBy(label, "__p1").agg(count), "__p1", share)
    near = known.join(F.broadcast(outer), [label, "__p1"]).repartition(label, "__p2")
    inner = edge(near.groupBy(label, "__p2").agg(count, F.max("__take").alias("__take")), "__p2", F.max("__take").over(whole))
    order = whole.orderBy("__hash", "__key")
    cut = (
        near.drop("__take")
        .join(F.broadcast(inner), [label, "__p2"])
        .withColumn("__rank", F.row_number().over(order))
        .where("__rank = __take")
        .select(label, F.col("__hash").alias("__cut_hash"), F.col("__key").alias("__cut_key"))
    )
    first = (F.col("__hash") < F.col("__cut_hash")) | (
        (F.col("__hash") == F.col("__cut_hash")) & (F.col(key) <= F.col("__cut_key"))
    )
    return (
        tagged.join(F.broadcast(cut), label, "left")
        .withColumn(column, F.when(first, "train").when(F.col(label).isin(list(strata)), "test"))
        .select(*df.columns, column)
    )


def split_stats(df: DataFrame, split: str = "split", label: str = "label") -> DataFrame:
    return df.groupBy(split).agg(F.count(F.lit(1)).alias("n_rows"), F.round(F.avg(label), 2).alias("mean_label"))


# ---- imputation and scaling ----


def impute_median(df: DataFrame, columns: Sequence[str], fitted_on: DataFrame | None = None) -> DataFrame:
    """Infinite and missing values become the exact median of the finite values."""
    cleaned = df.withColumns({c: S.finite(c) for c in columns})
    source = cleaned if fitted_on is None else fitted_on.withColumns({c: S.finite(c) for c in columns})
    medians = exact_quantiles(source, columns, {"median": 0.5})
    wide = one_row(medians.agg(*[F.max(F.when(F.col("column") == c, F.col("median"))).alias(c) for c in columns]))
    return cleaned.withColumns({c: F.coalesce(F.col(c), wide[c]) for c in columns})


def standardise(df: DataFrame, columns: Sequence[str], fitted_on: DataFrame | None = None) -> DataFrame:
    """Zero mean and unit population deviation, fitted on one table and applied to another. Columns without
    spread are only centred."""
    source = df if fitted_on is None else fitted_on
    fitted = one_row(
        source.agg(
            *[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)],
            *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(columns)],
        )
    )

    def scaled(i: int, c: str) -> Column:
        mean, spread = fitted[f"m{i}"], fitted[f"s{i}"]
        return (F.col(c) - mean) / F.when(spread > 0, spread).otherwise(1.0)

    return df.withColumns({c: scaled(i, c) for i, c in enumerate(columns)})


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """One row: class sizes, negatives per positive, balanced weight of each class."""
    n, pos = F.col("n"), F.col("n_pos")
    return df.agg(F.count(label).alias("n"), F.count_if(F.col(label) == 1).alias("n_pos")).withColumns(
        {
            "imbalance_ratio": S.ratio(n - pos, pos),
            "weight_neg": S.ratio(n, 2 * (n - pos)),
            "weight_pos": S.ratio(n, 2 * pos),
        }
    )


def add_class_weight(df: DataFrame, label: str = "label", column: str = "weight") -> DataFrame:
    w = one_row(class_weights(df, label))
    return df.withColumn(column, F.when(F.col(label) == 1, w["weight_pos"]).otherwise(w["weight_neg"]))


# ---- selection ----


def missing_rates(df: DataFrame, columns: Sequence[str], limit: float = 0.5) -> DataFrame:
    """Share of nulls per feature, and whether it is low enough to keep."""
    wide = df.agg(*[F.avg(F.col(c).isNull().cast("int")).alias(f"r{i}") for i, c in enumerate(columns)])
    long = wide_as_long(wide, {c: {"missing_rate": f"r{i}"} for i, c in enumerate(columns)}, "feature")
    return long.withColumn("keep", F.col("missing_rate") < limit)


def constant_features(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Whether a feature has at most one distinct value: minimum equals maximum, so no distinct count."""
    wide = df.agg(
        *[F.min(c).cast("double").alias(f"lo{i}") for i, c in enumerate(columns)],
        *[F.max(c).cast("double").alias(f"hi{i}") for i, c in enumerate(columns)],
    )
    long = wide_as_long(wide, {c: {"low": f"lo{i}", "high": f"hi{i}"} for i, c in enumerate(columns)}, "feature")
    return long.select("feature", F.coalesce(F.col("low") == F.col("high"), F.lit(True)).alias("is_constant"))


def rename_collisions(left: DataFrame, right: DataFrame, on: Sequence[str], suffixes: tuple[str, str]) -> tuple[DataFrame, DataFrame]:
    """Give columns that both sides have (other than the keys) a suffix on each side."""
    shared = [c for c in left.columns if c in right.columns and c not in on]

    def mapped(suffix: str) -> Mapping[str, str]:
        return {c: c + suffix for c in shared}

    return left.withColumnsRenamed(mapped(suffixes[0])), right.withColumnsRenamed(mapped(suffixes[1]))
