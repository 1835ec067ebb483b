"""Default labels and their progression over the life of a loan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.constants import DPD_THRESHOLD
from riskflow.functions import scalars as S
from riskflow.operators.ordered import quantiles_of_counts


def definition(dpd: int, mob: int) -> str:
    """The name under which labels of one definition are stored."""
    return f"{dpd}dpd_{mob}mob"


def snapshot_labels(
    loans: DataFrame, dpd: int = DPD_THRESHOLD, mob: int = 1, keys: Sequence[str] = ("loan_id", "Customer_ID", "snapshot_date")
) -> DataFrame:
    """Label of every loan in the month it reaches ``mob``."""
    return loans.where(F.col("mob") == mob).select(
        *keys, S.flag(F.col("dpd") >= dpd).alias("label"), F.lit(definition(dpd, mob)).alias("label_def")
    )


def ever_default_labels(
    applications: DataFrame,
    loans: DataFrame,
    dpd: int = DPD_THRESHOLD,
    mob: int = 0,
    *,
    key: str = "loan_id",
    keep: Sequence[str] = ("Customer_ID", "application_date"),
) -> DataFrame:
    """1 if the loan was ever that late at or after ``mob``; loans without such a row are 0."""
    bad = loans.groupBy(key).agg(F.max(S.flag((F.col("mob") >= mob) & (F.col("dpd") >= dpd))).alias("__bad"))
    return (
        applications.select(key, *keep)
        .distinct()
        .join(bad, key, "left")
        .select(key, *keep, F.coalesce("__bad", F.lit(0)).alias("label"))
    )


def worst_dpd_labels(
    loans: DataFrame, dpd: int = DPD_THRESHOLD, mob: int = 6, keys: Sequence[str] = ("loan_id", "Customer_ID")
) -> DataFrame:
    """Label from the highest dpd at or after ``mob``; null if dpd was never known."""
    worst = loans.where(F.col("mob") >= mob).groupBy(*keys).agg(F.max("dpd").alias("max_dpd"))
    return worst.withColumn("label", (F.col("max_dpd") >= dpd).cast("int"))


def vintage_curve(loans: DataFrame, started_before: str | None = None, dpd: int = DPD_THRESHOLD) -> DataFrame:
    """Share of late rows by month on book, for loans started before a date."""
    if started_before:
        loans = loans.where(F.col("loan_start_date") < F.lit(started_before).cast("date"))
    return loans.groupBy("mob").agg(
        F.avg(S.flag(F.col("dpd") >= dpd)).alias("bad_rate"), F.count(F.lit(1)).alias("n_rows")
    )


def dpd_progression(loans: DataFrame, dpd: int = DPD_THRESHOLD, key: str = "loan_id") -> DataFrame:
    """By month on book: mean and median of the worst dpd per loan, loans that late, default rate in percent."""
    worst = loans.where(F.col("mob").isNotNull()).groupBy(key, "mob").agg(F.max("dpd").alias("value"))
    counts = worst.groupBy("mob", "value").agg(F.count(F.lit(1)).alias("n"))
    n, dpd_days = F.col("n"), F.col("value")
    stats = counts.groupBy("mob").agg(
        (F.sum(n * dpd_days) / F.sum(F.when(dpd_days.isNotNull(), n))).alias("mean_dpd"),
        F.sum(F.when(dpd_days >= dpd, n).otherwise(0)).alias("loans_late"),
        F.sum(n).alias("total_loans"),
    )
    middle = quantiles_of_counts(counts.where("value IS NOT NULL"), {"median_dpd": 0.5}, ["mob"])
    return stats.join(middle, "mob", "left").withColumn(
        "default_rate", F.round(F.col("loans_late") / F.col("total_loans") * 100, 2)
    )


def mob_summary(loans: DataFrame, key: str = "loan_id") -> DataFrame:
    """By month on book: rows, mean overdue amount and balance, rows with any delay."""
    return loans.groupBy("mob").agg(
        F.count(key).alias("loan_count"),
        F.round(F.avg("overdue_amt"), 2).alias("avg_overdue"),
        *([F.round(F.avg("balance"), 2).alias("avg_balance")] if "balance" in loans.columns else []),
        F.count_if(F.col("dpd") > 0).alias("loans_with_dpd"),
    )


def dpd_threshold_counts(loans: DataFrame, thresholds: Sequence[int] = (30, 60, 90)) -> DataFrame:
    """One row: rows that are current and rows at or above each threshold, with their share in percent."""
    tests = {"current": F.col("dpd") == 0, **{f"dpd_{t}_plus": F.col("dpd") >= t for t in thresholds}}
    return loans.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(test).alias(f"n_{name}") for name, test in tests.items()],
        *[F.round(F.avg(S.flag(test)) * 100, 1).alias(f"pct_{name}") for name, test in tests.items()],
    )
