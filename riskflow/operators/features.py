"""Feature groups and the feature table. Every function takes and returns DataFrames and runs no job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.constants import (
    AGE_LABELS,
    CLICK_HORIZONS,
    CREDIT_MIXES,
    DELAY_HORIZONS,
    KEYS,
    LIMIT_HORIZONS,
    LOAN_TYPES,
    PAYMENT_BEHAVIOURS,
    UNKNOWN,
)
from riskflow.functions import scalars as S
from riskflow.operators.cleaning import fill_numeric
from riskflow.operators.ordered import first_rows
from riskflow.operators.pit import History, asof_join, lookback

LATEST_FINANCIALS = (
    "Annual_Income",
    "Outstanding_Debt",
    "Payment_Behaviour",
    "Credit_Mix",
    "Type_of_Loan",
    "Credit_History_Age",
    "Num_of_Loan",
)


# ---- column groups ----


def capacity(income: str = "Annual_Income", debt: str = "Outstanding_Debt") -> dict[str, Column]:
    return {
        "DTI": S.ratio(debt, income),
        "log_Annual_Income": S.log_income(income),
        "income_band": S.income_band(income),
    }


def exposure(
    amount: str = "loan_amt",
    income: str = "Annual_Income",
    debt: str = "Outstanding_Debt",
    emi: str | None = None,
    overdue: str | None = None,
    tenure: str | None = None,
) -> dict[str, Column]:
    """Ratios of the loan to income, debt service and overdue amount."""
    out = {"Loan_to_Income": S.ratio(amount, income)}
    if emi:
        out["Credit_Utilization"] = S.ratio(debt, emi)
    if overdue:
        out["overdue_ratio"] = S.ratio(overdue, amount)
    if tenure:
        out["avg_instalment"] = S.ratio(amount, tenure)
    return out


def behaviour() -> dict[str, Column]:
    return {
        **S.one_hot("Payment_Behaviour", PAYMENT_BEHAVIOURS, "Payment_Behaviour"),
        **S.one_hot("Credit_Mix", CREDIT_MIXES, "Credit_Mix"),
        **S.multi_hot("Type_of_Loan", LOAN_TYPES, "Type_of_Loan"),
        "loan_type_count": S.list_size("Type_of_Loan"),
    }


def credit_depth() -> dict[str, Column]:
    return {
        "Credit_History_Age_Year": S.duration_part("Credit_History_Age", "Years"),
        "Credit_History_Age_Month": S.duration_part("Credit_History_Age", "Months"),
    }


def age_flags(age: str = "Age", zero_is_unknown: bool = False) -> dict[str, Column]:
    band = S.age_band(age, zero_is_unknown)
    return S.one_hot(band, [*AGE_LABELS, UNKNOWN], "age_band")


def request_features(amount: str = "loan_amt", tenure: str = "tenure", income: str = "Annual_Income") -> dict[str, Column]:
    payment = S.instalment(amount, tenure)
    return {
        "estimated_EMI": payment,
        "EMI_to_income": F.when(F.col(income) > 0, payment / (F.col(income) / 12)),
        "requested_amount": F.col(amount),
        "requested_tenure": F.col(tenure),
    }


def top_values(df: DataFrame, column: str, k: int) -> DataFrame:
    """The k most frequent values (ties by value)."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .count()
        .orderBy(F.desc("count"), F.asc(column))
        .limit(k)
    )


def one_hot_top(df: DataFrame, column: str, k: int = 15, prefix: str | None = None) -> DataFrame:
    """One flag per value among the k most frequent ones. The k values are read to name the columns."""
    values = [r[0] for r in top_values(df, column, k).collect()]
    return df.withColumns(S.one_hot(column, values, prefix or column))


# ---- dated groups ----


def _delay_columns(delayed: str) -> dict[str, Column]:
    worst = F.coalesce(F.col(f"{delayed}_max_12m"), F.lit(0))
    return {
        **{f"Num_of_Delayed_Payment_{h}": F.coalesce(F.col(f"{delayed}_sum_{h}"), F.lit(0)) for h in DELAY_HORIZONS},
        "max_dpd_prior": worst,
        "ever_30dpd_prior": S.flag(worst >= 30),
    }


def _limit_columns(changed: str) -> dict[str, Column]:
    return {
        **{f"Changed_Credit_Limit_sum_{h}": F.col(f"{changed}_sum_{h}") for h in LIMIT_HORIZONS},
        **{f"count_credit_limit_changes_{h}": F.col(f"{changed}_count_{h}") for h in LIMIT_HORIZONS},
    }


def financial_windows(
    financials: DataFrame,
    applications: DataFrame,
    *,
    delayed: str | None = "Num_of_Delayed_Payment",
    changed: str | None = None,
    key: str = "Customer_ID",
    app_date: str = "application_date",
    **options,
) -> DataFrame:
    """Delayed payments over 90, 180 and 365 days, the highest count in a year and whether it reached 30; sum
    and number of credit-limit changes over 90 and 180 days. Both from the same pass."""
    stats: dict[str, tuple[str, ...]] = {}
    outputs: dict[str, Column] = {}
    if delayed:
        stats[delayed] = ("sum", "max")
        outputs |= _delay_columns(delayed)
    if changed:
        financials = financials.withColumn(changed, F.nullif(F.col(changed), F.lit(0).cast("double")))
        stats[changed] = ("sum", "count")
        outputs |= _limit_columns(changed)
    horizons = DELAY_HORIZONS if delayed else LIMIT_HORIZONS
    found = lookback(financials, applications, stats, horizons, key=key, app_date=app_date, **options)
    return found.select(key, app_date, *[c.alias(name) for name, c in outputs.items()])


def delinquency(financials: DataFrame, applications: DataFrame, **options) -> DataFrame:
    return financial_windows(financials, applications, **options)


def limit_changes(
    financials: DataFrame, applications: DataFrame, *, changed: str = "Changed_Credit_Limit", **options
) -> DataFrame:
    return financial_windows(financials, applications, delayed=None, changed=changed, **options)


def days_since(app_date: str, event_date: str) -> Column:
    return F.datediff(app_date, event_date)


def click_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith("fe_")]


def clickstream(
    clicks: DataFrame, applications: DataFrame, *, fill: float | None = 0, strict: bool = False, unique: bool = False, **names
) -> DataFrame:
    """Sum, mean and standard deviation of every fe_ column over 7 and 30 days."""
    stats = {c: ("sum", "mean", "std") for c in click_columns(clicks)}
    return lookback(clicks, applications, stats, CLICK_HORIZONS, fill=fill, strict=strict, unique=unique, **names)


def click_totals(clicks: DataFrame, applications: DataFrame, *, unique: bool = False, **names) -> DataFrame:
    """Sum of every fe_ column over the whole history up to the application."""
    running = {f"{c}_sum_all": ("sum", c) for c in click_columns(clicks)}
    return asof_join(applications, [History(clicks, running=running, unique=unique)], **names)


# ---- the feature table ----


def build_features(
    applications: DataFrame,
    financials: DataFrame | None = None,
    attributes: DataFrame | None = None,
    clicks: DataFrame | None = None,
    *,
    strict: bool = False,
    top_occupations: Sequence[str] = (),
    fill: bool = True,
) -> DataFrame:
    """One feature row per (Customer_ID, application_date).

    The cleaned tables have one row per (customer, snapshot), so nothing is folded again. The newest rows of
    financials and attributes come from one time line; the look-backs are joined on (customer, date). A
    missing table leaves its features out.
    """
    newest_first = [F.col(c).desc_nulls_last() for c in applications.columns if c not in ("Customer_ID", "application_date")]
    features = first_rows(applications, ["Customer_ID", "application_date"], newest_first or [F.lit(1)])

    histories = []
    if financials is not None:
        late = F.when(F.col("Num_of_Delayed_Payment") > 0, F.col("snapshot_date"))
        histories.append(
            History(
                financials.withColumn("__late", late),
                latest=LATEST_FINANCIALS,
                running={"__last_delay": ("max", "__late")},
                unique=True,
            )
        )
    if attributes is not None:
        if "age_clean" not in attributes.columns:
            attributes = attributes.withColumn("age_clean", S.plausible_age("Age"))
        histories.append(History(attributes, latest=("Age", "age_clean", "Occupation"), unique=True))
    if histories:
        features = asof_join(features, histories, strict=strict, applications_unique=True)

    grain = ["Customer_ID", "application_date"]
    added: dict[str, Column] = {}
    spent: list[str] = []
    zero_when_absent: list[str] = []
    if financials is not None:
        changed = "Changed_Credit_Limit" if "Changed_Credit_Limit" in financials.columns else None
        windows = financial_windows(financials, applications, changed=changed, strict=strict, unique=True)
        features = features.join(windows, grain, "left")
        zero_when_absent += [c for c in windows.columns if c not in grain]
        added |= capacity() | behaviour() | credit_depth() | exposure()
        added |= {
            "Num_of_Loan_active": F.col("Num_of_Loan"),
            "time_since_last_delay": days_since("application_date", "__last_delay"),
        }
        added |= request_features()
        spent += ["Payment_Behaviour", "Credit_Mix", "Type_of_Loan", "Credit_History_Age", "Num_of_Loan", "__last_delay"]
    else:
        added |= {"estimated_EMI": S.instalment("loan_amt", "tenure")}
        added |= {"requested_amount": F.col("loan_amt"), "requested_tenure": F.col("tenure")}
    if attributes is not None:
        added |= age_flags("age_clean") | S.one_hot("Occupation", top_occupations, "Occupation")
        spent += ["Occupation", "age_clean"]
    if clicks is not None:
        features = features.join(clickstream(clicks, applications, strict=strict, unique=True), grain, "left")

    features = features.withColumns(added).drop(*spent)
    if zero_when_absent:
        features = features.fillna(0, subset=zero_when_absent)
    features = features.withColumn("snapshot_date", F.col("application_date"))
    # No delay so far is not a delay today: this column keeps its null.
    return fill_numeric(features, 0, [*KEYS, "time_since_last_delay"]) if fill else features
