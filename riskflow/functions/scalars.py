"""Column expressions. All are built from native functions, so they stay inside generated code, and all
are safe under ANSI mode: text that is no number and a zero denominator give null, never an error."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskflow.constants import (
    AGE_CUTS,
    AGE_LABELS,
    ANNUAL_RATE,
    BAD_TOKENS,
    EXPONENT,
    INCOME_CUTS,
    INCOME_LABELS,
    UNKNOWN,
)


def _col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ---- numbers ----


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Quotient where the denominator is positive, else null."""
    return F.when(_col(denominator) > 0, _col(numerator) / _col(denominator))


def clip(x: Column | str, low=None, high=None) -> Column:
    """Limit to [low, high]; null stays null."""
    out = _col(x)
    kept = out
    if low is not None:
        out = F.greatest(out, low if isinstance(low, Column) else F.lit(low))
    if high is not None:
        out = F.least(out, high if isinstance(high, Column) else F.lit(high))
    return F.when(kept.isNotNull(), out)


def finite(x: Column | str) -> Column:
    """Infinity and NaN become null."""
    x = _col(x).cast("double")
    bad = F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    return F.when(~bad, x)


def row_sum(columns: Sequence[str]) -> Column:
    """Sum over columns of one row; null counts as zero."""
    return reduce(add, [F.coalesce(F.col(c), F.lit(0)) for c in columns])


def dirty_number(x: Column | str) -> Column:
    """Number left in a text once everything but digits, sign and point is removed. What is a number in exponent form once
    currency signs, separators and other stray marks are gone is read as that."""
    text = F.trim(_col(x).cast("string"))
    bare = F.trim(F.regexp_replace(text, r"[^0-9A-Za-z.+\- ]+", ""))
    kept = F.trim(F.regexp_replace(text, r"[^0-9.\-]+", ""))
    return F.when(bare.rlike(EXPONENT), finite(bare.try_cast("double"))).otherwise(F.nullif(kept, F.lit("")).try_cast("double"))


def log_income(income: Column | str) -> Column:
    income = _col(income)
    return F.when(income > 0, F.log(income))


def instalment(amount: Column | str, tenure: Column | str, annual_rate: float = ANNUAL_RATE) -> Column:
    """Level monthly payment of an annuity loan; null unless the tenure is positive."""
    rate = annual_rate / 12
    grown = F.pow(F.lit(1 + rate), _col(tenure))
    return F.when(_col(tenure) > 0, _col(amount) * rate * grown / (grown - 1))


# ---- bands and flags ----


def slug(text: str) -> str:
    """Text as part of a column name."""
    return text.replace(" ", "_").replace("-", "_").replace("+", "")


def cut_label(x: Column | str, cuts: Sequence[float], labels: Sequence[str], missing: str | None = None) -> Column:
    """Left-closed bands: the first label is below ``cuts[0]``, the last one from ``cuts[-1]`` up."""
    x = _col(x)
    out = F.when(x.isNull(), F.lit(missing))
    for edge, label in zip(cuts, labels):
        out = out.when(x < edge, F.lit(label))
    return out.otherwise(F.lit(labels[-1]))


def interval_label(x: Column | str, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Right-closed bands ``(edges[i], edges[i+1]]``; null outside all of them."""
    x = _col(x)
    out = F.when(x <= edges[0], F.lit(None).cast("string"))
    for edge, label in zip(edges[1:], labels):
        out = out.when(x <= edge, F.lit(label))
    return out


def age_band(age: Column | str, zero_is_unknown: bool = False) -> Column:
    age = _col(age)
    if zero_is_unknown:
        age = F.when(age != 0, age)
    return cut_label(age, AGE_CUTS, AGE_LABELS, UNKNOWN)


def income_band(income: Column | str) -> Column:
    return cut_label(income, INCOME_CUTS, INCOME_LABELS)


def flag(condition: Column) -> Column:
    """1 where the condition holds, else 0 (also for null)."""
    return F.when(condition, 1).otherwise(0)


def one_hot(x: Column | str, values: Sequence[str], prefix: str) -> dict[str, Column]:
    return {f"{prefix}_{slug(v)}": flag(_col(x) == v) for v in values}


def multi_hot(x: Column | str, values: Sequence[str], prefix: str) -> dict[str, Column]:
    """One flag per value that occurs anywhere in the text."""
    return {f"{prefix}_{slug(v)}": flag(_col(x).contains(v)) for v in values}


# ---- lists encoded as comma-separated text ----


def list_items(x: Column | str) -> Column:
    """Distinct trimmed items of "A, B, and C"; null for null."""
    items = F.split(_col(x), r",\s*(?:and\s+)?")
    return F.array_distinct(F.filter(F.transform(items, lambda i: F.trim(i)), lambda i: F.length(i) > 0))


def list_hot(x: Column | str, values: Sequence[str], prefix: str) -> dict[str, Column]:
    """One flag per value that is an item of the list (whole items, not substrings)."""
    return {f"{prefix}{slug(v).replace('_', '')}": flag(F.array_contains(list_items(x), v)) for v in values}


def list_size(x: Column | str) -> Column:
    return F.coalesce(F.size(list_items(x)), F.lit(0))


# ---- text ----


def normalise_category(x: Column | str, allowed: Sequence[str] = (), bad: Sequence[str] = BAD_TOKENS) -> Column:
    """Trimmed category, or "Unknown" for anything missing, meaningless or not in the list of allowed ones."""
    text = F.trim(_col(x))
    if allowed:
        good = text.isin(list(allowed))
    else:
        good = (F.length(text) > 0) & ~F.lower(text).isin(list(bad)) & text.rlike("^[A-Za-z_]+$")
    return F.when(good, text).otherwise(F.lit(UNKNOWN))


def duration_part(x: Column | str, unit: str) -> Column:
    """Whole number in front of a unit, as in "22 Years and 1 Months"; null if the unit is absent."""
    digits = F.regexp_extract(_col(x), rf"(\d+)\s*{unit}", 1)
    return F.nullif(digits, F.lit("")).try_cast("int")


def is_known(x: Column | str) -> Column:
    """0 for null, blank or any spelling of "unknown", else 1."""
    text = F.trim(_col(x))
    return flag((F.length(text) > 0) & ~text.rlike("(?i)^unknown$"))


# ---- ages ----


def plausible_age(age: Column | str, low: int = 18, high: int = 85) -> Column:
    return F.when(_col(age).between(low, high), _col(age))


def age_unit(age: Column | str) -> Column:
    """Which unit an age seems to be in. Days are tried before months."""
    a = _col(age)
    return (
        F.when(a.isNull(), "null")
        .when(a <= 0, "<=0")
        .when(a.between(18, 100), "18-100_ok")
        .when((a > 120) & (a / 365.25).between(15, 100), "looks_days")
        .when((a > 120) & (a / 12).between(15, 100), "looks_months")
        .when(a > 120, ">120_other")
        .otherwise("other")
    )
