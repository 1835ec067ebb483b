"""Raw snapshots to typed, deduplicated ones."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType, NumericType, StringType, StructType

from riskflow.constants import LOAN_TYPES, PAYMENT_BEHAVIOURS
from riskflow.functions import scalars as S
from riskflow.operators.ordered import first_rows, wide_as_long



# ---- schema ----


def require_columns(df: DataFrame, columns: Sequence[str], table: str = "table") -> DataFrame:
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"{table} lacks columns: {', '.join(missing)}")
    return df


def columns_by_kind(df: DataFrame, exclude: Sequence[str] = ()) -> tuple[list[str], list[str]]:
    """Names of numeric columns and of text columns, keys excluded."""
    fields = [f for f in df.schema.fields if f.name not in exclude]
    numeric = [f.name for f in fields if isinstance(f.dataType, NumericType)]
    text = [f.name for f in fields if isinstance(f.dataType, StringType)]
    return numeric, text


def enforce_schema(df: DataFrame, schema: StructType, keep_extra: bool = False) -> DataFrame:
    """Cast to the declared types: dirty numbers are stripped first, what cannot be read becomes null,
    absent columns become null. One projection. Undeclared columns are left out unless ``keep_extra``."""
    have = {f.name: f.dataType for f in df.schema.fields}
    out: list[Column] = []
    for f in schema.fields:
        if f.name not in have:
            value = F.lit(None)
        elif isinstance(have[f.name], StringType) and isinstance(f.dataType, NumericType):
            value = S.dirty_number(f.name)
        else:
            value = F.col(f.name)
        out.append(value.try_cast(f.dataType).alias(f.name))
    if keep_extra:
        declared = set(schema.fieldNames())
        out += [F.col(c) for c in df.columns if c not in declared]
    return df.select(*out)


def floats_to_doubles(df: DataFrame) -> DataFrame:
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, FloatType)]
    return df.withColumns({c: F.col(c).cast("double") for c in floats}) if floats else df


# ---- numeric sweep ----


@dataclass(frozen=True)
class Cast:
    column: str
    target: str  # bigint or double


#: What a text column may hold, in the order in which types move up: nothing, whole numbers, numbers, text.
LATTICE = ("void", "bigint", "double", "string")


def numeric_profile(df: DataFrame, exclude: Sequence[str] = ("Customer_ID", "snapshot_date"), by: Sequence[str] = ()) -> DataFrame:
    """For every text column (of every group of ``by``): rows, rows that hold anything, rows that hold a number once stripped, share,
    whether all are whole, largest magnitude. One aggregate over the table for all columns together."""
    _, columns = columns_by_kind(df, [*exclude, *by])
    aggregates: list[Column] = [F.count(F.lit(1)).alias("n_rows")]
    fields: dict[str, dict[str, str]] = {}
    numbers = df.select(*by, *[x for i, c in enumerate(columns) for x in (S.dirty_number(c).alias(f"x{i}"), F.col(c).isNotNull().alias(f"k{i}"))])
    for i, c in enumerate(columns):
        x = F.col(f"x{i}")
        aggregates += [
            F.count_if(f"k{i}").alias(f"k{i}"),
            F.count(x).alias(f"n{i}"),
            F.coalesce(F.max(F.abs(x - F.floor(x))), F.lit(0.0)).alias(f"f{i}"),
            F.max(F.abs(x)).alias(f"m{i}"),
        ]
        fields[c] = {"n_rows": "n_rows", "n_known": f"k{i}", "n_numeric": f"n{i}", "max_fraction": f"f{i}", "max_size": f"m{i}"}
    if not fields:
        none = "column string, n_rows bigint, n_known bigint, n_numeric bigint, max_fraction double, max_size double, share double"
        keys = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in df.select(*by).schema.fields)
        return df.sparkSession.createDataFrame([], keys + none)
    wide = numbers.groupBy(*by).agg(*aggregates) if by else numbers.agg(*aggregates)
    return wide_as_long(wide, fields, keep=by).withColumn("share", F.when(F.col("n_rows") > 0, F.col("n_numeric") / F.col("n_rows")))


def column_types(profile: DataFrame, threshold: float = 0.9) -> DataFrame:
    """The profile's rows as ``column``, its groups and ``type``, one of ``LATTICE``. Whole numbers are bigint whatever their size."""
    kind = (
        F.when(F.col("n_known") == 0, "void")
        .when(F.col("share") < threshold, "string")
        .when(F.col("max_fraction") > 0, "double")
        .otherwise("bigint")
    )
    measures = ("n_rows", "n_known", "n_numeric", "max_fraction", "max_size", "share")
    return profile.select(*[c for c in profile.columns if c not in measures], kind.alias("type"))


def merged_types(types: DataFrame) -> DataFrame:
    """(column, type): the highest type that any group has, so that more data can only move a column up."""
    rank = F.array_position(F.array(*[F.lit(t) for t in LATTICE]), F.col("type"))
    names = F.array(*[F.lit(t) for t in LATTICE])
    return types.groupBy("column").agg(F.element_at(names, F.max(rank).cast("int")).alias("type"))


def type_drift(types: DataFrame, partition: str = "snapshot_date") -> DataFrame:
    """(column, partition, type, merged type) where a partition alone would give another type than all of them."""
    merged = merged_types(types).withColumnRenamed("type", "merged_type")
    return types.join(F.broadcast(merged), "column").where("type <> merged_type").select("column", partition, "type", "merged_type")


def casts_of(types: DataFrame) -> list[Cast]:
    """Columns to cast, from one row per column."""
    return [Cast(r.column, r.type) for r in types.where(F.col("type").isin("bigint", "double")).orderBy("column").collect()]


def cast_plan(profile: DataFrame, threshold: float = 0.9) -> list[Cast]:
    """Columns to cast, from a profile (one row per text column)."""
    return casts_of(column_types(profile, threshold))


def apply_casts(df: DataFrame, plan: Sequence[Cast]) -> DataFrame:
    """Cast in place: order and names of the columns stay as they are."""
    targets = {c.column: c.target for c in plan}
    return df.select(*[S.dirty_number(c).try_cast(targets[c]).alias(c) if c in targets else F.col(c) for c in df.columns])


def sweep_numeric(
    df: DataFrame, exclude: Sequence[str] = ("Customer_ID", "snapshot_date"), threshold: float = 0.9
) -> DataFrame:
    return apply_casts(df, cast_plan(numeric_profile(df, exclude), threshold))


# ---- rows ----

LINEAGE = ("ingested_at", "source_file")


def keep_one_per_grain(df: DataFrame, keys: Sequence[str], latest_by: Sequence[str] | None = None) -> DataFrame:
    """One row per key. The highest ``latest_by`` wins, then the highest values of the other columns, so the
    survivor does not depend on the order of the files. By default that is the newest delivery, where the rows tell."""
    latest_by = [c for c in LINEAGE if c in df.columns] if latest_by is None else latest_by
    rest = [c for c in df.columns if c not in keys and c not in latest_by]
    order = [F.col(c).desc_nulls_last() for c in [*latest_by, *rest]] or [F.lit(1)]
    return first_rows(df, keys, order)


def key_quality(df: DataFrame, key: str = "Customer_ID") -> DataFrame:
    """One row: rows, rows without key, distinct keys."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col(key).isNull()).alias("n_null_keys"),
        F.countDistinct(key).alias("n_keys"),
    )


def with_asof_date(df: DataFrame) -> DataFrame:
    return df.withColumn("asof_date", F.col("snapshot_date"))


def drop_personal_data(df: DataFrame, columns: Sequence[str] = ("Name", "SSN")) -> DataFrame:
    return df.drop(*columns)


# ---- null policies ----


def fill_numeric(df: DataFrame, value: float = 0, exclude: Sequence[str] = ()) -> DataFrame:
    numeric, _ = columns_by_kind(df, exclude)
    return df.fillna(value, subset=numeric) if numeric else df


# ---- tables ----


def loan_delinquency(
    loans: DataFrame,
    *,
    installment: str | None = "installment_num",
    due: str = "due_amt",
    overdue: str = "overdue_amt",
    date: str = "snapshot_date",
) -> DataFrame:
    """Add mob, installments_missed, first_missed_date and dpd. Without a due amount the last three are null;
    with nothing missed dpd is 0 and there is no first missed date."""
    missed = F.ceil(S.ratio(overdue, due)).cast("int")
    first = F.when(F.col("installments_missed") > 0, F.add_months(date, -F.col("installments_missed")))
    out = loans.withColumns(
        {**({"mob": F.col(installment)} if installment else {}), "installments_missed": missed}
    ).withColumn("first_missed_date", first)
    late = F.when(F.col("installments_missed") <= 0, F.lit(0)).otherwise(F.datediff(date, "first_missed_date"))
    return out.withColumn("dpd", late.cast("int"))


def clean_loans(raw: DataFrame, schema: StructType, keys: Sequence[str]) -> DataFrame:
    typed = keep_one_per_grain(enforce_schema(raw, schema, keep_extra=True), keys)
    return with_asof_date(loan_delinquency(typed))


def clean_clickstream(raw: DataFrame, schema: StructType, keys: Sequence[str]) -> DataFrame:
    return with_asof_date(keep_one_per_grain(enforce_schema(raw, schema, keep_extra=True), keys))


def clean_attributes(raw: DataFrame, schema: StructType, keys: Sequence[str]) -> DataFrame:
    typed = drop_personal_data(keep_one_per_grain(enforce_schema(raw, schema, keep_extra=True), keys))
    return with_asof_date(
        typed.withColumns(
            {
                "age_clean": S.plausible_age("Age"),
                "age_invalid_flag": S.flag(S.plausible_age("Age", 18, 100).isNull()),
                "is_occu_known": S.is_known("Occupation"),
            }
        )
    )


def clean_financials(raw: DataFrame, schema: StructType, keys: Sequence[str]) -> DataFrame:
    typed = keep_one_per_grain(enforce_schema(raw, schema, keep_extra=True), keys)
    return with_asof_date(
        typed.withColumns(
            {
                "Payment_Behaviour": S.normalise_category("Payment_Behaviour", PAYMENT_BEHAVIOURS),
                "Credit_History_Age_Year": S.duration_part("Credit_History_Age", "Years").cast("double"),
                "Credit_History_Age_Month": S.duration_part("Credit_History_Age", "Months"),
                "DTI": S.ratio("Outstanding_Debt", "Annual_Income"),
                **S.list_hot("Type_of_Loan", LOAN_TYPES, "loan_type__"),
                "loan_type_count": S.list_size("Type_of_Loan"),
            }
        )
    )


CLEANERS = {
    "lms_loan_daily": clean_loans,
    "feature_clickstream": clean_clickstream,
    "features_attributes": clean_attributes,
    "features_financials": clean_financials,
}


def invalid_categories(df: DataFrame, allowed: Mapping[str, Sequence[str]]) -> DataFrame:
    """Per column: rows outside the allowed values."""
    wide = df.agg(*[F.count_if(~F.col(c).isin(list(v)) | F.col(c).isNull()).alias(c) for c, v in allowed.items()])
    return wide_as_long(wide, {c: {"n_invalid": c} for c in allowed})
