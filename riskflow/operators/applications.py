"""The application store: who asked for a loan on which day."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from riskflow.constants import REQUEST_AMOUNT, REQUEST_TENURE
from riskflow.operators.ordered import first_rows
from riskflow.schemas import APPLICATIONS


def application_store(
    loans: DataFrame,
    dates: Sequence[date | str] | None = None,
    *,
    key: str = "Customer_ID",
    start: str = "loan_start_date",
    amount: int = REQUEST_AMOUNT,
    tenure: int = REQUEST_TENURE,
) -> DataFrame:
    """One application per (customer, loan start), with the standard request; optionally only some dates."""
    starts = loans.select(key, F.col(start).try_cast("date").alias("application_date")).dropna(
        subset=["application_date"]
    )
    if dates is not None:
        starts = starts.where(F.col("application_date").isin([F.lit(d).cast("date") for d in dates]))
    return starts.distinct().withColumns({"loan_amt": F.lit(amount), "tenure": F.lit(tenure)})


def select_dates(
    applications: DataFrame, choice: str = "latest", first: str | None = None, last: str | None = None
) -> DataFrame:
    """``latest`` keeps the newest date, ``all`` everything, ``range`` the dates from first to last, and a
    date itself only that date."""
    day = F.col("application_date")
    if choice == "all":
        return applications
    if choice == "latest":
        return applications.where(day == applications.select(F.max("application_date")).scalar())
    if choice == "range":
        return applications.where(day.between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    return applications.where(day == F.lit(choice).cast("date"))


def training_applications(
    loans: DataFrame, asof: str | None = None, *, columns: Sequence[str] = ("loan_id", "Customer_ID", "loan_amt", "tenure")
) -> DataFrame:
    """Distinct loans with their request, started on or before a date."""
    out = loans.select(*columns, F.col("loan_start_date").alias("application_date")).distinct()
    return out.where(F.col("application_date") <= F.lit(asof).cast("date")) if asof else out


def first_snapshots(
    loans: DataFrame,
    asof: str | None = None,
    *,
    key: str = "loan_id",
    tie: Sequence[str] = (),
    date_column: str = "snapshot_date",
) -> DataFrame:
    """First snapshot of every loan."""
    out = first_rows(loans, [key], [F.col(date_column).asc_nulls_last(), *[F.col(c).asc_nulls_last() for c in tie]])
    return out.where(F.col("loan_start_date") <= F.lit(asof).cast("date")) if asof else out


def requests(spark: SparkSession, rows: Sequence[tuple], schema: StructType = APPLICATIONS) -> DataFrame:
    """Application rows passed by a caller: (customer, date[, amount, tenure])."""
    full = [
        (r[0], date.fromisoformat(r[1]) if isinstance(r[1], str) else r[1], *(r[2:] or (REQUEST_AMOUNT, REQUEST_TENURE)))
        for r in rows
    ]
    return spark.createDataFrame(full, schema)
