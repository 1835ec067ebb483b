"""What later applications may still ask of a history, kept per customer and merged with each new month.

A state holds a history up to a day in a shorter form: the rows within the longest look-back, the newest row of each
customer, the newest row that meets a condition, and totals over everything. For every application after that day, the
state and the rows since give the same features as the whole history. ``merge`` needs no older row, and merging in
steps gives the same state as merging at once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskflow.constants import CLICK_HORIZONS, DELAY_HORIZONS
from riskflow.functions import scalars as S
from riskflow.operators.features import LATEST_FINANCIALS
from riskflow.schemas import CLICK_COLUMNS
from riskflow.sources.sinks import write_snapshots
from riskflow.sources.tables import at_snapshot, read_table, stored_dates

BUCKETS = 64  # of a stored state; the number must stay the same for all of its days
BUCKET, THROUGH = "bucket", "through"


@dataclass(frozen=True)
class Kept:
    """days: look-back that may still be asked. newest: whether the newest row of each customer stays. last_where: condition
    whose newest row stays. columns: what is kept of a row (none: all). derived: columns to compute first. total: whether
    one row per customer holds the sum of each column instead of single rows."""

    days: int = 0
    newest: bool = True
    last_where: str | None = None
    columns: Sequence[str] = ()
    derived: Mapping[str, Column] | None = None
    total: bool = False


def bucket(key: str = "Customer_ID", buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int").alias(BUCKET)


def _rows(history: DataFrame, kept: Kept, key: str, day: str) -> DataFrame:
    for name, column in (kept.derived or {}).items():
        history = history if name in history.columns else history.withColumn(name, column)
    named = [c for c in kept.columns or history.columns if c in history.columns and c not in (key, day, BUCKET)]
    return history.select(key, F.col(day).cast("date").alias(day), *named).where(F.col(key).isNotNull() & F.col(day).isNotNull())


def merge(
    state: DataFrame | None,
    new: DataFrame,
    kept: Kept,
    through: date | str,
    *,
    key: str = "Customer_ID",
    day: str = "snapshot_date",
    buckets: int = BUCKETS,
) -> DataFrame:
    """The state through a day: what is still needed of the state before and of the rows since, by ``bucket``.

    Rows after ``through`` are left out, so are rows without customer or day. Rows are dealt by customer, as a bucket has
    ever more of them; both newest rows come from one window. A total is dated ``through``, so that it precedes every later application.
    """
    end = F.lit(through).cast("date")
    rows = _rows(new, kept, key, day).where(F.col(day) <= end)
    if kept.total:
        sums = [c for c in rows.columns if c not in (key, day)]
        both = rows if state is None else rows.unionByName(state.select(key, day, *sums), allowMissingColumns=True)
        return both.groupBy(key).agg(*[F.sum(c).alias(c) for c in sums]).select(key, end.alias(day), *sums, bucket(key, buckets))
    both = rows if state is None else rows.unionByName(state.drop(BUCKET), allowMissingColumns=True)
    both = both.select("*", bucket(key, buckets))
    customer = Window.partitionBy(BUCKET, key)
    wanted = F.col(day) > F.date_sub(end, kept.days)
    if kept.newest:
        wanted |= F.col(day) == F.max(day).over(customer)
    if kept.last_where:
        wanted |= F.col(day) == F.max(F.when(F.expr(kept.last_where), F.col(day))).over(customer)
    return both.withColumn("__wanted", F.coalesce(wanted, F.lit(False))).where("__wanted").drop("__wanted")


def history(state: DataFrame | None, since: DataFrame, kept: Kept, through: date | str | None, upto: date | str, *, key: str = "Customer_ID", day: str = "snapshot_date") -> DataFrame:
    """A history that answers all applications after ``through`` and up to ``upto`` as the whole one would."""
    rows = _rows(since, kept, key, day).where(F.col(day) <= F.lit(upto).cast("date"))
    if state is None:
        return rows
    rows = rows.where(F.col(day) > F.lit(through).cast("date"))
    return rows.unionByName(state.drop(BUCKET), allowMissingColumns=True)


def write_state(state: DataFrame, root: str, through: date | str) -> str:
    """One folder per day and bucket, a large one written by several tasks; the states of other days stay."""
    return write_snapshots(state.withColumn(THROUGH, F.lit(through).cast("date")), root, [THROUGH, BUCKET])


def read_state(spark: SparkSession, root: str, through: date | str | None) -> DataFrame | None:
    """The stored state of a day; no other day is read."""
    return None if through is None else at_snapshot(read_table(spark, root), through, THROUGH).drop(THROUGH)


def newest_state(spark: SparkSession, root: str, before: date) -> date | None:
    """The newest stored day before a day, by the names of the folders."""
    return max((d for d in stored_dates(spark, root, THROUGH) if d < before), default=None)


def of_customers(state: DataFrame, requests: DataFrame, key: str = "Customer_ID", buckets: int = BUCKETS) -> DataFrame:
    """The state of the customers of some requests. Only their buckets are read: at most ``buckets`` numbers reach the driver."""
    wanted = [r[0] for r in requests.where(F.col(key).isNotNull()).select(bucket(key, buckets)).distinct().collect()]
    return state.where(F.col(BUCKET).isin(wanted) if wanted else F.lit(False)).join(requests.select(key).distinct(), key, "left_semi")


def feature_states() -> dict[str, Kept]:
    """What the feature table needs of each source."""
    return {
        "features_financials": Kept(
            days=max(DELAY_HORIZONS.values()),
            last_where="Num_of_Delayed_Payment > 0",
            columns=(*LATEST_FINANCIALS, "Num_of_Delayed_Payment", "Changed_Credit_Limit"),
        ),
        "features_attributes": Kept(columns=("Age", "age_clean", "Occupation"), derived={"age_clean": S.plausible_age("Age")}),
        "feature_clickstream": Kept(days=max(CLICK_HORIZONS.values()), newest=False, columns=CLICK_COLUMNS),
    }
