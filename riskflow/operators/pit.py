"""Point-in-time operators: history as it was known on the day of an application.

Everything works at the grain of one row per (key, day). A key therefore contributes at most one row per
calendar day to any join or window, however many raw rows it has, and raw rows are folded into days with
map-side aggregation. Tables that already have that grain say so with ``unique=True`` and skip the fold.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_DAY = "__day"
_SIDE = "__side"


@dataclass(frozen=True)
class History:
    """What to take from one dated table.

    latest:  columns of the newest row
    running: output name -> (sum | max | min | count, column) over all rows so far
    tie:     columns that decide between rows of one day (highest wins); then the values themselves
    """

    df: DataFrame
    latest: Sequence[str] = ()
    running: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    date: str = "snapshot_date"
    date_as: str | None = None
    tie: Sequence[str] = ()
    unique: bool = False


_MERGE = {"sum": F.sum, "max": F.max, "min": F.min, "count": F.sum}
_FIRST = {"sum": F.sum, "max": F.max, "min": F.min, "count": F.count}


def _days(history: History, index: int, key: str) -> DataFrame:
    """One row per (key, day): newest row as a struct, partial states of the running aggregates."""
    row = F.struct(*[F.col(c) for c in history.tie], *[F.col(c) for c in history.latest if c not in history.tie])
    states = {f"__r{index}_{out}": spec for out, spec in history.running.items()}
    known = F.col(key).isNotNull() & F.col(history.date).isNotNull()  # rows without customer belong to nobody
    dated = history.df.where(known).withColumn(_DAY, F.col(history.date).cast("date"))
    if history.unique:
        return dated.select(
            key,
            _DAY,
            *([row.alias(f"__h{index}")] if history.latest else []),
            *[
                (F.col(c).isNotNull().cast("bigint") if func == "count" else F.col(c)).alias(name)
                for name, (func, c) in states.items()
            ],
        )
    return dated.groupBy(key, _DAY).agg(
        *([F.max(row).alias(f"__h{index}")] if history.latest else []),
        *[_FIRST[func](c).alias(name) for name, (func, c) in states.items()],
    )


def asof_join(
    applications: DataFrame,
    histories: Sequence[History],
    *,
    key: str = "Customer_ID",
    app_date: str = "application_date",
    strict: bool = False,
    applications_unique: bool = False,
) -> DataFrame:
    """Add to every application the newest row (and running aggregates) of each history on or before its
    date, or strictly before it. Applications without history, or without key, keep nulls.

    Applications and all histories go through one shuffle by key as a single time line; the newest value is
    carried forward by one window. There is no join of every history row with every application.
    """
    if applications_unique:
        payload = [c for c in applications.columns if c not in (key, app_date)]
        rows = applications.select(
            key, F.col(app_date).alias(_DAY), *([F.struct(*payload).alias("__app")] if payload else [])
        )
    else:
        payload = []
        rows = applications.select(key, F.col(app_date).alias(_DAY)).distinct()
    rows = rows.withColumn(_DAY, F.col(_DAY).cast("date"))

    app_side, history_side = (0, 1) if strict else (1, 0)
    line = rows.withColumn(_SIDE, F.lit(app_side))
    for i, history in enumerate(histories):
        line = line.unionByName(_days(history, i, key).withColumn(_SIDE, F.lit(history_side)), allowMissingColumns=True)

    so_far = (
        Window.partitionBy(key).orderBy(_DAY, _SIDE).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    carried: dict[str, Column] = {}
    for i, history in enumerate(histories):
        if history.latest:
            newest = F.when(F.col(f"__h{i}").isNotNull(), F.struct(F.col(_DAY).alias("day"), F.col(f"__h{i}").alias("row")))
            carried[f"__n{i}"] = F.last(newest, ignorenulls=True).over(so_far)
        for out, (func, _) in history.running.items():
            carried[out] = _MERGE[func](f"__r{i}_{out}").over(so_far)

    outputs: list[Column] = []
    for i, history in enumerate(histories):
        outputs += [F.col(f"__n{i}.row.{c}").alias(c) for c in history.latest]
        if history.date_as:
            outputs.append(F.col(f"__n{i}.day").alias(history.date_as))
        outputs += [F.col(out) for out in history.running]

    found = line.withColumns(carried).where(F.col(_SIDE) == app_side)
    if applications_unique:
        return found.select(key, F.col(_DAY).alias(app_date), *[F.col(f"__app.{c}") for c in payload], *outputs)
    found = found.select(key, F.col(_DAY).alias("__found_day"), *outputs)
    return (
        applications.withColumn("__found_day", F.col(app_date).cast("date"))
        .join(found, [key, "__found_day"], "left")
        .select(*applications.columns, *[c for c in found.columns if c not in (key, "__found_day")])
    )


def exact_date_join(
    applications: DataFrame,
    history: DataFrame,
    columns: Sequence[str],
    *,
    key: str = "Customer_ID",
    app_date: str = "application_date",
    date: str = "snapshot_date",
) -> DataFrame:
    """Values of the very day of the application; ``history`` has one row per (key, date)."""
    day = history.select(key, F.col(date).alias(app_date), *columns)
    return applications.join(day, [key, app_date], "left")


def _fold_days(history: DataFrame, key: str, wanted: Mapping[str, set[str]]) -> DataFrame:
    """One row per (key, day): count, sum, squared deviations and maximum of every column.

    Squares are taken around the mean of the key, so that the deviation of values that are large but close
    together is not lost to rounding.
    """
    states: list[Column] = []
    for c, stats in wanted.items():
        x = F.col(c)
        states += [F.count(x).alias(f"__n_{c}"), F.sum(x).alias(f"__s_{c}")]
        if "std" in stats:
            states.append((F.var_pop(x) * F.count(x)).alias(f"__q_{c}"))
        if "max" in stats:
            states.append(F.max(x).alias(f"__m_{c}"))
    days = history.groupBy(key, _DAY).agg(*states)
    spread = [c for c, stats in wanted.items() if "std" in stats]
    if not spread:
        return days
    whole = Window.partitionBy(key)
    days = days.withColumns(
        {
            f"__t_{c}": F.col(f"__s_{c}")
            - F.col(f"__n_{c}") * (F.sum(f"__s_{c}").over(whole) / F.nullif(F.sum(f"__n_{c}").over(whole), F.lit(0)))
            for c in spread
        }
    )
    return days.withColumns(
        {
            f"__q_{c}": F.when(
                F.col(f"__n_{c}") > 0, F.col(f"__q_{c}") + F.col(f"__t_{c}") * F.col(f"__t_{c}") / F.col(f"__n_{c}")
            )
            for c in spread
        }
    )


def _statistic(stat: str, c: str, within, folded: bool) -> Column:
    """Aggregate of one column; ``within`` limits an expression to a horizon."""
    if not folded:
        x = within(F.col(c))
        return {"sum": F.sum, "mean": F.avg, "std": F.stddev_samp, "max": F.max, "count": F.count}[stat](x)
    n, s = F.sum(within(F.col(f"__n_{c}"))), F.sum(within(F.col(f"__s_{c}")))
    if stat == "sum":
        return s
    if stat == "mean":
        return F.when(n > 0, s / n)
    if stat == "max":
        return F.max(within(F.col(f"__m_{c}")))
    if stat == "count":
        return F.coalesce(n, F.lit(0))
    q, t = F.sum(within(F.col(f"__q_{c}"))), F.sum(within(F.col(f"__t_{c}")))
    return F.when(n > 1, F.sqrt(F.greatest(q - t * t / n, F.lit(0.0)) / (n - 1)))


def lookback(
    history: DataFrame,
    applications: DataFrame,
    stats: Mapping[str, Sequence[str]],
    horizons: Mapping[str, int],
    *,
    key: str = "Customer_ID",
    app_date: str = "application_date",
    date: str = "snapshot_date",
    strict: bool = False,
    unique: bool = False,
    fill: float | None = None,
) -> DataFrame:
    """Aggregates over the last days before each application, all horizons in one pass.

    ``stats``: column -> some of sum, mean, std, max, count. ``horizons``: label -> days. ``fill`` replaces
    null values before they are aggregated. Output: one row per (key, app_date) with at least one history
    row in the longest horizon, columns ``<column>_<stat>_<label>``.

    The join key is (key, span of days), spans being as long as the longest horizon: an application day
    looks into at most two spans, and one long-lived key is spread over all of its spans.
    """
    longest = max(horizons.values())
    width = longest + 1
    columns = list(stats)
    values = {c: F.col(c) if fill is None else F.coalesce(F.col(c), F.lit(fill)) for c in columns}
    rows = history.where(F.col(date).isNotNull()).select(
        key, F.col(date).cast("date").alias(_DAY), *[v.alias(c) for c, v in values.items()]
    )
    days = rows if unique else _fold_days(rows, key, {c: set(s) for c, s in stats.items()})
    days = days.withColumn("__span", F.floor(F.unix_date(_DAY) / width))
    last = F.unix_date("__app_day")
    app_days = (
        applications.select(key, F.col(app_date).cast("date").alias("__app_day"))
        .where(F.col("__app_day").isNotNull())
        .distinct()
        .withColumn(
            "__span",
            F.explode(F.array_distinct(F.array(F.floor((last - longest) / width), F.floor(last / width)))),
        )
    )
    lag = F.datediff("__app_day", _DAY)
    pairs = (
        app_days.alias("a")
        .join(
            days.alias("h"),
            (F.col(f"a.{key}") == F.col(f"h.{key}"))
            & (F.col("a.__span") == F.col("h.__span"))
            & lag.between(1 if strict else 0, longest),
        )
        .select(
            F.col(f"a.{key}").alias(key),
            "__app_day",
            lag.alias("__lag"),
            *[F.col(f"h.{c}") for c in days.columns if c not in (key, _DAY, "__span")],
        )
    )

    def within(label: str):
        if horizons[label] == longest:
            return lambda x: x
        return lambda x: F.when(F.col("__lag") <= horizons[label], x)

    aggregates = [
        _statistic(stat, c, within(label), not unique).alias(f"{c}_{stat}_{label}")
        for label in horizons
        for c in columns
        for stat in stats[c]
    ]
    return pairs.groupBy(key, F.col("__app_day").alias(app_date)).agg(*aggregates)
