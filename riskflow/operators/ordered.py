"""Running totals, exact quantiles and top rows over an order that may be very long.

A window over a whole group would sort that group in one task. Here the rows are first cut into ranges of the order
at points that Spark samples from the rows themselves, so that no distribution of values makes one range large, and written
with the number of their range. A range that still is too large is cut again until none is. Totals per range are few
and are summed by short windows; only the rows of one range are ever sorted together. What is written says which range a row
is in, so a task that is repeated finds the same ones.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskflow.session import scratch_dir

_PART = "__part"
_FROM = "__from"
ROWS_PER_PART = 1_000_000
MOST_CUTS = 8  # rows of one key and value, which nothing can cut, end the cutting


def cut_order(df: DataFrame, columns: Sequence[str], rows_per_part: int = ROWS_PER_PART) -> DataFrame:
    """The rows, written once, with a number ``__part`` of the range of the order that they are in: equal numbers are
    neighbours in the order by ``columns``, and no range has over twice ``rows_per_part`` rows.

    Only the numbers of ranges that have too many rows reach the driver; only their rows are written again.
    """
    spark = df.sparkSession
    folder, done = scratch_dir(spark, "order"), []
    rows, n = df.withColumn(_PART, F.lit("")), None
    for level in range(MOST_CUTS):
        cut = rows.repartitionByRange(*([n] if n else []), _PART, *columns)
        path = f"{folder}/{level}"
        cut.withColumn(_PART, F.concat_ws(".", _PART, F.spark_partition_id())).write.parquet(path)
        rows = spark.read.schema(rows.schema).parquet(path)
        large = rows.groupBy(_PART).count().where(F.col("count") > 2 * rows_per_part).collect()
        if not large:
            return reduce(DataFrame.unionByName, [*done, rows])
        is_large = F.col(_PART).isin([r[0] for r in large])
        done.append(rows.where(~is_large))
        rows, n = rows.where(is_large), sum(-(-r["count"] // rows_per_part) for r in large)
    return reduce(DataFrame.unionByName, [*done, rows])


def cumulate(
    df: DataFrame,
    order: str,
    measures: Sequence[str],
    groups: Sequence[str] = (),
    descending: bool = False,
    rows_per_part: int = ROWS_PER_PART,
) -> DataFrame:
    """Add ``cum_<m>`` (total up to and including the row) and ``tot_<m>`` (total of the group).

    ``df`` holds one row per (groups, order); rows with a null in one of them are left out. It is written once.
    """
    keys = list(groups)
    known = df.where(" AND ".join(f"`{c}` IS NOT NULL" for c in [*keys, order]))
    rows = cut_order(known, [*keys, order], rows_per_part)

    def ordered(name: str) -> Column:
        return F.desc(name) if descending else F.asc(name)

    parts = rows.groupBy(_PART, *keys).agg(*[F.sum(m).alias(m) for m in measures], F.min(order).alias(_FROM))
    whole = Window.partitionBy(*keys)
    earlier = whole.orderBy(ordered(_FROM)).rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        _PART,
        *keys,
        *[F.coalesce(F.sum(m).over(earlier), F.lit(0)).alias(f"__base_{m}") for m in measures],
        *[F.sum(m).over(whole).alias(f"tot_{m}") for m in measures],
    )
    upto = Window.partitionBy(_PART, *keys).orderBy(ordered(order)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.join(offsets, [_PART, *keys]).select(
        *df.columns,
        *[f"tot_{m}" for m in measures],
        *[(F.col(f"__base_{m}") + F.sum(m).over(upto)).alias(f"cum_{m}") for m in measures],
    )


def long_form(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """One row per (row, column): ``keep``, column, value (double). Null and NaN values are left out."""
    wide = df.select(*keep, *[F.col(c).cast("double").alias(c) for c in columns])
    return wide.unpivot(list(keep), list(columns), "column", "value").where("value IS NOT NULL AND NOT isnan(value)")


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Mapping[str, float],
    groups: Sequence[str] = (),
) -> DataFrame:
    """Exact quantiles with linear interpolation: one row per (groups, column), one field per name in
    ``probabilities``.

    Equal values are counted before the shuffle, so a value that fills a third of the table is one row.
    """
    keys = [*groups, "column"]
    counts = long_form(df, columns, groups).groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("n"))
    return quantiles_of_counts(counts, probabilities, keys)


def quantiles_of_counts(counts: DataFrame, probabilities: Mapping[str, float], keys: Sequence[str]) -> DataFrame:
    """Quantiles from one row per (keys, value) with the number ``n`` of rows that have the value."""
    runs = cumulate(counts, "value", ["n"], keys)

    def at(position: Column) -> Column:
        here = (F.col("cum_n") > position) & (F.col("cum_n") - F.col("n") <= position)
        return F.max(F.when(here, F.col("value")))

    aggregates: list[Column] = []
    outputs: list[Column] = []
    for name, p in probabilities.items():
        position = F.lit(float(p)) * (F.col("tot_n") - 1)
        aggregates += [
            at(F.floor(position)).alias(f"__lo_{name}"),
            at(F.ceil(position)).alias(f"__hi_{name}"),
            F.max(position - F.floor(position)).alias(f"__part_{name}"),
        ]
        low, high = F.col(f"__lo_{name}"), F.col(f"__hi_{name}")
        outputs.append((low + F.col(f"__part_{name}") * (high - low)).alias(name))
    return runs.groupBy(*keys).agg(*aggregates).select(*keys, *outputs)


def first_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of every key. The limit is applied to each input partition before the shuffle, so a
    key that holds a third of the table sends only one row per task."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(window)).where("__rank = 1").drop("__rank")


def wide_as_long(
    df: DataFrame, fields: Mapping[str, Mapping[str, str]], name: str = "column", keep: Sequence[str] = ()
) -> DataFrame:
    """Turn a row of a wide aggregate into one row per key of ``fields``: key -> {output: wide column}."""
    rows = [
        F.struct(F.lit(key).alias(name), *[F.col(source).alias(out) for out, source in outputs.items()])
        for key, outputs in fields.items()
    ]
    return df.select(*keep, F.inline(F.array(*rows)))


def one_row(df: DataFrame) -> Column:
    """The single row of an aggregate as a struct that other expressions can use. It is one subquery however
    many of its fields are read, so the aggregate runs once."""
    return df.select(F.struct(*df.columns)).scalar()
