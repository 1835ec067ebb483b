"""Profiles kept per month: the months up to 1998 are profiled first, the later ones when they arrive; nothing is read twice."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.operators import profiles as P
from riskflow.queries.registry import Tables, query
from riskflow.session import scratch_dir
from riskflow.sources import sinks, tables

COLUMNS = ("o_orderkey", "o_custkey", "late_price", "o_totalprice", "o_orderstatus")


def _orders(t: Tables) -> DataFrame:
    late = F.when(F.col("o_orderdate") >= "1996-01-01", F.col("o_totalprice"))
    return t["orders"].select(
        "o_orderkey", "o_custkey", late.alias("late_price"), "o_totalprice", "o_orderstatus", F.trunc(F.to_date("o_orderdate"), "MM").alias("snapshot_date")
    )


_ORDERS = """orders_m AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderdate >= '1996-01-01' THEN o_totalprice END AS late_price, o_totalprice,
    o_orderstatus, CAST(DATE_TRUNC('month', o_orderdate) AS DATE) AS snapshot_date FROM orders)"""


def _in_two_steps(t: Tables, make) -> DataFrame:
    """What ``make`` gives for the months up to 1998 is stored, then for the months that the store does not hold."""
    source, root = scratch_dir(t.spark, "profiled_orders"), scratch_dir(t.spark, "order_profiles")
    sinks.write_snapshots(_orders(t), source)
    stored = tables.read_table(t.spark, source)
    sinks.write_snapshots(make(tables.up_to(stored, "1998-12-31")), root)
    held = set(tables.stored_dates(t.spark, root))
    new = [d for d in tables.stored_dates(t.spark, source) if d not in held]
    if new:
        sinks.write_snapshots(make(tables.at_snapshots(stored, new)), root)
    return tables.read_table(t.spark, root)


def _profiles(t: Tables) -> DataFrame:
    return _in_two_steps(t, lambda df: P.partition_profiles(df, ["snapshot_date"]))


def _values(t: Tables) -> DataFrame:
    return _in_two_steps(t, lambda df: P.value_counts_of(df, ["snapshot_date"], COLUMNS))


def _rounded(df: DataFrame) -> DataFrame:
    return df.drop("approx_distinct").withColumns({c: F.round(c, 4) for c in ("missing_pct", "mean", "std", "min", "max")})


def _profile_sql(c: str, group: str = "") -> str:
    number = "NULL" if c == "o_orderstatus" else c
    known = [f"ROUND({f}(CAST({number} AS DOUBLE)), 4) AS {name}" for name, f in (("mean", "AVG"), ("std", "STDDEV_SAMP"), ("min", "MIN"), ("max", "MAX"))]
    keys = f"{group}, " if group else ""
    return f"""SELECT {keys}'{c}' AS "column", COUNT(*) AS n_rows, COUNT(*) - COUNT({c}) AS missing_count,
      ROUND((COUNT(*) - COUNT({c})) / COUNT(*) * 100, 4) AS missing_pct, {', '.join(known)} FROM orders_m {f'GROUP BY {group}' if group else ''}"""


@query("profile_store", f"WITH {_ORDERS} " + " UNION ALL ".join(_profile_sql(c) for c in COLUMNS))
def profile_store(t: Tables) -> DataFrame:
    """The profile of all months from what is stored of each."""
    return _rounded(P.read_profile(P.merge_profiles(_profiles(t))))


@query(
    "profile_by_year",
    f"WITH {_ORDERS.replace('FROM orders)', ', YEAR(o_orderdate) AS year FROM orders)')} " + " UNION ALL ".join(_profile_sql(c, "year") for c in COLUMNS),
)
def profile_by_year(t: Tables) -> DataFrame:
    """Any part of a store has a profile, here each year."""
    years = _profiles(t).withColumn("year", F.year("snapshot_date").cast("bigint"))
    return _rounded(P.read_profile(P.merge_profiles(years, ["year"]), ["year"]))


@query(
    "profile_distinct",
    f"WITH {_ORDERS}, v AS ("
    + " UNION ALL ".join(f"""SELECT '{c}' AS "column", CAST({c} AS VARCHAR) AS value, COUNT(*) AS n FROM orders_m WHERE {c} IS NOT NULL GROUP BY ALL""" for c in COLUMNS)
    + """) SELECT "column", COUNT(*) AS n_distinct, MAX(n)::BIGINT AS top_n, COUNT(*) FILTER (WHERE n > 1) AS n_repeated, TRUE AS sketch_agrees FROM v GROUP BY 1""",
)
def profile_distinct(t: Tables) -> DataFrame:
    """Exact distinct values from value counts per month; the merged sketches must lie within four standard errors of them."""
    estimate = P.read_profile(P.merge_profiles(_profiles(t))).select("column", "approx_distinct")
    found = P.exact_distinct(_values(t)).join(estimate, "column")
    near = F.abs(F.col("approx_distinct") / F.col("n_distinct") - 1) <= 4 * P.sketch_error()
    return found.select("column", "n_distinct", "top_n", "n_repeated", near.alias("sketch_agrees"))


@query(
    "profile_completeness",
    f"""WITH {_ORDERS} SELECT COUNT(*) AS n_rows, 5 AS n_columns,
    ROUND((5 * COUNT(*) - COUNT(o_orderkey) - COUNT(o_custkey) - COUNT(late_price) - COUNT(o_totalprice) - COUNT(o_orderstatus)) / (5 * COUNT(*)), 6) AS null_share
    FROM orders_m""",
)
def profile_completeness(t: Tables) -> DataFrame:
    out = P.store_completeness(P.merge_profiles(_profiles(t)))
    return out.withColumns({"null_share": F.round("null_share", 6), "n_columns": F.col("n_columns").cast("int")})
