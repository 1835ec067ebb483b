from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.constants import DTI_EDGES, DTI_LABELS
from riskflow.functions import scalars as S
from riskflow.operators import features as G
from riskflow.operators import profiling as P
from riskflow.queries import views as V
from riskflow.queries.registry import Tables, query
from riskflow.sources import tables as T

FE = ("fe_1", "fe_2", "fe_3", "fe_4")


@query(
    "missing_summary",
    f"WITH {V.CLICKS}, n AS (SELECT COUNT(*) AS n FROM clicks) "
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", COUNT(*) - COUNT({c}) AS missing_count,
        ROUND((COUNT(*) - COUNT({c})) * 100 / COUNT(*), 6) AS missing_pct FROM clicks"""
        for c in ("customer_id", "snapshot_date", *FE)
    ),
)
def missing_summary(t: Tables) -> DataFrame:
    return P.missing_summary(V.clicks(t)).withColumn("missing_pct", F.round("missing_pct", 6))


@query(
    "data_quality",
    """WITH d AS (SELECT DISTINCT l_orderkey, l_linenumber, l_quantity FROM lineitem)
    SELECT (SELECT COUNT(*) FROM lineitem) AS n_rows,
      (SELECT COUNT(*) FROM lineitem) - (SELECT COUNT(*) FROM d) AS duplicate_rows,
      (SELECT COUNT(DISTINCT l_orderkey) FROM lineitem) AS n_keys, 3 AS n_columns,
      ROUND((SELECT COUNT(*) FROM lineitem) / (SELECT COUNT(DISTINCT l_orderkey) FROM lineitem), 6) AS rows_per_key""",
)
def data_quality(t: Tables) -> DataFrame:
    lines = t["lineitem"].select("l_orderkey", "l_linenumber", "l_quantity")
    return P.data_quality(lines, "l_orderkey").withColumn("rows_per_key", F.round("rows_per_key", 6))


@query(
    "store_quality",
    f"""WITH {V.CLICKS} SELECT COUNT(*) AS n_rows,
    ROUND((COUNT(*) * 4 - COUNT(fe_1) - COUNT(fe_2) - COUNT(fe_3) - COUNT(fe_4)) / (COUNT(*) * 7), 8) AS null_share,
    0 AS invalid_labels FROM clicks""",
)
def store_quality(t: Tables) -> DataFrame:
    labelled = V.clicks(t).withColumn("label", S.flag(F.col("fe_1") > 100))
    out = P.store_quality(labelled, "label")
    return out.withColumns({"null_share": F.round("null_share", 8), "invalid_labels": F.col("invalid_labels").cast("int")})


@query(
    "rows_per_month",
    "SELECT CAST(DATE_TRUNC('month', o_orderdate) AS DATE) AS month, COUNT(*) AS n_rows FROM orders GROUP BY 1",
)
def rows_per_month(t: Tables) -> DataFrame:
    months = t["orders"].select(F.trunc(F.to_date("o_orderdate"), "MM").alias("month"))
    return P.rows_per_date(months, "month")


@query(
    "date_span",
    """SELECT CAST(MIN(o_orderdate) AS DATE) AS first_date, CAST(MAX(o_orderdate) AS DATE) AS last_date,
    COUNT(DISTINCT CAST(o_orderdate AS DATE)) AS n_dates FROM orders""",
)
def date_span(t: Tables) -> DataFrame:
    return P.date_span(t["orders"].select(F.to_date("o_orderdate").alias("day")), "day")


@query(
    "month_series",
    """SELECT CAST(UNNEST(GENERATE_SERIES(DATE_TRUNC('month', lo), hi, INTERVAL 1 MONTH)) AS DATE) AS month
    FROM (SELECT MIN(o_orderdate) AS lo, MAX(o_orderdate) AS hi FROM orders)""",
)
def month_series(t: Tables) -> DataFrame:
    return T.month_starts(t["orders"], "o_orderdate")


@query(
    "value_counts",
    f"""WITH {V.CLICKS}, b AS (SELECT CASE WHEN fe_1 IS NULL THEN NULL WHEN fe_1 > 100 THEN 'high' ELSE 'low' END AS level FROM clicks)
    SELECT level, COUNT(*) AS n FROM b GROUP BY 1""",
)
def value_counts(t: Tables) -> DataFrame:
    level = F.when(F.col("fe_1").isNotNull(), F.when(F.col("fe_1") > 100, "high").otherwise("low"))
    return P.value_counts(V.clicks(t).select(level.alias("level")), "level", keep_null=True)


@query("top_values", "SELECT p_brand, COUNT(*) AS count FROM part GROUP BY 1 ORDER BY count DESC, p_brand LIMIT 15")
def top_values(t: Tables) -> DataFrame:
    return G.top_values(t["part"], "p_brand", 15)


_CATEGORIES = ("p_brand", "p_type", "p_name")


@query(
    "top_categories",
    "SELECT * FROM ("
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", {c} AS value, COUNT(*) AS n,
        CAST(ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, {c}) AS INT) AS rank FROM part GROUP BY {c}"""
        for c in _CATEGORIES
    )
    + ") WHERE rank <= 10",
)
def top_categories(t: Tables) -> DataFrame:
    return P.top_categories(t["part"], _CATEGORIES)


@query(
    "ordered_sample",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 500",
)
def ordered_sample(t: Tables) -> DataFrame:
    return t["orders"].select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(500)


_STATS = """COUNT({c}) AS n, ROUND(AVG({c}), 4) AS mean, ROUND(STDDEV_SAMP({c}), 6) AS std, MIN({c}) AS min, MAX({c}) AS max,
 ROUND(QUANTILE_CONT({c}, 0.25), 4) AS p25, ROUND(QUANTILE_CONT({c}, 0.5), 4) AS p50, ROUND(QUANTILE_CONT({c}, 0.75), 4) AS p75"""


def _rounded_stats(df: DataFrame) -> DataFrame:
    digits = {"mean": 4, "std": 6, "p25": 4, "p50": 4, "p75": 4}
    return df.withColumns({c: F.round(c, d) for c, d in digits.items()})


@query(
    "describe_numeric",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", {_STATS.format(c=f'CAST({c} AS DOUBLE)')} FROM lineitem"""
        for c in ("l_quantity", "l_extendedprice", "l_discount", "l_linenumber")
    ),
)
def describe_numeric(t: Tables) -> DataFrame:
    columns = ["l_quantity", "l_extendedprice", "l_discount", "l_linenumber"]
    return _rounded_stats(P.describe(t["lineitem"], columns))


@query(
    "describe_by_label",
    f"""WITH {V.SCORES} SELECT label, 'score' AS "column", {_STATS.format(c='score').replace('ROUND(AVG(score), 4)', 'ROUND(AVG(score), 8)')
       .replace('ROUND(QUANTILE_CONT(score, 0.25), 4)', 'ROUND(QUANTILE_CONT(score, 0.25), 8)')
       .replace('ROUND(QUANTILE_CONT(score, 0.5), 4)', 'ROUND(QUANTILE_CONT(score, 0.5), 8)')
       .replace('ROUND(QUANTILE_CONT(score, 0.75), 4)', 'ROUND(QUANTILE_CONT(score, 0.75), 8)')} FROM scores GROUP BY 1""",
)
def describe_by_label(t: Tables) -> DataFrame:
    out = P.describe(V.scores(t), ["score"], ["label"])
    return out.withColumns({"std": F.round("std", 6), **{c: F.round(c, 8) for c in ("mean", "p25", "p50", "p75")}})


@query(
    "distinct_counts",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", COUNT(DISTINCT {c}) AS n_distinct FROM lineitem"""
        for c in ("l_orderkey", "l_quantity", "l_shipdate", "l_returnflag")
    ),
)
def distinct_counts(t: Tables) -> DataFrame:
    return P.distinct_counts(t["lineitem"], ["l_orderkey", "l_quantity", "l_shipdate", "l_returnflag"])


@query(
    "histogram",
    """WITH b AS (SELECT MIN(value) AS lo, MAX(value) AS hi FROM events)
    SELECT CAST(LEAST(FLOOR((value - lo) / (hi - lo) * 50), 49) AS INT) AS bin, COUNT(*) AS n FROM events, b GROUP BY 1""",
)
def histogram(t: Tables) -> DataFrame:
    return P.histogram(t["events"], "value", 50)


@query(
    "clip_quantile",
    """WITH q AS (SELECT QUANTILE_CONT(value, 0.01) AS lo, QUANTILE_CONT(value, 0.99) AS hi FROM events)
    SELECT event_id, ROUND(LEAST(GREATEST(value, lo), hi), 4) AS value FROM events, q""",
)
def clip_quantile(t: Tables) -> DataFrame:
    clipped = P.clip_to_quantiles(t["events"].select("event_id", "value"), "value")
    return clipped.withColumn("value", F.round("value", 4))


_BINS = " ".join(
    f"WHEN x > {lo} AND x <= {hi} THEN '{label}'" for lo, hi, label in zip(DTI_EDGES, DTI_EDGES[1:], DTI_LABELS)
)


@query(
    "binning",
    f"""WITH x AS (SELECT value / 300.0 AS x FROM events UNION ALL SELECT c_acctbal / 1000.0 FROM customer),
    y AS (SELECT CASE {_BINS} END AS band FROM x) SELECT band, COUNT(*) AS n FROM y WHERE band IS NOT NULL GROUP BY 1""",
)
def binning(t: Tables) -> DataFrame:
    events = t["events"].select((F.col("value") / 300.0).alias("x"))
    balances = t["customer"].select((F.col("c_acctbal") / 1000.0).alias("x"))
    return P.interval_counts(events.unionByName(balances), "x", DTI_EDGES, DTI_LABELS)


# ---- relation to the label ----


@query(
    "rate_by_category",
    """SELECT o_orderpriority AS category, COUNT(*) AS n, ROUND(AVG(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END), 8) AS mean_label,
    ROUND(AVG(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END) * 100, 2) AS default_rate FROM orders GROUP BY 1""",
)
def rate_by_category(t: Tables) -> DataFrame:
    labelled = t["orders"].withColumn("label", S.flag(F.col("o_orderstatus") == "F"))
    return P.rate_by(labelled, "o_orderpriority").withColumn("mean_label", F.round("mean_label", 8))


@query(
    "rate_by_income_band",
    """WITH x AS (SELECT CASE WHEN c_acctbal * 10 < 20000 THEN '0-20k' WHEN c_acctbal * 10 < 50000 THEN '20-50k'
      WHEN c_acctbal * 10 < 100000 THEN '50-100k' ELSE '100k+' END AS category,
      CASE WHEN c_mktsegment = 'MACHINERY' THEN 1 ELSE 0 END AS label FROM customer)
    SELECT category, COUNT(*) AS n, ROUND(AVG(label), 8) AS mean_label, ROUND(AVG(label) * 100, 2) AS default_rate
    FROM x GROUP BY 1""",
)
def rate_by_income_band(t: Tables) -> DataFrame:
    labelled = t["customer"].withColumn("label", S.flag(F.col("c_mktsegment") == "MACHINERY"))
    return P.rate_by(labelled, S.income_band(F.col("c_acctbal") * 10)).withColumn("mean_label", F.round("mean_label", 8))


_LINE_LABEL = "SELECT *, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label FROM lineitem"
_LINE_X = ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber")


@query(
    "corr_with_label",
    f"WITH x AS ({_LINE_LABEL}) "
    + " UNION ALL ".join(f"SELECT '{c}' AS feature, ROUND(CORR({c}, label), 6) AS corr FROM x" for c in _LINE_X),
)
def corr_with_label(t: Tables) -> DataFrame:
    labelled = t["lineitem"].withColumn("label", S.flag(F.col("l_returnflag") == "R"))
    return P.correlation_with(labelled, "label", _LINE_X).withColumn("corr", F.round("corr", 6))


@query(
    "top_k_corr",
    f"WITH x AS ({_LINE_LABEL}) SELECT feature, ROUND(corr, 6) AS corr FROM ("
    + " UNION ALL ".join(f"SELECT '{c}' AS feature, CORR({c}, label) AS corr FROM x" for c in _LINE_X)
    + ") ORDER BY ABS(corr) DESC, feature LIMIT 3",
)
def top_k_corr(t: Tables) -> DataFrame:
    labelled = t["lineitem"].withColumn("label", S.flag(F.col("l_returnflag") == "R"))
    found = P.top_correlated(P.correlation_with(labelled, "label", _LINE_X), 3)
    return found.withColumn("corr", F.round("corr", 6))


@query(
    "corr_matrix",
    f"WITH {V.CLICKS} "
    + " UNION ALL ".join(
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, ROUND(CORR({a}, {b}), 6) AS corr FROM clicks"
        for i, a in enumerate(FE)
        for b in FE[i:]
    ),
)
def corr_matrix(t: Tables) -> DataFrame:
    return P.correlation_matrix(V.clicks(t), FE).withColumn("corr", F.round("corr", 6))


@query(
    "imbalance",
    f"""WITH {V.SCORES} SELECT COUNT(*) AS n, ROUND(AVG(label), 8) AS default_rate,
    AVG(label) < 0.1 OR AVG(label) > 0.9 AS imbalanced FROM scores""",
)
def imbalance(t: Tables) -> DataFrame:
    return P.class_balance(V.scores(t)).withColumn("default_rate", F.round("default_rate", 8))


# ---- risk flags ----


@query(
    "loan_indicators",
    f"""WITH {V.LOAN_L} SELECT overdue_amt > 0 AS has_overdue,
    (overdue_amt > 0 OR (due_amt <> 0 AND (due_amt - overdue_amt) / NULLIF(due_amt, 0) < 0.5)) AS potential_default,
    COUNT(*) AS n, ROUND(AVG((due_amt - overdue_amt) / NULLIF(due_amt, 0)), 6) AS mean_ratio FROM loan_l GROUP BY 1, 2""",
)
def loan_indicators(t: Tables) -> DataFrame:
    loans = V.loan_l(t).withColumn("paid_amt", F.col("due_amt") - F.col("overdue_amt")).withColumns(P.payment_flags())
    return loans.groupBy("has_overdue", "potential_default").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("payment_ratio"), 6).alias("mean_ratio")
    )


@query(
    "high_risk_flag",
    """SELECT o_orderkey, (o_orderstatus = 'P' OR CAST(SUBSTR(o_orderpriority, 1, 1) AS INT) * 10 > 30 OR o_totalprice / 5000 > 80)
    AS high_risk FROM orders""",
)
def high_risk_flag(t: Tables) -> DataFrame:
    rows = t["orders"].select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", "Bad").otherwise("Good").alias("Credit_Mix"),
        (F.substring("o_orderpriority", 1, 1).cast("int") * 10).alias("Delay_from_due_date"),
        (F.col("o_totalprice") / 5000).alias("Credit_Utilization_Ratio"),
    )
    return rows.select("o_orderkey", P.high_risk().alias("high_risk"))
