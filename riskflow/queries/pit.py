from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.operators import features as G
from riskflow.operators.ordered import first_rows
from riskflow.operators.pit import History, asof_join, exact_date_join, lookback
from riskflow.queries import views as V
from riskflow.queries.registry import Tables, query

KEY = {"key": "customer_id"}


def _asof_sql(op: str) -> str:
    return f"""WITH {V.APPS_O}, {V.FIN_O}, ranked AS (
  SELECT a.loan_id, f.*, ROW_NUMBER() OVER (PARTITION BY a.loan_id
           ORDER BY f.snapshot_date DESC, f.o_orderkey DESC) AS rn
  FROM apps_o a JOIN fin_o f ON f.customer_id = a.customer_id AND f.snapshot_date {op} a.application_date)
SELECT a.loan_id, a.customer_id, a.application_date, a.loan_amt, r.o_orderkey, r.outstanding_debt, r.credit_mix,
       r.num_delayed, r.snapshot_date AS feature_date
FROM apps_o a LEFT JOIN ranked r ON r.loan_id = a.loan_id AND r.rn = 1"""


def _asof(t: Tables, strict: bool) -> DataFrame:
    newest = History(
        V.fin_o(t),
        latest=("o_orderkey", "outstanding_debt", "credit_mix", "num_delayed"),
        tie=("o_orderkey",),
        date_as="feature_date",
    )
    return asof_join(V.apps_o(t).drop("tenure"), [newest], strict=strict, **KEY)


@query("asof_latest", _asof_sql("<="))
def asof_latest(t: Tables) -> DataFrame:
    return _asof(t, strict=False)


@query("asof_strict", _asof_sql("<"))
def asof_strict(t: Tables) -> DataFrame:
    return _asof(t, strict=True)


_DELAY_SQL = """SELECT a.customer_id, a.application_date,
       CAST(COALESCE(SUM(CASE WHEN lag <= 90 THEN f.num_delayed END), 0) AS BIGINT) AS Num_of_Delayed_Payment_3m,
       CAST(COALESCE(SUM(CASE WHEN lag <= 180 THEN f.num_delayed END), 0) AS BIGINT) AS Num_of_Delayed_Payment_6m,
       CAST(COALESCE(SUM(f.num_delayed), 0) AS BIGINT) AS Num_of_Delayed_Payment_12m,
       COALESCE(MAX(f.num_delayed), 0) AS max_dpd_prior,
       CASE WHEN MAX(f.num_delayed) >= 30 THEN 1 ELSE 0 END AS ever_30dpd_prior
FROM (SELECT DISTINCT customer_id, application_date FROM apps_o) a LEFT JOIN (
  SELECT x.customer_id, x.application_date, y.num_delayed, CAST(x.application_date - y.snapshot_date AS INT) AS lag
  FROM (SELECT DISTINCT customer_id, application_date FROM apps_o) x
  JOIN fin_o y ON y.customer_id = x.customer_id AND x.application_date - y.snapshot_date BETWEEN {first} AND 365
) f ON f.customer_id = a.customer_id AND f.application_date = a.application_date
GROUP BY 1, 2"""


def _delays(t: Tables, strict: bool) -> DataFrame:
    apps = V.apps_o(t).select("customer_id", "application_date").distinct()
    found = G.delinquency(V.fin_o(t), apps, delayed="num_delayed", strict=strict, **KEY)
    return apps.join(found, apps.columns, "left").fillna(0)


@query("pit_lookback_sums", f"WITH {V.APPS_O}, {V.FIN_O} " + _DELAY_SQL.format(first=0))
def pit_lookback_sums(t: Tables) -> DataFrame:
    return _delays(t, strict=False)


@query("pit_lookback_sums_strict", f"WITH {V.APPS_O}, {V.FIN_O} " + _DELAY_SQL.format(first=1))
def pit_lookback_sums_strict(t: Tables) -> DataFrame:
    return _delays(t, strict=True)


FE = ("fe_1", "fe_2", "fe_3", "fe_4")
# A mean of amounts in cents often ends in a 5 at the fifth place, where two engines may round apart.
DIGITS = {"sum": 2, "mean": 8, "std": 6}
_CLICK_FIELDS = {f"{c}_{s}_{h}": DIGITS[s] for h in ("7d", "30d") for c in FE for s in DIGITS}


def _click_sql(value: str, default: str) -> str:
    functions = {"sum": "SUM", "mean": "AVG", "std": "STDDEV_SAMP"}
    fields = []
    for h, days in (("7d", 7), ("30d", 30)):
        for c in FE:
            x = value.format(c=c)
            for s, f in functions.items():
                agg = f"{f}(CASE WHEN a.application_date - k.snapshot_date <= {days} THEN {x} END)"
                fields.append(f"ROUND({default.format(agg=agg)}, {DIGITS[s]}) AS {c}_{s}_{h}")
    return f"""WITH {V.APPS_E}, {V.CLICKS}
SELECT a.customer_id, a.application_date, a.application_id, {', '.join(fields)}
FROM apps_e a LEFT JOIN (SELECT *, 1 AS here FROM clicks) k
  ON k.customer_id = a.customer_id AND a.application_date - k.snapshot_date BETWEEN 0 AND 30
GROUP BY 1, 2, 3"""


def _click(t: Tables, fill: float | None) -> DataFrame:
    apps = V.apps_e(t)
    found = G.clickstream(V.clicks(t), apps, fill=fill, unique=True, **KEY)
    out = apps.join(found, ["customer_id", "application_date"], "left")
    out = out.withColumns({c: F.round(c, digits) for c, digits in _CLICK_FIELDS.items()})
    return out if fill is None else out.fillna(fill, subset=list(_CLICK_FIELDS))


@query(
    "click_window_stats",
    _click_sql("(CASE WHEN k.here = 1 THEN COALESCE(k.{c}, 0) END)", "COALESCE({agg}, 0)"),
)
def click_window_stats(t: Tables) -> DataFrame:
    return _click(t, fill=0.0)


@query("click_window_nulls", _click_sql("k.{c}", "{agg}"))
def click_window_nulls(t: Tables) -> DataFrame:
    return _click(t, fill=None)


@query(
    "event_window_stats",
    f"""WITH {V.APPS_E}
SELECT a.customer_id, a.application_date,
       ROUND(SUM(CASE WHEN lag <= 7 THEN e.value END), 2) AS value_sum_7d,
       ROUND(AVG(CASE WHEN lag <= 7 THEN e.value END), 8) AS value_mean_7d,
       ROUND(STDDEV_SAMP(CASE WHEN lag <= 7 THEN e.value END), 6) AS value_std_7d,
       MAX(CASE WHEN lag <= 7 THEN e.value END) AS value_max_7d,
       COUNT(CASE WHEN lag <= 7 THEN e.value END) AS value_count_7d,
       ROUND(SUM(e.value), 2) AS value_sum_30d, ROUND(AVG(e.value), 8) AS value_mean_30d,
       ROUND(STDDEV_SAMP(e.value), 6) AS value_std_30d, MAX(e.value) AS value_max_30d,
       COUNT(e.value) AS value_count_30d
FROM apps_e a JOIN (
  SELECT x.customer_id, x.application_date, y.value, CAST(x.application_date - CAST(y.ts AS DATE) AS INT) AS lag
  FROM apps_e x JOIN events y ON y.user_id = x.customer_id
   AND x.application_date - CAST(y.ts AS DATE) BETWEEN 0 AND 30
) e ON e.customer_id = a.customer_id AND e.application_date = a.application_date
GROUP BY 1, 2""",
)
def event_window_stats(t: Tables) -> DataFrame:
    """Raw events, many per customer and day: folded into days before the join."""
    events = t["events"].select(F.col("user_id").alias("customer_id"), F.to_date("ts").alias("snapshot_date"), "value")
    out = lookback(
        events, V.apps_e(t), {"value": ("sum", "mean", "std", "max", "count")}, {"7d": 7, "30d": 30}, **KEY
    )
    return out.withColumns(
        {f"value_{s}_{h}": F.round(f"value_{s}_{h}", d) for s, d in DIGITS.items() for h in ("7d", "30d")}
    )


@query(
    "click_alltime_and_onday",
    f"""WITH {V.APPS_E}, {V.CLICKS}, totals AS (
  SELECT a.customer_id, a.application_date, {', '.join(f'SUM(k.{c}) AS {c}_sum_all' for c in FE)}
  FROM apps_e a JOIN clicks k ON k.customer_id = a.customer_id AND k.snapshot_date <= a.application_date GROUP BY 1, 2)
SELECT a.customer_id, a.application_date, {', '.join(f'ROUND(s.{c}_sum_all, 2) AS {c}_sum_all' for c in FE)},
       {', '.join(f'ROUND(d.{c}, 4) AS {c}' for c in FE)}
FROM apps_e a LEFT JOIN totals s ON s.customer_id = a.customer_id AND s.application_date = a.application_date
LEFT JOIN clicks d ON d.customer_id = a.customer_id AND d.snapshot_date = a.application_date""",
)
def click_alltime_and_onday(t: Tables) -> DataFrame:
    clicks, apps = V.clicks(t), V.apps_e(t).drop("application_id")
    totals = G.click_totals(clicks, apps, unique=True, applications_unique=True, **KEY)
    out = exact_date_join(totals, clicks, FE, **KEY)
    return out.withColumns(
        {**{f"{c}_sum_all": F.round(f"{c}_sum_all", 2) for c in FE}, **{c: F.round(c, 4) for c in FE}}
    )


@query(
    "limit_changes_and_recency",
    f"""WITH {V.APPS_O}, {V.FIN_O}, a AS (SELECT DISTINCT customer_id, application_date FROM apps_o), moves AS (
  SELECT *, CASE WHEN credit_mix = 'P' THEN 0.0 ELSE outstanding_debt END AS change FROM fin_o), w AS (
  SELECT a.customer_id, a.application_date, CAST(a.application_date - m.snapshot_date AS INT) AS lag,
         NULLIF(m.change, 0.0) AS change
  FROM a JOIN moves m ON m.customer_id = a.customer_id AND a.application_date - m.snapshot_date BETWEEN 0 AND 180), s AS (
  SELECT customer_id, application_date,
         ROUND(SUM(CASE WHEN lag <= 90 THEN change END), 2) AS Changed_Credit_Limit_sum_3m,
         ROUND(SUM(change), 2) AS Changed_Credit_Limit_sum_6m,
         COUNT(CASE WHEN lag <= 90 THEN change END) AS count_credit_limit_changes_3m,
         COUNT(change) AS count_credit_limit_changes_6m
  FROM w GROUP BY 1, 2), r AS (
  SELECT a.customer_id, a.application_date, CAST(a.application_date - MAX(f.snapshot_date) AS INT) AS time_since_last_delay
  FROM a JOIN fin_o f ON f.customer_id = a.customer_id AND f.snapshot_date <= a.application_date AND f.num_delayed >= 4
  GROUP BY 1, 2)
SELECT a.customer_id, a.application_date, Changed_Credit_Limit_sum_3m, Changed_Credit_Limit_sum_6m,
       count_credit_limit_changes_3m, count_credit_limit_changes_6m, time_since_last_delay
FROM a LEFT JOIN s ON s.customer_id = a.customer_id AND s.application_date = a.application_date
       LEFT JOIN r ON r.customer_id = a.customer_id AND r.application_date = a.application_date""",
)
def limit_changes_and_recency(t: Tables) -> DataFrame:
    apps = V.apps_o(t).select("customer_id", "application_date").distinct()
    history = V.fin_o(t).withColumns(
        {
            "change": F.when(F.col("credit_mix") == "P", 0.0).otherwise(F.col("outstanding_debt")),
            "late_day": F.when(F.col("num_delayed") >= 4, F.col("snapshot_date")),
        }
    )
    recent = asof_join(
        apps, [History(history, running={"last_late": ("max", "late_day")})], applications_unique=True, **KEY
    ).select(*apps.columns, G.days_since("application_date", "last_late").alias("time_since_last_delay"))
    changes = G.limit_changes(history, apps, changed="change", **KEY)
    out = recent.join(changes, apps.columns, "left")
    return out.withColumns({c: F.round(c, 2) for c in out.columns if c.startswith("Changed_Credit_Limit_sum")})
