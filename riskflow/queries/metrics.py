from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.constants import THRESHOLDS
from riskflow.operators import metrics as M
from riskflow.queries import views as V
from riskflow.queries.registry import Tables, query

# Average ranks: rows with a lower score, plus half of (rows with the same score + 1).
_RANKED = """ranked AS (
  SELECT *, RANK() OVER (PARTITION BY {g} ORDER BY score) + (COUNT(*) OVER (PARTITION BY {g}, score) - 1) / 2.0 AS r FROM {source}),
auc AS (
  SELECT {g}, SUM(label) AS p, COUNT(*) - SUM(label) AS n,
         CASE WHEN SUM(label) > 0 AND COUNT(*) > SUM(label) THEN
           (SUM(CASE WHEN label = 1 THEN r END) - SUM(label) * (SUM(label) + 1) / 2.0) / (SUM(label) * CAST(COUNT(*) - SUM(label) AS DOUBLE))
         END AS auc FROM ranked GROUP BY 1),
gaps AS (
  SELECT {g}, ABS(SUM(label) OVER w / CAST(NULLIF(SUM(label) OVER (PARTITION BY {g}), 0) AS DOUBLE)
                - SUM(1 - label) OVER w / CAST(NULLIF(SUM(1 - label) OVER (PARTITION BY {g}), 0) AS DOUBLE)) AS gap
  FROM {source} WINDOW w AS (PARTITION BY {g} ORDER BY score RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
ks AS (SELECT {g}, MAX(gap) AS ks FROM gaps GROUP BY 1)"""


def _monitor_sql(source: str, prelude: str) -> str:
    return f"""WITH {prelude}, {_RANKED.format(g='month', source=source)}
    SELECT s.month, s.n_samples, ROUND(a.auc, 8) AS "AUC", ROUND(2 * a.auc - 1, 8) AS "Gini", ROUND(k.ks, 8) AS "KS",
      s.brier AS "Brier", s.pm AS "Pred_Mean", s.y AS "Actual_Default_Rate", s.d AS "Default_Rate_Diff"
    FROM (SELECT month, COUNT(*) AS n_samples, ROUND(AVG((score - label) * (score - label)), 8) AS brier, ROUND(AVG(score), 8) AS pm,
            ROUND(AVG(label), 8) AS y, ROUND(ABS(AVG(score) - AVG(label)), 8) AS d FROM {source} GROUP BY 1) s
    JOIN auc a ON a.month = s.month JOIN ks k ON k.month = s.month"""


@query("monthly_monitoring", _monitor_sql("scores", V.SCORES))
def monthly_monitoring(t: Tables) -> DataFrame:
    return M.monitoring(V.scores(t), digits=8)


# Predictions and labels per customer and month, taken from events: the score is the share of large values.
_OUTCOMES = """p AS (
  SELECT user_id, CAST(DATE_TRUNC('week', ts) AS DATE) AS week, LEAST(AVG(value) / 200.0, 1.0) AS score FROM events
  WHERE event_type <> 'error' GROUP BY 1, 2),
y AS (SELECT user_id, CAST(DATE_TRUNC('week', ts) AS DATE) AS week, MAX(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS label
  FROM events GROUP BY 1, 2)"""


def _outcome_tables(t: Tables) -> tuple[DataFrame, DataFrame]:
    week = F.to_date(F.date_trunc("week", "ts")).alias("snapshot_date")
    user = F.col("user_id").alias("Customer_ID")
    predictions = (
        t["events"]
        .where("event_type <> 'error'")
        .groupBy(user, week)
        .agg(F.least(F.avg("value") / 200.0, F.lit(1.0)).alias("model_predictions"))
    )
    labels = t["events"].groupBy(user, week).agg(F.max((F.col("event_type") == "error").cast("int")).alias("label"))
    return predictions, labels


@query(
    "outcomes_same_snapshot",
    f"""WITH {_OUTCOMES} SELECT y.user_id AS "Customer_ID", y.week AS month, y.label, ROUND(p.score, 11) AS score, 1 AS weight
    FROM y JOIN p ON p.user_id = y.user_id AND p.week = y.week""",
)
def outcomes_same_snapshot(t: Tables) -> DataFrame:
    return M.join_outcomes(*_outcome_tables(t), mode="snapshot").withColumn("score", F.round("score", 11))


@query(
    "outcomes_matured",
    """WITH p AS (SELECT o_custkey AS c, CAST(DATE_TRUNC('month', o_orderdate) AS DATE) AS m, MAX(o_totalprice) / 500000.0 AS score
      FROM orders GROUP BY 1, 2), y AS (SELECT o_custkey AS c, CAST(DATE_TRUNC('month', o_orderdate) AS DATE) AS m,
      MAX(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS label FROM orders GROUP BY 1, 2)
    SELECT y.c AS "Customer_ID", y.m AS month, y.label, ROUND(p.score, 11) AS score, 1 AS weight
    FROM y JOIN p ON p.c = y.c AND y.m = p.m + INTERVAL 6 MONTH""",
)
def outcomes_matured(t: Tables) -> DataFrame:
    month = F.trunc(F.to_date("o_orderdate"), "MM").alias("snapshot_date")
    customer = F.col("o_custkey").alias("Customer_ID")
    predictions = t["orders"].groupBy(customer, month).agg((F.max("o_totalprice") / 500000.0).alias("model_predictions"))
    labels = t["orders"].groupBy(customer, month).agg(F.max((F.col("o_orderstatus") == "F").cast("int")).alias("label"))
    return M.join_outcomes(predictions, labels, "maturity", 6).withColumn("score", F.round("score", 11))


@query(
    "monitoring_by_customer",
    _monitor_sql(
        "pairs",
        _OUTCOMES + ", pairs AS (SELECT y.week AS month, y.label, p.score FROM y JOIN p ON p.user_id = y.user_id)",
    ),
)
def monitoring_by_customer(t: Tables) -> DataFrame:
    """Every label of a customer against every prediction of the customer, as weights."""
    return M.monitoring(M.join_outcomes(*_outcome_tables(t), mode="customer"), weight="weight", digits=8)


@query(
    "auc_by_date",
    f"""WITH {V.SCORES}, {_RANKED.format(g='month', source='scores')}
    SELECT month, ROUND(auc, 6) AS auc, ROUND(2 * auc - 1, 3) AS gini,
      CASE WHEN month >= DATE '2024-01-22' THEN 'OOT' ELSE 'Train/Test' END AS dataset, CAST(p + n AS BIGINT) AS sample_size
    FROM auc WHERE auc IS NOT NULL""",
)
def auc_by_date(t: Tables) -> DataFrame:
    return M.auc_by_date(V.scores(t), "2024-01-22", date="month")


_POINTS = """c AS (SELECT score, SUM(label) AS pos, SUM(1 - label) AS neg FROM scores GROUP BY 1),
pts AS (SELECT score AS threshold, pos, SUM(pos) OVER w AS cp, SUM(neg) OVER w AS cn, SUM(pos) OVER () AS tp, SUM(neg) OVER () AS tn
  FROM c WINDOW w AS (ORDER BY score DESC))"""


@query(
    "roc_points",
    f"""WITH {V.SCORES}, {_POINTS} SELECT threshold, ROUND(CAST(cn AS DOUBLE) / tn, 8) AS fpr, ROUND(CAST(cp AS DOUBLE) / tp, 8) AS tpr FROM pts""",
)
def roc_points(t: Tables) -> DataFrame:
    return M.roc_points(V.scores(t)).withColumns({"fpr": F.round("fpr", 8), "tpr": F.round("tpr", 8)})


@query(
    "pr_points",
    f"""WITH {V.SCORES}, {_POINTS} SELECT threshold, ROUND(CAST(cp AS DOUBLE) / (cp + cn), 8) AS precision,
    ROUND(CAST(cp AS DOUBLE) / tp, 8) AS recall FROM pts""",
)
def pr_points(t: Tables) -> DataFrame:
    points = M.precision_recall_points(V.scores(t)).drop("recall_step")
    return points.withColumns({"precision": F.round("precision", 8), "recall": F.round("recall", 8)})


@query(
    "average_precision",
    f"""WITH {V.SCORES}, {_POINTS} SELECT ROUND(SUM(CAST(pos AS DOUBLE) / tp * cp / (cp + cn)), 8) AS average_precision FROM pts""",
)
def average_precision(t: Tables) -> DataFrame:
    return M.average_precision(V.scores(t)).withColumn("average_precision", F.round("average_precision", 8))


@query(
    "calibration",
    f"""WITH {V.SCORES}, b AS (SELECT *, {' + '.join(f'CASE WHEN score > {k / 10} THEN 1 ELSE 0 END' for k in range(1, 10))} + 1 AS bin FROM scores)
    SELECT bin, COUNT(*) AS n, ROUND(AVG(score), 8) AS mean_score, ROUND(AVG(label), 8) AS default_rate FROM b GROUP BY 1""",
)
def calibration(t: Tables) -> DataFrame:
    out = M.calibration(V.scores(t))
    return out.withColumns({"mean_score": F.round("mean_score", 8), "default_rate": F.round("default_rate", 8)})


@query(
    "prob_hist",
    f"""WITH {V.SCORES}, b AS (SELECT label, CAST(LEAST(FLOOR(score * 50), 49) AS INT) AS bin FROM scores)
    SELECT label, bin, COUNT(*) AS n, ROUND(COUNT(*) * 50 / SUM(COUNT(*)) OVER (PARTITION BY label), 8) AS density FROM b GROUP BY 1, 2""",
)
def prob_hist(t: Tables) -> DataFrame:
    return M.score_histogram(V.scores(t)).withColumn("density", F.round("density", 8))


_CELLS = """COUNT(CASE WHEN score >= {t} AND label = 1 THEN 1 END) AS tp, COUNT(CASE WHEN score >= {t} AND label = 0 THEN 1 END) AS fp,
COUNT(CASE WHEN score < {t} AND label = 1 THEN 1 END) AS fn, COUNT(CASE WHEN score < {t} AND label = 0 THEN 1 END) AS tn"""


@query("confusion", f"WITH {V.SCORES} SELECT month, {_CELLS.format(t=0.2)} FROM scores GROUP BY 1")
def confusion(t: Tables) -> DataFrame:
    return M.confusion(V.scores(t), 0.2, ["month"])


_SWEEP = (
    f"WITH {V.SCORES}, c AS ("
    + " UNION ALL ".join(f"SELECT CAST({x} AS DOUBLE) AS threshold, {_CELLS.format(t=x)} FROM scores" for x in THRESHOLDS)
    + """), s AS (SELECT *, (tn + fn) / (tp + fp + fn + tn) AS approval_rate, (tp + fp) / (tp + fp + fn + tn) AS rejection_rate,
  CASE WHEN tn + fn > 0 THEN fn / (tn + fn) ELSE 0 END AS default_rate_in_approved,
  CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS sensitivity,
  CASE WHEN tn + fp > 0 THEN tn / (tn + fp) ELSE 0 END AS specificity,
  CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS "precision" FROM c)"""
)
_RATES = ("approval_rate", "rejection_rate", "default_rate_in_approved", "sensitivity", "specificity", "precision")


@query(
    "threshold_sweep",
    _SWEEP + " SELECT threshold, tp, fp, fn, tn, " + ", ".join(f'ROUND("{c}", 8) AS "{c}"' for c in _RATES) + " FROM s",
)
def threshold_sweep(t: Tables) -> DataFrame:
    return M.threshold_sweep(V.scores(t)).withColumns({c: F.round(c, 8) for c in _RATES})


@query(
    "expected_loss",
    _SWEEP + " SELECT threshold, ROUND(default_rate_in_approved * 10000 * 0.7, 4) AS expected_loss_per_approved FROM s",
)
def expected_loss(t: Tables) -> DataFrame:
    out = M.expected_loss(M.threshold_sweep(V.scores(t)))
    return out.select("threshold", F.round("expected_loss_per_approved", 4).alias("expected_loss_per_approved"))


@query(
    "threshold_pick",
    _SWEEP
    + """ SELECT MAX(CASE WHEN default_rate_in_approved <= 0.03 THEN threshold END) AS conservative,
    MAX(CASE WHEN threshold = 0.15 THEN threshold END) AS balanced,
    MIN(CASE WHEN default_rate_in_approved <= 0.2 THEN threshold END) AS growth FROM s""",
)
def threshold_pick(t: Tables) -> DataFrame:
    return M.threshold_choice(M.threshold_sweep(V.scores(t)), growth=0.2)


@query(
    "class_report",
    f"""WITH {V.SCORES}, c AS (SELECT {_CELLS.format(t=0.3)} FROM scores)
    SELECT 0 AS class, ROUND(tn / (tn + fn), 8) AS "precision", ROUND(tn / (tn + fp), 8) AS recall,
      ROUND(2 * tn / (2 * tn + fn + fp), 8) AS f1, tn + fp AS support FROM c UNION ALL
    SELECT 1, ROUND(tp / (tp + fp), 8), ROUND(tp / (tp + fn), 8), ROUND(2 * tp / (2 * tp + fp + fn), 8), tp + fn FROM c""",
)
def class_report(t: Tables) -> DataFrame:
    return M.class_report(V.scores(t), 0.3).withColumns({c: F.round(c, 8) for c in ("precision", "recall", "f1")})


@query(
    "overfit_check",
    f"""WITH {V.SCORES}, tagged AS (SELECT label, score, CASE WHEN month >= DATE '2024-01-22' THEN 'test' ELSE 'train' END AS split
      FROM scores), {_RANKED.format(g='split', source='tagged')}, w AS (SELECT MAX(CASE WHEN split = 'train' THEN auc END) AS a,
      MAX(CASE WHEN split = 'test' THEN auc END) AS b FROM auc)
    SELECT ROUND(a, 8) AS train_auc, ROUND(b, 8) AS test_auc, ROUND(a - b, 8) AS auc_gap, a - b > 0.05 AS overfit FROM w""",
)
def overfit_check(t: Tables) -> DataFrame:
    later = F.col("month") >= F.lit("2024-01-22").cast("date")
    tagged = V.scores(t).withColumn("split", F.when(later, "test").otherwise("train"))
    out = M.overfit_check(M.ranking_metrics(tagged, ["split"]))
    return out.withColumns({c: F.round(c, 8) for c in ("train_auc", "test_auc", "auc_gap")})
