from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.operators import labels as L
from riskflow.queries import views as V
from riskflow.queries.registry import Tables, query
from riskflow.session import scratch_dir
from riskflow.sources import sinks, tables


@query(
    "label_mob",
    f"""WITH {V.LOAN_DPD} SELECT loan_id, snapshot_date, CASE WHEN dpd >= 30 THEN 1 ELSE 0 END AS label,
    '30dpd_6mob' AS label_def FROM loan_d WHERE mob = 6""",
)
def label_mob(t: Tables) -> DataFrame:
    return L.snapshot_labels(V.loan_d(t), 30, 6, ["loan_id", "snapshot_date"])


@query(
    "label_ever_default",
    f"""WITH {V.LOAN_DPD}, bad AS (SELECT DISTINCT loan_id FROM loan_d WHERE mob >= 4 AND dpd >= 30)
    SELECT o.o_orderkey AS loan_id, o.o_custkey AS customer_id, CAST(o.o_orderdate AS DATE) AS application_date,
           CASE WHEN b.loan_id IS NULL THEN 0 ELSE 1 END AS label
    FROM orders o LEFT JOIN bad b ON b.loan_id = o.o_orderkey""",
)
def label_ever_default(t: Tables) -> DataFrame:
    applications = t["orders"].select(
        F.col("o_orderkey").alias("loan_id"),
        F.col("o_custkey").alias("customer_id"),
        F.to_date("o_orderdate").alias("application_date"),
    )
    return L.ever_default_labels(applications, V.loan_d(t), 30, 4, keep=("customer_id", "application_date"))


@query(
    "label_worst_dpd",
    f"""WITH {V.LOAN_DPD} SELECT loan_id, MAX(dpd) AS max_dpd, CAST(MAX(dpd) >= 30 AS INT) AS label
    FROM loan_d WHERE mob >= 6 GROUP BY 1""",
)
def label_worst_dpd(t: Tables) -> DataFrame:
    return L.worst_dpd_labels(V.loan_d(t), 30, 6, ["loan_id"])


@query(
    "vintage_curve",
    f"""WITH {V.LOAN_DPD} SELECT d.mob, ROUND(AVG(CASE WHEN d.dpd >= 30 THEN 1.0 ELSE 0.0 END), 8) AS bad_rate, COUNT(*) AS n_rows
    FROM loan_d d JOIN orders o ON o.o_orderkey = d.loan_id WHERE CAST(o.o_orderdate AS DATE) < DATE '1998-01-01' GROUP BY 1""",
)
def vintage_curve(t: Tables) -> DataFrame:
    starts = t["orders"].select(F.col("o_orderkey").alias("loan_id"), F.to_date("o_orderdate").alias("loan_start_date"))
    curve = L.vintage_curve(V.loan_d(t).join(starts, "loan_id"), "1998-01-01")
    return curve.withColumn("bad_rate", F.round("bad_rate", 8))


@query(
    "dpd_progression",
    f"""WITH {V.LOAN_DPD}, w AS (SELECT loan_id, mob, MAX(dpd) AS max_dpd FROM loan_d GROUP BY 1, 2)
    SELECT mob, ROUND(AVG(max_dpd), 8) AS mean_dpd, QUANTILE_CONT(CAST(max_dpd AS DOUBLE), 0.5) AS median_dpd,
           COUNT(CASE WHEN max_dpd >= 30 THEN 1 END) AS loans_late, COUNT(*) AS total_loans,
           ROUND(COUNT(CASE WHEN max_dpd >= 30 THEN 1 END) / COUNT(*) * 100, 2) AS default_rate FROM w GROUP BY 1""",
)
def dpd_progression(t: Tables) -> DataFrame:
    return L.dpd_progression(V.loan_d(t)).withColumn("mean_dpd", F.round("mean_dpd", 8))


@query(
    "mob_summary",
    f"""WITH {V.LOAN_DPD} SELECT mob, COUNT(loan_id) AS loan_count, ROUND(AVG(overdue_amt), 2) AS avg_overdue,
    COUNT(CASE WHEN dpd > 0 THEN 1 END) AS loans_with_dpd FROM loan_d GROUP BY 1""",
)
def mob_summary(t: Tables) -> DataFrame:
    return L.mob_summary(V.loan_d(t))


@query(
    "dpd_thresholds",
    f"""WITH {V.LOAN_DPD} SELECT COUNT(*) AS n_rows, COUNT(CASE WHEN dpd = 0 THEN 1 END) AS n_current,
      COUNT(CASE WHEN dpd >= 30 THEN 1 END) AS n_dpd_30_plus, COUNT(CASE WHEN dpd >= 60 THEN 1 END) AS n_dpd_60_plus,
      COUNT(CASE WHEN dpd >= 90 THEN 1 END) AS n_dpd_90_plus,
      ROUND(AVG(CASE WHEN dpd = 0 THEN 1.0 ELSE 0.0 END) * 100, 1) AS pct_current,
      ROUND(AVG(CASE WHEN dpd >= 30 THEN 1.0 ELSE 0.0 END) * 100, 1) AS pct_dpd_30_plus,
      ROUND(AVG(CASE WHEN dpd >= 60 THEN 1.0 ELSE 0.0 END) * 100, 1) AS pct_dpd_60_plus,
      ROUND(AVG(CASE WHEN dpd >= 90 THEN 1.0 ELSE 0.0 END) * 100, 1) AS pct_dpd_90_plus FROM loan_d""",
)
def dpd_thresholds(t: Tables) -> DataFrame:
    return L.dpd_threshold_counts(V.loan_d(t))


@query(
    "label_store_two_definitions",
    f"""WITH {V.LOAN_DPD} SELECT loan_id, CASE WHEN dpd >= 30 THEN 1 ELSE 0 END AS label, '30dpd_' || mob || 'mob' AS label_def,
    CAST(DATE_TRUNC('month', snapshot_date) AS DATE) AS snapshot_date FROM loan_d WHERE mob IN (1, 6)""",
)
def label_store_two_definitions(t: Tables) -> DataFrame:
    """Two definitions written to one store one after the other, as monthly snapshots, each read back by its name."""
    path, loans = scratch_dir(t.spark, "label_store"), V.loan_d(t).withColumn("snapshot_date", F.trunc("snapshot_date", "MM"))
    for mob in (1, 6):
        rows = L.snapshot_labels(loans, 30, mob, ["loan_id", "snapshot_date"])
        sinks.write_snapshots(rows, path, ["label_def", "snapshot_date"])
    stored = tables.read_table(t.spark, path)
    one, six = (stored.where(F.col("label_def") == L.definition(30, mob)) for mob in (1, 6))
    return one.unionByName(six)
