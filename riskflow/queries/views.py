"""Stand-ins for the domain tables, derived from the whole test tables. Each exists twice: as a DataFrame
and as the text of a SQL common table expression, written independently."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.operators.cleaning import loan_delinquency
from riskflow.queries.registry import Tables

# ---- loan applications and the financial history of the same customer ----

APPS_O = """apps_o AS (
  SELECT o_orderkey AS loan_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS application_date,
         o_totalprice AS loan_amt, 10 AS tenure
  FROM orders WHERE o_orderpriority = '1-URGENT')"""

FIN_O = """fin_o AS (
  SELECT o_orderkey, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS snapshot_date,
         o_totalprice AS outstanding_debt, o_orderstatus AS credit_mix,
         CAST(SUBSTR(o_orderpriority, 1, 1) AS INT) AS num_delayed
  FROM orders WHERE o_orderpriority <> '1-URGENT')"""


def apps_o(t: Tables) -> DataFrame:
    return t["orders"].where("o_orderpriority = '1-URGENT'").select(
        F.col("o_orderkey").alias("loan_id"),
        F.col("o_custkey").alias("customer_id"),
        F.to_date("o_orderdate").alias("application_date"),
        F.col("o_totalprice").alias("loan_amt"),
        F.lit(10).alias("tenure"),
    )


def fin_o(t: Tables) -> DataFrame:
    return t["orders"].where("o_orderpriority <> '1-URGENT'").select(
        "o_orderkey",
        F.col("o_custkey").alias("customer_id"),
        F.to_date("o_orderdate").alias("snapshot_date"),
        F.col("o_totalprice").alias("outstanding_debt"),
        F.col("o_orderstatus").alias("credit_mix"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("num_delayed"),
    )


# ---- sign-ups and clickstream ----

APPS_E = """apps_e AS (
  SELECT user_id AS customer_id, CAST(ts AS DATE) AS application_date, MIN(event_id) AS application_id
  FROM events WHERE event_type = 'signup' GROUP BY 1, 2)"""

CLICKS = """clicks AS (
  SELECT user_id AS customer_id, CAST(ts AS DATE) AS snapshot_date,
         SUM(CASE WHEN event_type = 'click' THEN value END) AS fe_1,
         SUM(CASE WHEN event_type = 'view' THEN value END) AS fe_2,
         SUM(CASE WHEN event_type = 'purchase' THEN value END) AS fe_3,
         SUM(CASE WHEN event_type = 'error' THEN value END) AS fe_4
  FROM events WHERE event_type <> 'signup' GROUP BY 1, 2)"""


def apps_e(t: Tables) -> DataFrame:
    return (
        t["events"]
        .where("event_type = 'signup'")
        .groupBy(F.col("user_id").alias("customer_id"), F.to_date("ts").alias("application_date"))
        .agg(F.min("event_id").alias("application_id"))
    )


def clicks(t: Tables) -> DataFrame:
    kinds = {"fe_1": "click", "fe_2": "view", "fe_3": "purchase", "fe_4": "error"}
    return (
        t["events"]
        .where("event_type <> 'signup'")
        .groupBy(F.col("user_id").alias("customer_id"), F.to_date("ts").alias("snapshot_date"))
        .agg(*[F.sum(F.when(F.col("event_type") == kind, F.col("value"))).alias(c) for c, kind in kinds.items()])
    )


# ---- loan snapshots ----

LOAN_L = """loan_l AS (
  SELECT l_orderkey AS loan_id, l_linenumber AS mob, CAST(l_shipdate AS DATE) AS snapshot_date,
         l_quantity AS due_amt, GREATEST(l_linenumber * 8 - l_quantity, 0.0) AS overdue_amt
  FROM lineitem)"""

LOAN_DPD = (
    LOAN_L
    + """, missed AS (
  SELECT *, CASE WHEN due_amt > 0 THEN CAST(CEIL(overdue_amt / due_amt) AS INT) END AS installments_missed FROM loan_l
), loan_d0 AS (
  SELECT *, CASE WHEN installments_missed > 0
                 THEN CAST(snapshot_date - to_months(installments_missed) AS DATE) END AS first_missed_date FROM missed
), loan_d AS (
  SELECT *, CASE WHEN installments_missed <= 0 THEN 0
                 ELSE CAST(snapshot_date - first_missed_date AS INT) END AS dpd FROM loan_d0)"""
)


def loan_l(t: Tables) -> DataFrame:
    return t["lineitem"].select(
        F.col("l_orderkey").alias("loan_id"),
        F.col("l_linenumber").alias("mob"),
        F.to_date("l_shipdate").alias("snapshot_date"),
        F.col("l_quantity").alias("due_amt"),
        F.greatest(F.col("l_linenumber") * 8 - F.col("l_quantity"), F.lit(0.0)).alias("overdue_amt"),
    )


def loan_d(t: Tables) -> DataFrame:
    return loan_delinquency(loan_l(t), installment=None)


# ---- scored rows ----

SCORES = """scores AS (
  SELECT event_id, user_id, CAST(DATE_TRUNC('week', ts) AS DATE) AS month,
         CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS label, LEAST(value / 500.0, 1.0) AS score
  FROM events)"""


def scores(t: Tables) -> DataFrame:
    return t["events"].select(
        "event_id",
        "user_id",
        F.to_date(F.date_trunc("week", "ts")).alias("month"),
        F.when(F.col("event_type") == "error", 1).otherwise(0).alias("label"),
        F.least(F.col("value") / 500.0, F.lit(1.0)).alias("score"),
    )


# ---- raw text ----

DIRTY = """dirty AS (
  SELECT l_orderkey, l_linenumber,
         CONCAT(CAST(CAST(l_quantity AS INT) AS VARCHAR), CASE WHEN l_linenumber % 3 = 0 THEN '_' ELSE '' END) AS q_txt,
         CONCAT(CAST(l_linenumber AS VARCHAR), ' Years and ', CAST(l_suppkey % 12 AS VARCHAR), ' Months') AS age_txt
  FROM lineitem)"""


def dirty(t: Tables) -> DataFrame:
    return t["lineitem"].select(
        "l_orderkey",
        "l_linenumber",
        F.concat(
            F.col("l_quantity").cast("int").cast("string"), F.when(F.col("l_linenumber") % 3 == 0, "_").otherwise("")
        ).alias("q_txt"),
        F.concat_ws(
            "", F.col("l_linenumber"), F.lit(" Years and "), F.col("l_suppkey") % 12, F.lit(" Months")
        ).alias("age_txt"),
    )
