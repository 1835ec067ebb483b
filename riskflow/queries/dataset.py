from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.operators import dataset as D
from riskflow.queries import views as V
from riskflow.queries.registry import Tables, query

_SPLIT = f"""WITH {V.SCORES}, r AS (SELECT event_id, label, COUNT(*) OVER (PARTITION BY label) AS n,
  ROW_NUMBER() OVER (PARTITION BY label ORDER BY MD5(CAST(event_id AS VARCHAR) || '|88'), event_id) AS rn FROM scores),
 s AS (SELECT event_id, label, CASE WHEN rn <= FLOOR(CAST(0.8 AS DOUBLE) * n) THEN 'train' ELSE 'test' END AS split FROM r)"""


@query("stratified_split", _SPLIT + " SELECT event_id, label, split FROM s")
def stratified_split(t: Tables) -> DataFrame:
    return D.stratified_split(V.scores(t).select("event_id", "label"), "label", "event_id")


@query("split_stats", _SPLIT + " SELECT split, COUNT(*) AS n_rows, ROUND(AVG(label), 2) AS mean_label FROM s GROUP BY 1")
def split_stats(t: Tables) -> DataFrame:
    return D.split_stats(D.stratified_split(V.scores(t).select("event_id", "label"), "label", "event_id"))


@query(
    "temporal_split",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS snapshot_date, CASE WHEN o_orderdate >= DATE '1999-01-01' THEN 'oot'
    ELSE 'train_test' END AS period FROM orders WHERE o_orderdate >= DATE '1998-01-01' AND o_orderdate < DATE '1999-03-01'""",
)
def temporal_split(t: Tables) -> DataFrame:
    dated = t["orders"].select("o_orderkey", F.to_date("o_orderdate").alias("snapshot_date"))
    return D.tag_time_split(dated, D.time_split("1999-03-01"))


@query(
    "median_impute",
    f"""WITH {V.CLICKS}, m AS (SELECT MEDIAN(fe_1) AS m1, MEDIAN(fe_2) AS m2 FROM clicks)
    SELECT customer_id, snapshot_date, ROUND(COALESCE(fe_1, m1), 4) AS fe_1, ROUND(COALESCE(fe_2, m2), 4) AS fe_2 FROM clicks, m""",
)
def median_impute(t: Tables) -> DataFrame:
    filled = D.impute_median(V.clicks(t).drop("fe_3", "fe_4"), ["fe_1", "fe_2"])
    return filled.withColumns({c: F.round(c, 4) for c in ("fe_1", "fe_2")})


@query(
    "constant_features",
    """SELECT 'l_quantity' AS feature, COUNT(DISTINCT l_quantity) <= 1 AS is_constant FROM lineitem UNION ALL
    SELECT 'l_tax', COUNT(DISTINCT l_tax) <= 1 FROM lineitem UNION ALL SELECT 'tenure', TRUE UNION ALL SELECT 'empty', TRUE""",
)
def constant_features(t: Tables) -> DataFrame:
    lines = t["lineitem"].withColumns({"tenure": F.lit(10), "empty": F.lit(None).cast("double")})
    return D.constant_features(lines, ["l_quantity", "l_tax", "tenure", "empty"])


@query(
    "missing_rate_filter",
    f"WITH {V.CLICKS} "
    + " UNION ALL ".join(
        f"""SELECT 'fe_{i}' AS feature, ROUND(1 - COUNT(fe_{i}) / COUNT(*), 8) AS missing_rate,
        1 - COUNT(fe_{i}) / COUNT(*) < 0.38 AS keep FROM clicks"""
        for i in range(1, 5)
    ),
)
def missing_rate_filter(t: Tables) -> DataFrame:
    rates = D.missing_rates(V.clicks(t), [f"fe_{i}" for i in range(1, 5)], 0.38)
    return rates.withColumn("missing_rate", F.round("missing_rate", 8))


@query(
    "class_weight",
    f"""WITH {V.SCORES} SELECT COUNT(*) AS n, CAST(SUM(label) AS BIGINT) AS n_pos,
    ROUND((COUNT(*) - SUM(label)) / SUM(label), 8) AS imbalance_ratio,
    ROUND(COUNT(*) / (2.0 * (COUNT(*) - SUM(label))), 8) AS weight_neg, ROUND(COUNT(*) / (2.0 * SUM(label)), 8) AS weight_pos FROM scores""",
)
def class_weight(t: Tables) -> DataFrame:
    out = D.class_weights(V.scores(t))
    return out.withColumns({c: F.round(c, 8) for c in ("imbalance_ratio", "weight_neg", "weight_pos")})


@query(
    "standardise",
    """WITH m AS (SELECT AVG(value) AS mu, STDDEV_POP(value) AS sd FROM events WHERE ts < TIMESTAMP '2024-01-22')
    SELECT event_id, ROUND((value - mu) / sd, 6) AS value, 0.0::DOUBLE AS flat FROM events, m""",
)
def standardise(t: Tables) -> DataFrame:
    events = t["events"].select("event_id", "ts", "value", F.lit(3.0).alias("flat"))
    train = events.where(F.col("ts") < F.lit("2024-01-22").cast("timestamp_ntz"))
    scaled = D.standardise(events, ["value", "flat"], fitted_on=train)
    return scaled.select("event_id", F.round("value", 6).alias("value"), "flat")
