"""Training and scoring. Model fits have no SQL counterpart; their tests compare with known behaviour."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.operators import dataset as D
from riskflow.operators import modeling as M
from riskflow.operators import stages as P
from riskflow.queries.registry import Tables, query
from riskflow.session import scratch_dir
from riskflow.sources.sinks import materialise

FEATURES = ["quantity", "price", "discount", "tax", "lines", "day"]


def training_set(t: Tables) -> DataFrame:
    """Orders with totals of their lines, split and written once for the many passes of a fit. The label mixes
    features with the order total, which is none of them."""
    lines = t["lineitem"].groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum("l_quantity").alias("quantity"),
        (F.sum("l_extendedprice") / 1000).alias("price"),
        F.avg("l_discount").alias("discount"),
        F.avg("l_tax").alias("tax"),
        F.count(F.lit(1)).cast("double").alias("lines"),
    )
    data = t["orders"].join(lines, "o_orderkey").select(
        F.col("o_orderkey").cast("string").alias("Customer_ID"),
        F.trunc(F.to_date("o_orderdate"), "MM").alias("snapshot_date"),
        "quantity",
        "price",
        "discount",
        "tax",
        "lines",
        F.dayofmonth("o_orderdate").cast("double").alias("day"),
        ((F.col("price") + F.col("o_totalprice") / 2000 + 200 * F.col("discount")) > 280).cast("int").alias("label"),
    )
    whole = materialise(data, scratch_dir(t.spark, "training_rows"))  # the split reads them several times
    return materialise(D.stratified_split(whole, "label", "Customer_ID"), scratch_dir(t.spark, "training_set"))


def _evaluated(model: PipelineModel, data: DataFrame, name: str) -> DataFrame:
    return M.evaluate(model, data).withColumn("model", F.lit(name)).withColumn("auc", F.round("auc", 6))


@query("train_lr")
def train_lr(t: Tables) -> DataFrame:
    """Class-balanced logistic regression; AUC and Gini of train and test."""
    data = D.add_class_weight(training_set(t))
    model = M.fit_logistic(data.where("split = 'train'"), FEATURES, weight="weight")
    return _evaluated(model, data, "lr")


@query("train_gbt")
def train_gbt(t: Tables) -> DataFrame:
    """One boosted-tree model; AUC and Gini of train and test."""
    data = training_set(t)
    model = M.fit_boosted(data.where("split = 'train'"), FEATURES, maxIter=25, maxDepth=2, stepSize=0.1)
    return _evaluated(model, data, "gbt")


@query("cv_search")
def cv_search(t: Tables) -> DataFrame:
    """Random search over penalties, all draws, with three folds; one row per trial."""
    found = M.search(training_set(t).where("split = 'train'"), FEATURES)
    rows = [(x["C"], x["penalty"], round(x["cv_auc"], 6)) for x in found.trials]
    return t.spark.createDataFrame(rows, "C double, penalty string, cv_auc double")


def _fitted(t: Tables, C: float = 1.0, data: DataFrame | None = None) -> tuple[PipelineModel, DataFrame]:
    data = training_set(t) if data is None else data
    return M.fit_logistic(data.where("split = 'train'"), FEATURES, C=C), data


@query("score_batch")
def score_batch(t: Tables) -> DataFrame:
    """Predictions of all months in one plan, from a model that was saved and loaded again."""
    model, data = _fitted(t)
    path = f"{scratch_dir(t.spark, 'model')}/lr"
    model.write().overwrite().save(path)
    return M.predictions(PipelineModel.load(path), data, "LR")


@query("coefficients")
def coefficients(t: Tables) -> DataFrame:
    model, _ = _fitted(t)
    return M.coefficients(model, FEATURES, t.spark)


@query("model_runs")
def model_runs(t: Tables) -> DataFrame:
    """The run log after two trainings, and the AUC of the newest model, loaded by name and scored again."""
    base, data = scratch_dir(t.spark, "runs"), None
    for day, C in (("2024-07-01", 0.01), ("2024-08-01", 1.0)):
        model, data = _fitted(t, C, data)
        path = f"{base}/lr_{day}"
        model.write().overwrite().save(path)
        M.record_run(
            t.spark,
            f"{base}/log",
            model_name="LR",
            model_path=path,
            train_date=day,
            parameters={"C": C, "penalty": "l2"},
            metrics=M.evaluate(model, data),
            sizes=D.split_stats(data),
        )
    loaded = M.evaluate(M.latest_model(t.spark, f"{base}/log", "LR"), data)
    again = loaded.agg(F.map_from_entries(F.collect_list(F.struct("split", "auc"))).alias("loaded_auc")).first()["loaded_auc"]
    loaded_auc = F.create_map(*[F.lit(x) for pair in sorted(again.items()) for x in pair])
    return t.spark.read.parquet(f"{base}/log").drop("created_at", "model_path").withColumn("loaded_auc", loaded_auc)


# ---- fitted preprocessing ----

_PREPARED = ["quantity", "price", "discount", "tax", "lines", "day", "rare", "flat"]
_PREPARED_SQL = """WITH s AS (
  SELECT l_orderkey AS k, SUM(l_quantity) AS quantity, SUM(l_extendedprice) / 1000 AS price, AVG(l_discount) AS discount, AVG(l_tax) AS tax,
    CAST(COUNT(*) AS DOUBLE) AS lines FROM lineitem GROUP BY 1),
d AS (
  SELECT quantity, CASE WHEN k % 3 <> 0 THEN price END AS price, CASE WHEN k % 4 <> 1 THEN discount END AS discount, tax, lines,
    CAST(DAYOFMONTH(o_orderdate) AS DOUBLE) AS day, CASE WHEN k % 5 < 2 THEN lines END AS rare, CASE WHEN k % 7 <> 0 THEN 3.0::DOUBLE END AS flat,
    o_orderpriority AS priority, CASE WHEN price + o_totalprice / 2000 + 200 * discount > 280 THEN 1 ELSE 0 END AS label
  FROM orders JOIN s ON k = o_orderkey),
n AS (SELECT COUNT(*) AS n, SUM(label) AS pos FROM d),
m AS (SELECT MEDIAN(quantity) AS quantity, MEDIAN(price) AS price, MEDIAN(discount) AS discount, MEDIAN(tax) AS tax, MEDIAN(lines) AS lines,
  MEDIAN(day) AS day, MEDIAN(flat) AS flat FROM d),
i AS (SELECT label, COALESCE(d.quantity, m.quantity) AS quantity, COALESCE(d.price, m.price) AS price, COALESCE(d.discount, m.discount) AS discount,
  COALESCE(d.tax, m.tax) AS tax, COALESCE(d.lines, m.lines) AS lines, COALESCE(d.day, m.day) AS day FROM d, m),
c AS (""" + " UNION ALL ".join(f"SELECT '{c}' AS feature, CORR({c}, label) AS value FROM i" for c in _PREPARED[:6]) + """)
SELECT 'CategoryFlags' AS stage, priority AS feature, CAST(row_number() OVER (ORDER BY COUNT(*) DESC, priority) AS DOUBLE) AS value, TRUE AS kept
FROM d GROUP BY priority QUALIFY value <= 2
""" + "".join(f"""UNION ALL SELECT 'MissingRateFilter', '{c}', ROUND(1 - COUNT({c}) / COUNT(*), 8), 1 - COUNT({c}) / COUNT(*) < 0.5 FROM d
""" for c in _PREPARED) + "".join(f"UNION ALL SELECT 'MedianImputer', '{c}', ROUND({c}, 8), TRUE FROM m\n" for c in _PREPARED if c != "rare") + "".join(
    f"UNION ALL SELECT 'ConstantFilter', '{c}', {float(c == 'flat')}::DOUBLE, {c != 'flat'}\n" for c in _PREPARED if c != "rare") + """
UNION ALL SELECT 'CorrelationFilter', feature, ROUND(value, 8), row_number() OVER (ORDER BY ABS(value) DESC, feature) <= 3 FROM c
UNION ALL SELECT 'ClassWeight', '0', ROUND(n / (2.0 * (n - pos)), 8), TRUE FROM n UNION ALL SELECT 'ClassWeight', '1', ROUND(n / (2.0 * pos), 8), TRUE FROM n
"""  # fmt: skip


@query("fitted_preprocessing", _PREPARED_SQL)
def fitted_preprocessing(t: Tables) -> DataFrame:
    """What the stages learn from data with gaps, a rare and a constant feature, saved and loaded again."""
    lines = t["lineitem"].groupBy("l_orderkey").agg(
        F.sum("l_quantity").alias("quantity"), (F.sum("l_extendedprice") / 1000).alias("price"), F.avg("l_discount").alias("discount"),
        F.avg("l_tax").alias("tax"), F.count(F.lit(1)).cast("double").alias("lines"),
    )
    k = F.col("o_orderkey")
    data = t["orders"].join(lines, k == F.col("l_orderkey")).select(
        "quantity", F.when(k % 3 != 0, F.col("price")).alias("price"), F.when(k % 4 != 1, F.col("discount")).alias("discount"), "tax", "lines",
        F.dayofmonth("o_orderdate").cast("double").alias("day"), F.when(k % 5 < 2, F.col("lines")).alias("rare"), F.when(k % 7 != 0, F.lit(3.0)).alias("flat"),
        F.col("o_orderpriority").alias("priority"), ((F.col("price") + F.col("o_totalprice") / 2000 + 200 * F.col("discount")) > 280).cast("int").alias("label"),
    )
    data = materialise(data, scratch_dir(t.spark, "gaps"))
    flags = [P.CategoryFlags(inputCol="priority", outputCol="flags", k=2)]
    model = Pipeline(stages=[*flags, *P.preparation(_PREPARED, k=3, weight="weight")]).fit(data)
    path = f"{scratch_dir(t.spark, 'prepared')}/model"
    model.write().overwrite().save(path)
    return P.fitted_values(PipelineModel.load(path), t.spark).withColumn("value", F.round("value", 8))


# ---- fits with a closed form ----
# With one 0/1 feature an unpenalised logistic regression gives each of the two groups its own (weighted) share of positives, and a single
# split of a boosted tree its mean label, whatever the solver.

_FLAG_SQL = """WITH s AS (SELECT l_orderkey AS k, SUM(l_extendedprice) / 1000 AS price, COUNT(*) AS lines FROM lineitem GROUP BY 1),
d AS (SELECT k, CAST(k AS VARCHAR) AS "Customer_ID", CAST(DATE_TRUNC('month', o_orderdate) AS DATE) AS snapshot_date, CASE WHEN lines >= 5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS many,
  CASE WHEN price + o_totalprice / 2000 > 220 THEN 1 ELSE 0 END AS label FROM orders JOIN s ON k = o_orderkey),
r AS (SELECT *, COUNT(*) OVER (PARTITION BY label) AS n, ROW_NUMBER() OVER (PARTITION BY label ORDER BY MD5("Customer_ID" || '|88'), "Customer_ID") AS rn FROM d),
t AS (SELECT *, CASE WHEN rn <= FLOOR(CAST(0.8 AS DOUBLE) * n) THEN 'train' ELSE 'test' END AS split FROM r),
w AS (SELECT COUNT(*) / (2.0 * SUM(label)) AS w1, COUNT(*) / (2.0 * SUM(1 - label)) AS w0 FROM t WHERE split = 'train'),
p AS (SELECT many, AVG(label) AS share, SUM(label * w1) / SUM(label * w1 + (1 - label) * w0) AS weighted FROM t, w WHERE split = 'train' GROUP BY many)"""


def _flagged(t: Tables) -> DataFrame:
    """Orders with one 0/1 feature, split and written once."""
    lines = t["lineitem"].groupBy("l_orderkey").agg((F.sum("l_extendedprice") / 1000).alias("price"), F.count(F.lit(1)).alias("lines"))
    data = t["orders"].join(lines, F.col("o_orderkey") == F.col("l_orderkey")).select(
        F.col("o_orderkey").cast("string").alias("Customer_ID"),
        F.trunc(F.to_date("o_orderdate"), "MM").alias("snapshot_date"),
        F.when(F.col("lines") >= 5, 1.0).otherwise(0.0).alias("many"),
        (F.col("price") + F.col("o_totalprice") / 2000 > 220).cast("int").alias("label"),
    )
    whole = materialise(data, scratch_dir(t.spark, "flagged_rows"))
    return materialise(D.stratified_split(whole, "label", "Customer_ID"), scratch_dir(t.spark, "flagged"))


def _unpenalised(data: DataFrame, weight: str | None = None) -> PipelineModel:
    return M.fit_logistic(data.where("split = 'train'"), ["many"], weight=weight, C=1e12)


@query(
    "newest_model_scores",
    _FLAG_SQL + """ SELECT "Customer_ID", snapshot_date, 'LR' AS model_name, ROUND(share, 3) AS model_predictions FROM t JOIN p USING (many)""",
)
def newest_model_scores(t: Tables) -> DataFrame:
    """Two trainings are logged; the newest, loaded by name, scores all rows. The older one has its labels turned round."""
    data, base = _flagged(t), scratch_dir(t.spark, "closed")
    for day, rows in (("2024-07-01", data.withColumn("label", 1 - F.col("label"))), ("2024-08-01", data)):
        model, path = _unpenalised(rows), f"{base}/lr_{day}"
        model.write().overwrite().save(path)
        M.record_run(
            t.spark, f"{base}/log", model_name="LR", model_path=path, train_date=day, parameters={}, metrics=M.evaluate(model, rows), sizes=D.split_stats(rows)
        )
    scored = M.predictions(M.latest_model(t.spark, f"{base}/log", "LR"), data, "LR")
    return scored.withColumn("model_predictions", F.round("model_predictions", 3))


@query(
    "balanced_logistic",
    _FLAG_SQL + """ SELECT many, split, COUNT(*) AS n, ROUND(MAX(weighted), 3) AS score FROM t JOIN p USING (many) GROUP BY 1, 2""",
)
def balanced_logistic(t: Tables) -> DataFrame:
    """With class weights as a fitted stage the scores are shares of weighted positives."""
    data = _flagged(t)
    weigher = P.ClassWeight().fit(data.where("split = 'train'"))
    scored = M.score(_unpenalised(weigher.transform(data), "weight"), data, "score")
    return scored.groupBy("many", "split").agg(F.count(F.lit(1)).alias("n"), F.round(F.max("score"), 3).alias("score"))


_AUC_SQL = """, c AS (SELECT split, SUM(CASE WHEN many = 1 THEN label END) / SUM(label) AS tpr, SUM(CASE WHEN many = 1 THEN 1 - label END) / SUM(1 - label) AS fpr
  FROM t GROUP BY split), up AS (SELECT CASE WHEN MAX(CASE WHEN many = 1 THEN share END) > MAX(CASE WHEN many = 0 THEN share END) THEN 1 ELSE -1 END AS s FROM p)
SELECT split, ROUND(0.5 + s * (tpr - fpr) / 2, 6) AS auc, ROUND(s * (tpr - fpr), 3) AS gini FROM c, up"""


@query("auc_of_a_model", _FLAG_SQL + _AUC_SQL)
def auc_of_a_model(t: Tables) -> DataFrame:
    """Two scores give a ranking whose area is half of one plus the difference of the two rates."""
    data = _flagged(t)
    return M.evaluate(_unpenalised(data), data).withColumn("auc", F.round("auc", 6))


@query(
    "coefficient_of_a_flag",
    _FLAG_SQL + """, x AS (SELECT STDDEV_SAMP(many) AS sd FROM t WHERE split = 'train'),
    l AS (SELECT MAX(CASE WHEN many = 1 THEN LN(share / (1 - share)) END) - MAX(CASE WHEN many = 0 THEN LN(share / (1 - share)) END) AS odds FROM p)
    SELECT 'many' AS feature, ROUND(odds * sd, 2) AS coefficient, ROUND(ABS(odds * sd), 2) AS abs_coefficient FROM l, x""",
)
def coefficient_of_a_flag(t: Tables) -> DataFrame:
    """The log odds ratio, times the deviation that the feature was scaled by."""
    found = M.coefficients(_unpenalised(_flagged(t)), ["many"], t.spark)
    return found.select("feature", *[F.round(c, 2).alias(c) for c in ("coefficient", "abs_coefficient")])


@query(
    "boosted_closed_form",
    _FLAG_SQL + """ SELECT many, split, COUNT(*) AS n, ROUND(MAX(1 / (1 + EXP(-2 * (2 * share - 1)))), 6) AS score FROM t JOIN p USING (many) GROUP BY 1, 2""",
)
def boosted_closed_form(t: Tables) -> DataFrame:
    """One tree of one split predicts the mean of labels -1 and 1; the score is the logistic function of twice that."""
    data = _flagged(t)
    model = M.fit_boosted(data.where("split = 'train'"), ["many"], maxIter=1, maxDepth=1)
    return M.score(model, data, "score").groupBy("many", "split").agg(F.count(F.lit(1)).alias("n"), F.round(F.max("score"), 6).alias("score"))
