"""Training, scoring and the log of training runs, on pyspark.ml."""

from __future__ import annotations

import json
import random
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone
from functools import reduce
from itertools import product
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from riskflow.constants import FOLDS, SEARCH_SEED, SPLIT_SEED
from riskflow.operators.metrics import area_under_curve, overfit_check
from riskflow.sources.sinks import write_snapshots

# --- fixed values: search spaces ---
# Logistic regression: ten inverse penalties from 0.001 to 1000 on a log scale, with an L1 or an L2 penalty.
LR_SPACE = {
    "C": [10 ** (-3 + 6 * i / 9) for i in range(10)],
    "penalty": ["l1", "l2"],
}
# Boosted trees.
GBT_SPACE = {
    "maxIter": [25, 50],
    "maxDepth": [2, 3],
    "stepSize": [0.01, 0.1],
    "subsamplingRate": [0.6, 0.8],
    "featureSubsetStrategy": ["0.6", "0.8"],
    "minInfoGain": [0.0, 0.1],
    "minInstancesPerNode": [1, 3, 5],
}


@dataclass(frozen=True)
class Trained:
    model: PipelineModel
    parameters: dict
    cv_auc: float | None = None
    trials: list[dict] = field(default_factory=list)


def draw(space: Mapping[str, Sequence], n: int, seed: int = SEARCH_SEED) -> list[dict]:
    """n different points of the grid, or the whole grid if it is smaller."""
    grid = [dict(zip(space, point)) for point in product(*space.values())]
    return grid if n >= len(grid) else random.Random(seed).sample(grid, n)


def scaler() -> StandardScaler:
    return StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True)


def preprocessing(features: Sequence[str], scale: bool = True) -> list:
    """Vector of the features, nulls rejected (fill them first), scaled to zero mean and unit deviation."""
    assembler = VectorAssembler(inputCols=list(features), outputCol="raw_features", handleInvalid="error")
    return [assembler, scaler()] if scale else [assembler.copy({assembler.outputCol: "features"})]


def logistic(label: str = "label", weight: str | None = None, max_iter: int = 1000) -> LogisticRegression:
    lr = LogisticRegression(labelCol=label, featuresCol="features", maxIter=max_iter, standardization=False)
    return lr.setWeightCol(weight) if weight else lr


def boosted(label: str = "label", seed: int = SPLIT_SEED) -> GBTClassifier:
    return GBTClassifier(labelCol=label, featuresCol="features", seed=seed)


def _lr_params(lr: LogisticRegression, point: Mapping, n: float) -> dict:
    return {lr.regParam: 1.0 / (point["C"] * n), lr.elasticNetParam: 1.0 if point["penalty"] == "l1" else 0.0}


def fit_logistic(
    train: DataFrame, features: Sequence[str], label: str = "label", weight: str | None = None, C: float = 1.0
) -> PipelineModel:
    """One logistic regression with an L2 penalty, rows optionally weighted by class."""
    lr = logistic(label, weight).setElasticNetParam(0.0).setRegParam(1.0 / (C * train.count()))
    return Pipeline(stages=[*preprocessing(features), lr]).fit(train)


def fit_boosted(train: DataFrame, features: Sequence[str], label: str = "label", **parameters) -> PipelineModel:
    """One gradient-boosted tree model."""
    return Pipeline(stages=[*preprocessing(features), boosted(label).setParams(**parameters)]).fit(train)


def cross_validated(estimator, data: DataFrame, maps: Sequence[Mapping], folds: int, label: str, parallelism: int = 4) -> list[float]:
    """For each parameter map, the area under the ROC curve of held-out rows, averaged over the folds (column ``fold``).

    All models score their held-out rows in one plan, which counts rows per (fold, point, score) and ranks these counts by ranges,
    so the ranking of all points is one job over all cores, not one after the other.
    """
    sizes = {r["fold"]: r["count"] for r in data.groupBy("fold").count().collect()}
    for i in range(folds):
        if not sizes.get(i) or sizes[i] == sum(sizes.values()):
            raise ValueError(f"The train or validation data at fold {i} is empty.")

    def fitted(job: tuple[int, int]):
        return estimator.fit(data.where(F.col("fold") != job[0]), maps[job[1]])

    jobs = list(product(range(folds), range(len(maps))))
    with ThreadPool(parallelism) as pool:
        models = dict(zip(jobs, pool.map(inheritable_thread_target(data.sparkSession)(fitted), jobs, chunksize=1)))
    parts = []
    for i in range(folds):
        held = data.where(F.col("fold") == i)
        for j in range(len(maps)):
            held = models[i, j].setRawPredictionCol(f"raw{j}").setProbabilityCol("").setPredictionCol("").transform(held)
        scores = F.array(*[F.struct(F.lit(j).alias("point"), vector_to_array(f"raw{j}")[1].alias("score")) for j in range(len(maps))])
        parts.append(held.select("fold", label, F.inline(scores)))
    ranked = area_under_curve(reduce(DataFrame.unionByName, parts), ["fold", "point"], label)
    # A fold of one class has the area of its one-sided curve.
    area = F.coalesce("auc", F.when(F.col("n_pos") > 0, 1.0).otherwise(0.0))
    found = {r["point"]: r["cv_auc"] for r in ranked.groupBy("point").agg(F.avg(area).alias("cv_auc")).collect()}
    return [found[j] for j in range(len(maps))]


def search(
    train: DataFrame,
    features: Sequence[str],
    label: str = "label",
    kind: str = "lr",
    key: str = "Customer_ID",
    n_trials: int = 10,
    folds: int = FOLDS,
    seed: int = SEARCH_SEED,
    parallelism: int = 4,
    stages: Sequence | None = None,
    weight: str | None = None,
) -> Trained:
    """Random search with cross-validation, scored by the area under the ROC curve of the probabilities.

    A row's fold follows from a hash of its key, so a rerun after a lost executor sees the same folds. ``stages`` (those of
    ``stages.preparation``) replace the plain vector of the features; they are fitted on ``train`` and saved with
    the model. ``weight`` names the column that one of them adds.
    """
    fold = F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(folds)).cast("int")
    prepared = Pipeline(stages=preprocessing(features) if stages is None else [*stages, scaler()]).fit(train)
    data = prepared.transform(train).select(
        "features", F.col(label).cast("double").alias(label), fold.alias("fold"), *([weight] if weight else [])
    )
    data = data.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n = data.count()
        if kind == "lr":
            estimator = logistic(label, weight)
            points = draw(LR_SPACE, n_trials, seed)
            maps = [_lr_params(estimator, p, n * (folds - 1) / folds) for p in points]
        else:
            estimator = boosted(label).setWeightCol(weight) if weight else boosted(label)
            points = draw(GBT_SPACE, n_trials, seed)
            maps = [{estimator.getParam(name): value for name, value in p.items()} for p in points]
        found = cross_validated(estimator, data, maps, folds, label, parallelism)
        best = max(range(len(points)), key=lambda i: found[i])
        # The penalty is per row: a fit on all rows needs a smaller one than those on the training folds.
        chosen = estimator.fit(data, _lr_params(estimator, points[best], n) if kind == "lr" else maps[best])
    finally:
        data.unpersist()
    trials = [{**p, "cv_auc": a} for p, a in zip(points, found)]
    model = PipelineModel(stages=[*prepared.stages, chosen])
    return Trained(model, points[best], found[best], trials)


# ---- scoring and evaluation ----


def score(model: PipelineModel, df: DataFrame, column: str = "model_predictions") -> DataFrame:
    """All columns of ``df`` and the probability of the positive class."""
    return model.transform(df).select(*df.columns, vector_to_array("probability")[1].alias(column))


def predictions(
    model: PipelineModel, features: DataFrame, model_name: str, keys: Sequence[str] = ("Customer_ID", "snapshot_date")
) -> DataFrame:
    return score(model, features).select(*keys, F.lit(model_name).alias("model_name"), "model_predictions")


def evaluate(model: PipelineModel, df: DataFrame, split: str = "split", label: str = "label") -> DataFrame:
    """AUC and Gini (three digits) per split."""
    scored = score(model, df.select("*"), "__score")
    areas = area_under_curve(scored, [split], label, "__score")
    return areas.select(split, "auc", F.round(2 * F.col("auc") - 1, 3).alias("gini"))


def overfit(model: PipelineModel, df: DataFrame, split: str = "split", label: str = "label") -> DataFrame:
    return overfit_check(evaluate(model, df, split, label), split)


def coefficients(model: PipelineModel, features: Sequence[str], spark: SparkSession) -> DataFrame:
    """Features of a logistic regression by size of their coefficient."""
    values = [float(v) for v in model.stages[-1].coefficients]
    table = spark.createDataFrame(list(zip(features, values)), "feature string, coefficient double")
    return table.withColumn("abs_coefficient", F.abs("coefficient")).orderBy(F.desc("abs_coefficient"), "feature")


# ---- run log ----


def record_run(
    spark: SparkSession,
    log: str,
    *,
    model_name: str,
    model_path: str,
    train_date: str,
    parameters: Mapping,
    metrics: DataFrame,
    sizes: DataFrame,
    split: str = "split",
) -> str:
    """One row per model and training date: parameters, AUC, Gini and size of every split, where the model is. A run that is
    repeated replaces its row."""
    found = metrics.join(sizes, split, "left").collect()
    row = {
        "model_name": model_name,
        "model_version": f"{model_name}_{train_date.replace('-', '_')}",
        "model_path": model_path,
        "train_date": train_date,
        "created_at": datetime.now(timezone.utc).replace(tzinfo=None),
        "parameters": json.dumps(dict(parameters), sort_keys=True),
        "auc": {r[split]: float(r["auc"]) for r in found if r["auc"] is not None},
        "gini": {r[split]: float(r["gini"]) for r in found if r["gini"] is not None},
        "n_rows": {r[split]: int(r["n_rows"]) for r in found if r["n_rows"] is not None},
    }
    schema = (
        "model_name string, model_version string, model_path string, train_date string, created_at timestamp_ntz, "
        "parameters string, auc map<string,double>, gini map<string,double>, n_rows map<string,bigint>"
    )
    return write_snapshots(spark.createDataFrame([row], schema), log, "model_version", rebalance=False)


def latest_model(spark: SparkSession, log: str, model_name: str, fallback: str | None = None) -> PipelineModel:
    """The newest logged model of that name, or the one at ``fallback`` if none is logged."""
    try:
        runs = spark.read.parquet(log).where(F.col("model_name") == model_name)
        newest = runs.orderBy(F.desc("train_date"), F.desc("created_at")).select("model_path").first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        newest = None
    path = newest.model_path if newest else fallback
    if path is None:
        raise FileNotFoundError(f"no run of {model_name} in {log}")
    return PipelineModel.load(path)
