"""Steps that must not gather in few tasks, or one after the other, as the tables grow."""

import random

import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import functions as F

from riskflow.operators import metrics, modeling, ordered, state


def test_a_bucket_of_the_state_is_merged_by_several_tasks(spark):
    rows = spark.range(400).select(
        F.col("id").cast("string").alias("Customer_ID"), F.expr("date_add(date'2024-01-01', int(id % 3))").alias("snapshot_date"), F.col("id").alias("v")
    )
    conf = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(conf)
    spark.conf.set(conf, "false")
    try:
        merged = state.merge(None, rows, state.Kept(), "2024-02-01", buckets=1)
        found = merged.select("v", state.BUCKET, F.spark_partition_id().alias("task")).collect()
    finally:
        spark.conf.set(conf, before)
    assert sorted(r["v"] for r in found) == list(range(400)) and {r[state.BUCKET] for r in found} == {0}
    assert len({r["task"] for r in found}) > 1


def scored(spark, n=3000):
    rng = random.Random(4)
    rows = [(rng.choice(["a", "b", None]), rng.choice([0, 1, 1, None]), rng.choice([rng.random(), 0.5, float("nan"), None])) for _ in range(n)]
    rows += [("c", 1, 0.1), ("c", 1, 0.2), ("d", 0, 0.3)]
    return spark.createDataFrame(rows, "g string, label int, score double")


def test_area_needs_no_written_ranges(spark, monkeypatch):
    df = scored(spark).repartition(5)
    plain = {r["g"]: r for r in metrics.ranking_metrics(df, ["g"]).collect()}

    def refused(*_, **__):
        raise AssertionError("ranges are written")

    monkeypatch.setattr(ordered, "cut_order", refused)
    found = {r["g"]: r for r in metrics.area_under_curve(df, ["g"]).collect()}
    assert set(found) == set(plain) == {"a", "b", "c", "d"} and found["c"]["auc"] is None and found["d"]["auc"] is None
    for g in found:
        assert (found[g]["n_pos"], found[g]["n_neg"]) == (plain[g]["n_pos"], plain[g]["n_neg"])
    assert all(found[g]["auc"] == pytest.approx(plain[g]["auc"], abs=1e-12) for g in "ab")
    model = modeling.fit_logistic(df.where("g = 'a' AND label IS NOT NULL AND score IS NOT NULL AND NOT isnan(score)"), ["score"])
    kept = df.where("label IS NOT NULL AND score IS NOT NULL AND NOT isnan(score)")
    assert {r["g"] for r in modeling.evaluate(model, kept, split="g").collect()} == {"a", "b", "c", "d"}


def test_search_ranks_all_models_in_one_plan(spark, monkeypatch):
    rng = random.Random(9)
    rows = [(str(i), rng.random(), rng.random()) for i in range(300)]
    train = spark.createDataFrame(rows, "Customer_ID string, x double, y double").withColumn("label", (F.col("x") + F.col("y") * F.rand(3) > 0.8).cast("int")).localCheckpoint()
    fold = F.pmod(F.xxhash64("Customer_ID", F.lit(7)), F.lit(3)).cast("int")
    data = modeling.Pipeline(stages=modeling.preprocessing(["x", "y"])).fit(train).transform(train).withColumn("fold", fold).withColumn("label", F.col("label").cast("double"))
    lr = modeling.logistic()
    maps = [{lr.regParam: 1.0 / (c * 200), lr.elasticNetParam: 0.0} for c in (0.01, 1.0)]
    judge = BinaryClassificationEvaluator(labelCol="label", metricName="areaUnderROC", numBins=0)
    expected = CrossValidator(estimator=lr, estimatorParamMaps=maps, evaluator=judge, numFolds=3, foldCol="fold").fit(data).avgMetrics

    def refused(*_, **__):
        raise AssertionError("one evaluation after the other")

    monkeypatch.setattr(BinaryClassificationEvaluator, "_evaluate", refused)
    assert modeling.cross_validated(lr, data, maps, 3, "label") == pytest.approx(expected, abs=1e-6)
    assert len(modeling.search(train, ["x", "y"], n_trials=2).trials) == 2
    assert isinstance(lr, LogisticRegression)
