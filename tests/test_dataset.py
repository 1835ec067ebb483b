import math
from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskflow.operators import dataset as D
from riskflow.operators import profiling as P


def test_time_split():
    s = D.time_split("2024-08-01")
    assert [str(x) for x in (s.train_test_start, s.train_test_end, s.oot_start, s.oot_end)] == [
        "2023-06-01", "2024-05-31", "2024-06-01", "2024-07-31",
    ]


def test_months_before_keeps_to_the_month():
    assert D.months_before(date(2024, 3, 31), 1) == date(2024, 2, 29)
    assert D.months_before(date(2024, 1, 15), 1) == date(2023, 12, 15)
    assert D.months_before(date(2024, 12, 31), 12) == date(2023, 12, 31)


def test_tag_time_split(spark):
    days = ["2023-05-31", "2023-06-01", "2024-05-31", "2024-06-01", "2024-07-31", "2024-08-01"]
    df = spark.createDataFrame([(date.fromisoformat(d),) for d in days], "snapshot_date date")
    out = D.tag_time_split(df, D.time_split("2024-08-01"))
    assert [r.period for r in out.orderBy("snapshot_date").collect()] == ["train_test", "train_test", "oot", "oot"]


@pytest.mark.parametrize("ratio", [0.0, 0.7, 0.8, 1.0])
def test_stratified_split_has_exact_counts(spark, ratio):
    df = spark.range(1001).withColumn("label", F.when(F.col("id") % 9 == 0, 1).otherwise(0))
    out = D.stratified_split(df, "label", "id", ratio)
    assert out.columns == ["id", "label", "split"] and out.count() == 1001
    got = {(r.label, r.split): r.n for r in out.groupBy("label", "split").agg(F.count("*").alias("n")).collect()}
    for label, n in ((1, 112), (0, 889)):
        assert got.get((label, "train"), 0) == math.floor(ratio * n)
    again = D.stratified_split(df.repartition(7), "label", "id", ratio)
    assert out.exceptAll(again).count() == 0


def test_stratified_split_does_not_shuffle_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).selectExpr("id", "cast(id % 2 as int) AS label", "repeat('x', 100) AS payload").write.parquet(path)
    plan = D.stratified_split(spark.read.parquet(path), "label", "id")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    for line in plan.splitlines():
        assert not ("Exchange hashpartitioning" in line and "payload" in line)


def test_standardise_uses_population_deviation_of_the_training_rows(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (6.0, 5.0)], "x double, c double")
    train = df.where("x < 5")
    got = [tuple(r) for r in D.standardise(df, ["x", "c"], train).orderBy("x").collect()]
    mean, sd = 1.5, np.std([1.0, 2.0])
    assert got == [pytest.approx(((x - mean) / sd, 0.0)) for x in (1.0, 2.0, 6.0)]


def test_impute_median(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (float("inf"),), (None,), (10.0,), (4.0,)], "x double")
    assert sorted(r.x for r in D.impute_median(df, ["x"]).collect()) == [1.0, 3.0, 3.5, 3.5, 4.0, 10.0]


def test_selection(spark):
    df = spark.createDataFrame([(1, None, 7, 0), (2, None, 7, 1), (3, 1.0, 7, 1)], "a int, b double, c int, label int")
    rates = {r.feature: (round(r.missing_rate, 4), r.keep) for r in D.missing_rates(df, ["a", "b"]).collect()}
    assert rates == {"a": (0.0, True), "b": (0.6667, False)}
    constant = {r.feature: r.is_constant for r in D.constant_features(df, ["a", "b", "c"]).collect()}
    assert constant == {"a": False, "b": True, "c": True}
    top = P.top_correlated(P.correlation_with(df, "label", ["a", "b", "c"]), 2).collect()
    assert [r.feature for r in top] == ["a"]
    assert D.feature_columns(df) == ["a", "b", "c"]


def test_weights(spark):
    df = spark.createDataFrame([(0,), (0,), (0,), (1,)], "label int")
    assert sorted({r.weight for r in D.add_class_weight(df).collect()}) == [pytest.approx(4 / 6), 2.0]


def test_assemble_takes_each_column_once(spark):
    day = date(2024, 1, 1)
    labels = spark.createDataFrame([("c1", day, 1, 5)], "Customer_ID string, snapshot_date date, label int, x int")
    features = spark.createDataFrame([("c1", day, 9)], "Customer_ID string, snapshot_date date, x int")
    out = D.assemble(labels, features)
    assert out.columns == ["Customer_ID", "snapshot_date", "label", "x"] and out.first().x == 9


def test_profiles(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", None)], "k string, v int")
    assert {r.column: (r.missing_count, round(r.missing_pct, 2)) for r in P.missing_summary(df, only_missing=True).collect()} == {"v": (1, 33.33)}
    row = P.data_quality(df, "k").first()
    assert (row.n_rows, row.duplicate_rows, row.n_keys, row.n_columns, row.rows_per_key) == (3, 1, 2, 2, 1.5)
    assert P.schema_differences({"a": df, "b": df.withColumn("v", F.col("v").cast("string")).drop("k")}) == [
        ("k", "b", "absent", "string"),
        ("v", "b", "string", "int"),
    ]
    bins = P.histogram(spark.range(11).toDF("x"), "x", bins=5)
    assert sorted((r.bin, r.n) for r in bins.collect()) == [(0, 2), (1, 2), (2, 2), (3, 2), (4, 3)]
    assert [tuple(r) for r in P.histogram(spark.range(1).toDF("x"), "x").collect()] == [(0, 1)]


def test_leakage_counts(spark):
    day = date.fromisoformat
    f = spark.createDataFrame([("c", day("2024-01-01")), ("c", day("2024-02-01")), ("c", day("2024-02-01"))], "Customer_ID string, snapshot_date date")
    a = spark.createDataFrame([("c", day("2024-02-01")), ("d", day("2024-02-01"))], "Customer_ID string, application_date date")
    assert tuple(P.leakage_counts(f, a).first()) == (2, 1, 0)
    assert P.same_day_rows(f, a).count() == 2


def test_approximate_counts_are_close(spark):
    df = spark.range(1000).toDF("x")
    assert abs(P.distinct_counts(df, ["x"], approximate=True).first().n_distinct - 1000) < 100
