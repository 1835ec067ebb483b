"""Rows that are easily forgotten: nulls, NaN, exponents, constant columns, two definitions in one store."""

import math
import time

import pytest
from pyspark.sql import functions as F

from riskflow.functions import scalars as S
from riskflow.operators import dataset, metrics, modeling, profiling
from riskflow.operators.labels import definition
from riskflow.operators.pit import History, asof_join
from riskflow.plans import layers
from riskflow.sources import sinks


@pytest.mark.parametrize(
    "text,number",
    [("1.5E7", 1.5e7), ("3.2E-4", 3.2e-4), ("1e3", 1000.0), (" 2.5e+2 ", 250.0), ("1e999", None), ("12_", 12.0), ("8%", 8.0), ("1,000", 1000.0), ("abc", None), (None, None), ("-3", -3.0)],
)
def test_dirty_numbers(spark, text, number):
    assert spark.createDataFrame([(text,)], "x string").select(S.dirty_number("x")).first()[0] == number


def test_unknown_scores_are_in_no_bin(spark):
    rows = spark.createDataFrame([(0.95, 1), (None, 1), (math.nan, 0), (0.05, 0)], "score double, label int")
    assert sorted((r["bin"], r["n"]) for r in metrics.calibration(rows).collect()) == [(1, 1), (10, 1)]
    assert sorted((r["bin"], r["n"]) for r in metrics.score_histogram(rows).collect()) == [(2, 1), (47, 1)]


def test_null_customers_match_nobody(spark):
    apps = spark.createDataFrame([(None, "2024-02-01"), ("c", "2024-02-01")], "Customer_ID string, application_date string")
    apps = apps.withColumn("application_date", F.to_date("application_date"))
    past = spark.createDataFrame([(None, "2024-01-01", 1), ("c", "2024-01-01", 2)], "Customer_ID string, snapshot_date string, v int")
    past = past.withColumn("snapshot_date", F.to_date("snapshot_date"))
    for unique in (True, False):
        found = asof_join(apps, [History(past, latest=("v",), unique=True)], applications_unique=unique).collect()
        assert {r["Customer_ID"]: r["v"] for r in found} == {None: None, "c": 2}
    assert tuple(profiling.leakage_counts(past, apps).first()) == (0, 1, 0)


def test_rows_without_class_have_no_split(spark):
    rows = spark.createDataFrame([(i, None if i % 5 == 0 else i % 2) for i in range(100)], "k int, label int")
    found = dataset.stratified_split(rows, "label", "k").collect()
    assert {r["split"] for r in found if r["label"] is None} == {None} and len(found) == 100
    assert all(r["split"] in ("train", "test") for r in found if r["label"] is not None)


def test_correlations_of_many_columns(spark):
    wide = spark.range(300).select(*[(F.sin(F.col("id") * (i + 1)) + F.lit(1e6)).alias(f"c{i}") for i in range(40)])
    wide = wide.withColumns({"c1": F.when(F.col("c0") > 1e6, F.col("c1")), "c2": F.lit(5.0), "c3": F.lit(None).cast("double")})
    start = time.time()
    found = {(r["col_a"], r["col_b"]): r["corr"] for r in profiling.correlation_matrix(wide, wide.columns).collect()}
    assert len(found) == 40 * 41 // 2 and time.time() - start < 60
    for a, b in [("c0", "c1"), ("c0", "c5"), ("c7", "c30"), ("c4", "c4")]:
        assert abs(found[a, b] - wide.select(profiling.correlation(a, b)).first()[0]) < 1e-7
    assert found["c0", "c2"] is None and found["c0", "c3"] is None


def test_definitions_do_not_mix(spark, tmp_path):
    for mob, label in ((1, 0), (6, 1)):
        rows = spark.createDataFrame([("l", "c", label, definition(30, mob), "2024-01-01")], "loan_id string, Customer_ID string, label int, label_def string, snapshot_date string")
        sinks.write_snapshots(rows.withColumn("snapshot_date", F.to_date("snapshot_date")), f"{tmp_path}/gold/label_store", ["label_def", "snapshot_date"])
    assert [layers.stored_labels(spark, str(tmp_path), 30, mob).first()["label"] for mob in (1, 6)] == [0, 1]


def test_unreadable_dates_keep_their_text(spark, tmp_path):
    (tmp_path / "loan.csv").write_text("loan_id,snapshot_date\na,2024-01-01\nb,next week\n")
    layers.bronze(spark, str(tmp_path / "loan.csv"), "loan", str(tmp_path))
    found = spark.read.parquet(f"{tmp_path}/bronze/loan").select("loan_id", "snapshot_text").collect()
    assert {r[0]: r[1] for r in found} == {"a": "2024-01-01", "b": "next week"}


def test_newest_delivery_survives(spark, tmp_path):
    (tmp_path / "d").mkdir()
    for name, income in (("2024-01-a.csv", 9000), ("2024-01-b.csv", 100)):
        (tmp_path / "d" / name).write_text(f"Customer_ID,snapshot_date,Annual_Income\nc,2024-01-01,{income}\n")
    layers.bronze(spark, str(tmp_path / "d"), "features_financials", str(tmp_path))
    layers.silver(spark, "features_financials", str(tmp_path))
    (row,) = spark.read.parquet(f"{tmp_path}/silver/features_financials").collect()
    assert row["Annual_Income"] == 100 and row["source_file"].endswith("2024-01-b.csv")


def test_repeated_run_replaces_its_row(spark, tmp_path):
    quality = spark.createDataFrame([("train", 0.7, 0.4)], "split string, auc double, gini double")
    sizes = spark.createDataFrame([("train", 10)], "split string, n_rows long")
    for day, c in (("2024-07-01", 1), ("2024-08-01", 2), ("2024-08-01", 3)):
        modeling.record_run(spark, f"{tmp_path}/log", model_name="LR", model_path="p", train_date=day, parameters={"C": c}, metrics=quality, sizes=sizes)
    found = spark.read.parquet(f"{tmp_path}/log").collect()
    assert sorted((r["train_date"], r["parameters"]) for r in found) == [("2024-07-01", '{"C": 1}'), ("2024-08-01", '{"C": 3}')]
