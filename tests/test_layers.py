"""From raw text files to the monitoring report, on a small book of loans with a known driver of default."""

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from riskflow import jobs, schemas
from riskflow.operators import modeling as M
from riskflow.operators.applications import requests
from riskflow.operators.stages import selected_features
from riskflow.plans import layers
from riskflow.sources import sinks, tables

MONTHS = tables.month_list("2023-01-01", "2024-03-01")
PER_MONTH = 60


def _write_csv(folder, seed=11):
    """Each month some customers take a loan. Their chance to miss the first instalment grows with their debt."""
    rnd = random.Random(seed)
    loans = ["loan_id,Customer_ID,loan_start_date,tenure,installment_num,loan_amt,due_amt,paid_amt,overdue_amt,balance,snapshot_date"]
    clicks = ["Customer_ID," + ",".join(f"fe_{i}" for i in range(1, 21)) + ",snapshot_date"]
    attributes = ["Customer_ID,Name,SSN,Age,Occupation,snapshot_date"]
    financials = [
        "Customer_ID,Annual_Income,Num_of_Loan,Type_of_Loan,Num_of_Delayed_Payment,Credit_Mix,Outstanding_Debt,"
        "Credit_History_Age,Payment_Behaviour,Extra,snapshot_date"
    ]
    for m, start in enumerate(MONTHS[:-1]):
        for i in range(PER_MONTH):
            c = f"CUS_{m}_{i}"
            debt = rnd.random()
            bad = rnd.random() < (0.8 if debt > 0.7 else 0.05)
            for mob, day in enumerate(MONTHS[m : m + 3]):
                overdue = 1000.0 * mob if bad else 0.0
                loans.append(f"L_{m}_{i},{c},{start},10,{mob},10000,1000,{1000 - min(overdue, 1000)},{overdue},9000,{day}")
            values = ",".join(str(rnd.randrange(-20, 200)) for _ in range(20))
            clicks.append(f"{c},{values},{start}")
            attributes.append(f"{c},Name {i},1-2-3,{rnd.randrange(16, 70)}_,{rnd.choice(['Lawyer', 'Doctor', 'unknown'])},{start}")
            financials.append(
                f'{c},"{50000 + i}_",2,"Auto Loan, and Payday Loan",{rnd.randrange(5)},Good,{debt * 50000},'
                f"{i % 20} Years and {i % 12} Months,!@9#%8,{i},{start}"
            )
    for name, lines in (
        ("lms_loan_daily", loans),
        ("feature_clickstream", clicks),
        ("features_attributes", attributes),
        ("features_financials", financials),
    ):
        (folder / f"{name}.csv").write_text("\n".join(lines) + "\n")


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("mart")
    _write_csv(base)
    path = str(base / "store")

    def step(*argv):
        jobs.run(spark, jobs.parser().parse_args([argv[0], "--root", path, *argv[1:]]))

    step("bronze", "--data", str(base))
    step("silver")
    step("applications", "all")
    step("features")
    step("labels", "--mob", "1")
    step("train", "--snapshotdate", "2024-03-01", "--trials", "2")
    step("score", "--model", "credit_model_LR")
    step("monitor", "--model", "credit_model_LR")
    return path


def test_bronze_is_an_exact_copy_with_lineage(spark, root):
    raw = tables.read_table(spark, f"{root}/bronze/features_financials")
    assert raw.count() == PER_MONTH * (len(MONTHS) - 1)
    first = raw.where("Customer_ID = 'CUS_0_3'").first()
    assert first.Annual_Income == "50003_" and first.Extra == "3" and first.source_file.endswith("features_financials.csv")


def test_silver(spark, root):
    loans = tables.read_table(spark, f"{root}/silver/lms_loan_daily")
    assert loans.where("mob = 0 AND dpd <> 0").count() == 0
    assert loans.where("overdue_amt > 0 AND dpd < 28").count() == 0
    financials = tables.read_table(spark, f"{root}/silver/features_financials").where("Customer_ID = 'CUS_0_3'").first()
    assert (financials.Annual_Income, financials.Payment_Behaviour, financials.loan_type_count) == (50003.0, "Unknown", 2)
    assert (financials.Credit_History_Age_Year, financials.Credit_History_Age_Month) == (3.0, 3)
    assert (financials.loan_type__PaydayLoan, financials.loan_type__StudentLoan, financials.Extra) == (1, 0, "3")
    assert financials.asof_date == financials.snapshot_date == date(2023, 1, 1)


def test_one_feature_row_per_application(spark, root):
    features = tables.read_table(spark, f"{root}/gold/feature_store")
    applications = tables.read_table(spark, f"{root}/gold/application_store")
    assert features.count() == applications.count() == PER_MONTH * (len(MONTHS) - 1)
    assert len([c for c in features.columns if c.startswith("fe_")]) == 120
    assert {"DTI", "EMI_to_income", "Occupation_Lawyer", "age_band_Unknown", "max_dpd_prior"} <= set(features.columns)


def test_model_finds_the_driver(spark, root):
    run = spark.read.parquet(f"{root}/models/model_runs").first()
    assert run.model_version == "credit_model_LR_2024_03_01"
    assert set(run.auc) == {"train", "test", "oot"}
    assert run.auc["train"] > 0.75 and run.auc["oot"] > 0.7
    model = M.latest_model(spark, f"{root}/models/model_runs", "credit_model_LR")
    names = model.stages[0].getInputCols()
    assert M.coefficients(model, names, spark).first().feature in {"DTI", "Outstanding_Debt"}


def test_store_schemas(spark, root):
    for name, schema in (
        ("label_store", schemas.LABELS),
        ("model_predictions", schemas.PREDICTIONS),
        ("application_store", schemas.APPLICATIONS),
    ):
        got = {f.name: f.dataType for f in tables.read_table(spark, f"{root}/gold/{name}").schema}
        # Partition values that look like a date are read as one, a model name as text.
        assert got == {f.name: f.dataType for f in schema}


def test_predictions_and_report(spark, root):
    predictions = tables.read_table(spark, f"{root}/gold/model_predictions")
    assert predictions.where("model_predictions NOT BETWEEN 0 AND 1").count() == 0
    assert predictions.count() == PER_MONTH * (len(MONTHS) - 1)
    report = tables.read_table(spark, f"{root}/gold/model_monitoring/credit_model_LR", format="csv")
    assert report.count() == len(MONTHS) - 1
    assert report.columns == schemas.MONITORING.fieldNames()


def test_unknown_model(spark, root):
    with pytest.raises(FileNotFoundError):
        M.latest_model(spark, f"{root}/models/model_runs", "other")
    with pytest.raises(FileNotFoundError):
        M.latest_model(spark, f"{root}/models/none", "other")
    run = spark.read.parquet(f"{root}/models/model_runs").first()
    assert M.latest_model(spark, f"{root}/models/none", "other", fallback=run.model_path).stages


def test_only_new_months(spark, root):
    before = tables.read_table(spark, f"{root}/silver/feature_clickstream")
    files = set(before.inputFiles())
    layers.silver(spark, "feature_clickstream", root, only_new=True)
    assert set(tables.read_table(spark, f"{root}/silver/feature_clickstream").inputFiles()) == files
    layers.silver(spark, "feature_clickstream", root, dates=["2023-02-01"])
    after = set(tables.read_table(spark, f"{root}/silver/feature_clickstream").inputFiles())
    assert {f for f in files ^ after} == {f for f in files ^ after if "2023-02-01" in f} != set()


def test_ever_default_store(spark, root):
    layers.ever_default_table(spark, root, "2024-01-01", mob=0)
    out = tables.read_table(spark, f"{root}/gold/ever_default_store")
    assert out.groupBy("loan_id").count().where("count > 1").count() == 0
    assert 0 < out.where("label = 1").count() < out.count()


def test_monitoring_of_some_months(spark, root):
    report = lambda: {r.month: r for r in tables.read_table(spark, f"{root}/gold/model_monitoring/credit_model_LR", schema=schemas.MONITORING, format="csv").collect()}
    before = report()
    month = date(2023, 9, 1)
    changed = tables.read_table(spark, f"{root}/gold/label_store").where(f"snapshot_date = DATE '{month}'").withColumn("label", F.lit(0))
    kept = [r for r in tables.read_table(spark, f"{root}/gold/label_store").where(f"snapshot_date = DATE '{month}'").collect()]
    sinks.write_snapshots(spark.createDataFrame(changed.collect(), changed.schema), f"{root}/gold/label_store", ["label_def", "snapshot_date"])
    jobs.run(spark, jobs.parser().parse_args(["monitor", "--root", root, "--model", "credit_model_LR", "--dates", str(month)]))
    after = report()
    assert after.keys() == before.keys() and after[month].Actual_Default_Rate == 0 < before[month].Actual_Default_Rate
    assert {m: r for m, r in after.items() if m != month} == {m: r for m, r in before.items() if m != month}
    sinks.write_snapshots(spark.createDataFrame(kept, changed.schema), f"{root}/gold/label_store", ["label_def", "snapshot_date"])
    layers.monitor(spark, root, "credit_model_LR", dates=[str(month)])
    assert report() == before


def test_a_request_scores_as_in_the_batch(spark, root):
    layers.customer_state(spark, root, "2023-05-31")
    stored = tables.read_table(spark, f"{root}/gold/model_predictions").where("snapshot_date = DATE '2023-08-01'")
    expected = {r.Customer_ID: r.model_predictions for r in stored.collect()}
    asked = requests(spark, [(c, "2023-08-01") for c in sorted(expected)[:5]])
    got = layers.score_requests(spark, root, "credit_model_LR", asked).collect()
    assert len(got) == 5 and all(r.model_predictions == pytest.approx(expected[r.Customer_ID], abs=1e-9) for r in got)


def test_training_with_fitted_preprocessing(spark, root):
    before = spark.read.parquet(f"{root}/models/model_runs").count()
    layers.train(spark, root, "2024-02-01", n_trials=1, select=5, balanced=True)
    assert spark.read.parquet(f"{root}/models/model_runs").count() == before + 1
    model = M.latest_model(spark, f"{root}/models/model_runs", "none", fallback=f"{root}/models/credit_model_LR_2024_02_01")
    assert len(selected_features(model)) == 5 and {"DTI", "Outstanding_Debt"} & set(selected_features(model))
    features = tables.read_table(spark, f"{root}/gold/feature_store")
    scored = M.predictions(*layers._ready(model, features), "x")
    assert scored.count() == features.count() and scored.where("model_predictions IS NULL").count() == 0


def test_search_space():
    assert len(M.LR_SPACE["C"]) == 10 and round(M.LR_SPACE["C"][0], 6) == 0.001 and round(M.LR_SPACE["C"][-1]) == 1000
    assert M.draw(M.LR_SPACE, 10) == M.draw(M.LR_SPACE, 10)
    assert len(M.draw(M.LR_SPACE, 10)) == 10 and len(M.draw(M.LR_SPACE, 1000)) == 20


def test_boosted_search(spark, root):
    data = spark.read.parquet(f"{root}/models/training_sets/credit_model_LR_2024_03_01")
    names = ["DTI", "Outstanding_Debt", "fe_1_sum_30d"]
    found = M.search(data.where("split = 'train'"), names, kind="gbt", key="row_key", n_trials=1, folds=2)
    assert len(found.trials) == 1 and found.cv_auc > 0.7
    assert M.overfit(found.model, data).first().train_auc > 0.7
    weighted = M.fit_boosted(data.where("split = 'train'"), names, maxIter=5, maxDepth=2)
    auc = {r.split: r.auc for r in M.evaluate(weighted, data).collect()}
    assert auc["oot"] > 0.7
