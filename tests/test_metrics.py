from datetime import date

import pytest
from pyspark.sql import functions as F

from riskflow.operators import metrics as M

D = date.fromisoformat
SIX = [(1, 0.9), (0, 0.8), (1, 0.8), (0, 0.3), (1, 0.4), (0, 0.1)]


@pytest.fixture
def scored(spark):
    return spark.createDataFrame(SIX, "label int, score double")


def test_ranking(scored):
    row = M.ranking_metrics(scored).first()
    assert (round(row.auc, 4), round(row.gini, 4), round(row.ks, 4)) == (0.8333, 0.6667, 0.6667)


def test_monitoring_row(spark):
    month = D("2024-09-01")
    df = spark.createDataFrame([(month, y, p) for y, p in SIX] + [(D("2024-10-01"), 0, 0.2)], "month date, label int, score double")
    sep, octo = M.monitoring(df).orderBy("month").collect()
    assert tuple(sep) == (month, 6, 0.8333, 0.6667, 0.6667, 0.1917, 0.55, 0.5, 0.05)
    assert (octo.n_samples, octo.AUC, octo.Gini, octo.KS, octo.Brier) == (1, None, None, None, 0.04)


def test_average_precision(scored):
    assert round(M.average_precision(scored).first()[0], 4) == 0.8056


def test_decisions(scored):
    row = M.expected_loss(M.threshold_sweep(scored, [0.5])).first()
    assert (row.tp, row.fp, row.fn, row.tn) == (2, 1, 1, 2)
    assert (row.approval_rate, round(row.default_rate_in_approved, 4)) == (0.5, 0.3333)
    assert {round(row[c], 4) for c in ("sensitivity", "specificity", "precision")} == {0.6667}
    assert round(row.expected_loss_per_approved, 2) == 2333.33


def test_no_approved_loans_give_zero_not_null(scored):
    row = M.threshold_sweep(scored, [0.0]).first()
    assert (row.approval_rate, row.default_rate_in_approved) == (0.0, 0.0)


def test_threshold_choice(spark):
    sweep = spark.createDataFrame([(0.05, 0.01), (0.15, 0.03), (0.3, 0.05), (0.5, 0.2)], "threshold double, default_rate_in_approved double")
    assert tuple(M.threshold_choice(sweep).first()) == (0.15, 0.15, 0.05)
    assert tuple(M.threshold_choice(sweep.where("threshold = 0.5")).first()) == (None, None, None)


def test_invariance(scored):
    base = M.ranking_metrics(scored).first()
    same = M.ranking_metrics(scored.withColumn("score", F.exp(F.col("score") * 3))).first()
    flipped = M.ranking_metrics(scored.withColumn("score", -F.col("score"))).first()
    assert (same.auc, same.ks) == pytest.approx((base.auc, base.ks))
    assert flipped.auc == pytest.approx(1 - base.auc)


def test_weights_equal_repeated_rows(spark, scored):
    weighted = scored.withColumn("w", F.when(F.col("label") == 1, 3).otherwise(2))
    repeated = weighted.withColumn("x", F.explode(F.sequence(F.lit(1), "w")))
    a, b = M.ranking_metrics(weighted, weight="w").first(), M.ranking_metrics(repeated).first()
    assert (a.auc, a.ks) == pytest.approx((b.auc, b.ks))


def test_rows_without_label_or_score_are_left_out(spark):
    df = spark.createDataFrame([*SIX, (None, 0.5), (1, None), (0, float("nan"))], "label int, score double")
    row = M.ranking_metrics(df).first()
    assert (row.n_pos, row.n_neg, round(row.auc, 4)) == (3, 3, 0.8333)


def test_calibration_bins_are_closed_on_the_right(spark):
    df = spark.createDataFrame([(0, 0.0), (1, 0.1), (0, 0.10001), (1, 1.0)], "label int, score double")
    assert [(r.bin, r.n) for r in M.calibration(df).orderBy("bin").collect()] == [(1, 2), (2, 1), (10, 1)]


def test_class_report(scored):
    zero, one = M.class_report(scored).orderBy("class").collect()
    assert (zero.support, one.support) == (3, 3)
    assert round(one.f1, 4) == 0.6667


@pytest.fixture
def outcome_tables(spark):
    p = spark.createDataFrame(
        [("c1", D("2024-01-01"), 0.2), ("c1", D("2024-02-01"), 0.4), ("c2", D("2024-01-01"), 0.6)],
        "Customer_ID string, snapshot_date date, model_predictions double",
    )
    y = spark.createDataFrame(
        [("c1", D("2024-02-01"), 1), ("c1", D("2024-03-01"), 0), ("c2", D("2024-01-01"), 0)],
        "Customer_ID string, snapshot_date date, label int",
    )
    return p, y


@pytest.mark.parametrize(
    "mode,expected",
    [
        ("maturity", [("c1", "2024-02-01", 1, 0.2), ("c1", "2024-03-01", 0, 0.4)]),
        ("snapshot", [("c1", "2024-02-01", 1, 0.4), ("c2", "2024-01-01", 0, 0.6)]),
    ],
)
def test_outcomes(outcome_tables, mode, expected):
    out = M.join_outcomes(*outcome_tables, mode=mode)
    assert sorted((r.Customer_ID, str(r.month), r.label, r.score) for r in out.collect()) == expected


def test_outcomes_by_customer_are_weighted(outcome_tables):
    p, y = outcome_tables
    out = M.join_outcomes(p.unionByName(p), y, mode="customer")
    assert sorted((r.Customer_ID, str(r.month), r.score, r.weight) for r in out.collect()) == [
        ("c1", "2024-02-01", 0.2, 2),
        ("c1", "2024-02-01", 0.4, 2),
        ("c1", "2024-03-01", 0.2, 2),
        ("c1", "2024-03-01", 0.4, 2),
        ("c2", "2024-01-01", 0.6, 2),
    ]
