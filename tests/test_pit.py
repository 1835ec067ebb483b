import random
from datetime import date, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskflow.operators import features as G
from riskflow.operators.pit import History, asof_join, exact_date_join, lookback

D = date.fromisoformat


@pytest.fixture
def history(spark):
    data = [("c1", "2024-01-01", 1), ("c1", "2024-03-01", 2), ("c1", "2024-05-15", 3), ("c1", "2024-07-01", 9)]
    return spark.createDataFrame([(c, D(d), v) for c, d, v in data], "Customer_ID string, snapshot_date date, v int")


@pytest.fixture
def applications(spark):
    data = [("c1", "2024-03-01", 7), ("c1", "2024-06-01", 8), ("c2", "2024-03-01", 9)]
    return spark.createDataFrame([(c, D(d), a) for c, d, a in data], "Customer_ID string, application_date date, loan_amt int")


@pytest.mark.parametrize("strict,expected", [(False, [2, 3, None]), (True, [1, 3, None])])
@pytest.mark.parametrize("unique", [False, True])
def test_newest_row(applications, history, strict, expected, unique):
    out = asof_join(
        applications,
        [History(history, latest=("v",), date_as="seen", unique=unique)],
        strict=strict,
        applications_unique=unique,
    ).orderBy("Customer_ID", "application_date")
    assert out.columns == ["Customer_ID", "application_date", "loan_amt", "v", "seen"]
    assert [r.v for r in out.collect()] == expected
    assert [r.loan_amt for r in out.collect()] == [7, 8, 9]


def test_lookback_sums(applications, history):
    out = lookback(history, applications, {"v": ("sum",)}, {"30d": 30, "90d": 90, "180d": 180})
    got = applications.join(out, ["Customer_ID", "application_date"], "left").fillna(0)
    got = got.orderBy("Customer_ID", "application_date").collect()
    assert [(r.v_sum_30d, r.v_sum_90d, r.v_sum_180d) for r in got] == [(2, 3, 3), (3, 3, 6), (0, 0, 0)]


def test_newest_row_with_null_values_still_counts(spark, applications):
    history = spark.createDataFrame(
        [("c1", D("2024-01-01"), 1), ("c1", D("2024-02-01"), None)], "Customer_ID string, snapshot_date date, v int"
    )
    out = asof_join(applications, [History(history, latest=("v",))]).where("Customer_ID = 'c1'")
    assert [r.v for r in out.collect()] == [None, None]


def test_one_row_per_application_with_two_loans_on_one_day(spark, history):
    apps = spark.createDataFrame(
        [("c1", D("2024-06-01"), "a"), ("c1", D("2024-06-01"), "b")], "Customer_ID string, application_date date, loan string"
    )
    out = asof_join(apps, [History(history, latest=("v",))])
    assert sorted((r.loan, r.v) for r in out.collect()) == [("a", 3), ("b", 3)]


def _random_tables(n_history=4000, n_apps=300, seed=5):
    """One customer holds a third of all rows; days repeat, values are sometimes null."""
    rnd = random.Random(seed)
    start = D("2023-01-01")

    def customer():
        return "hot" if rnd.random() < 1 / 3 else f"c{rnd.randrange(20)}"

    def day():
        return start + timedelta(days=rnd.randrange(200))

    history = [(customer(), day(), None if rnd.random() < 0.1 else 1e6 + rnd.random(), i) for i in range(n_history)]
    apps = list({(customer(), day()) for _ in range(n_apps)})
    return pd.DataFrame(history, columns=["k", "d", "v", "i"]), pd.DataFrame(apps, columns=["k", "a"])


@pytest.mark.parametrize("strict", [False, True])
def test_against_brute_force(spark, strict):
    h, a = _random_tables()
    hist = spark.createDataFrame(
        [(k, d, None if pd.isna(v) else float(v), int(i)) for k, d, v, i in h.itertuples(index=False)],
        "k string, d date, v double, i int",
    )
    apps = spark.createDataFrame(list(a.itertuples(index=False, name=None)), "k string, a date")
    names = {"key": "k", "app_date": "a", "strict": strict}
    newest = asof_join(
        apps,
        [History(hist, latest=("v", "i"), tie=("i",), date="d", running={"total": ("sum", "v"), "n": ("count", "v"), "first": ("min", "d")})],
        **names,
    )
    stats = lookback(hist, apps, {"v": ("sum", "mean", "std", "max", "count")}, {"w": 7, "m": 30}, date="d", **names)
    got = {(r.k, r.a): r for r in newest.join(stats, ["k", "a"], "left").collect()}
    assert len(got) == len(a)
    for k, day in a.itertuples(index=False):
        past = h[(h.k == k) & ((h.d < day) if strict else (h.d <= day))]
        row = got[(k, day)]
        if past.empty:
            assert row.i is None
            continue
        best = past.sort_values(["d", "i"]).iloc[-1]
        assert row.i == best.i
        assert row.n == past.v.count() and row.first == past.d.min()
        assert row.total == pytest.approx(past.v.sum(), rel=1e-12) or past.v.count() == 0
        for label, days in (("w", 7), ("m", 30)):
            x = past[past.d >= day - timedelta(days=days)].v.dropna()
            if len(x) == 0:
                assert row[f"v_sum_{label}"] is None
                continue
            assert row[f"v_count_{label}"] == len(x)
            assert row[f"v_max_{label}"] == x.max()
            assert row[f"v_mean_{label}"] == pytest.approx(x.mean(), rel=1e-12)
            if len(x) > 1:
                assert row[f"v_std_{label}"] == pytest.approx(np.std(x, ddof=1), rel=1e-6)
            else:
                assert row[f"v_std_{label}"] is None


def test_future_rows_change_nothing(spark, applications, history):
    later = history.withColumns({"snapshot_date": F.date_add("snapshot_date", 400), "v": F.col("v") * 100})
    names = {"Customer_ID", "application_date"}
    for df in (history, history.unionByName(later)):
        newest = asof_join(applications, [History(df, latest=("v",), running={"t": ("sum", "v")})])
        window = lookback(df, applications, {"v": ("sum", "max")}, {"m": 30})
        result = (sorted(map(str, newest.collect())), sorted(map(str, window.collect())))
        first = result if df is history else first
        assert result == first
    assert names <= set(newest.columns)


def test_values_of_the_day_itself(applications, history):
    out = exact_date_join(applications, history, ["v"]).orderBy("Customer_ID", "application_date")
    assert [r.v for r in out.collect()] == [2, None, None]


def test_constant_window_has_no_deviation(spark, applications):
    rows = [("c1", D("2024-02-20") + timedelta(days=i), 0.1) for i in range(7)]
    history = spark.createDataFrame(rows, "Customer_ID string, snapshot_date date, v double")
    out = lookback(history, applications, {"v": ("std",)}, {"m": 30}).where("application_date = '2024-03-01'")
    assert out.first().v_std_m == pytest.approx(0.0, abs=1e-12)


# ---- the feature table ----


@pytest.fixture
def cleaned(spark):
    financials = spark.createDataFrame(
        [
            ("c1", D("2024-01-01"), 60000.0, 1200.0, "Low_spent_Small_value_payments", "Good", "Auto Loan", "22 Years and 1 Months", 2, 31, 5.0),
            ("c1", D("2024-02-01"), 50000.0, 1000.0, "Unknown", "Bad", "Auto Loan, and Payday Loan", "3Months", 3, 0, 0.0),
            ("c1", D("2024-09-01"), 1.0, 1.0, "Unknown", "Good", "Auto Loan", None, 1, 99, 7.0),
        ],
        "Customer_ID string, snapshot_date date, Annual_Income double, Outstanding_Debt double, Payment_Behaviour string, "
        "Credit_Mix string, Type_of_Loan string, Credit_History_Age string, Num_of_Loan int, Num_of_Delayed_Payment int, "
        "Changed_Credit_Limit double",
    )
    attributes = spark.createDataFrame(
        [("c1", D("2024-01-01"), 30, "Lawyer"), ("c2", D("2024-01-01"), None, "Doctor")],
        "Customer_ID string, snapshot_date date, Age int, Occupation string",
    )
    clicks = spark.createDataFrame(
        [("c1", D("2024-02-25"), 4, None), ("c1", D("2024-02-10"), 6, 2)],
        "Customer_ID string, snapshot_date date, fe_1 int, fe_2 int",
    )
    apps = spark.createDataFrame(
        [("c1", D("2024-03-01"), 10000, 10), ("c2", D("2024-03-01"), 10000, 10), ("c1", D("2024-03-01"), 9000, 10)],
        "Customer_ID string, application_date date, loan_amt int, tenure int",
    )
    return apps, financials, attributes, clicks


def test_build_features(cleaned):
    out = G.build_features(*cleaned, top_occupations=["Lawyer"])
    assert out.groupBy("Customer_ID", "snapshot_date").count().where("count > 1").count() == 0
    c1, c2 = out.orderBy("Customer_ID").collect()
    assert (c1.DTI, c1.Num_of_Loan_active, c1.loan_type_count, c1.Credit_Mix_Bad) == (0.02, 3, 2, 1)
    assert (c1.Type_of_Loan_Auto_Loan, c1.Type_of_Loan_Payday_Loan) == (1, 1)
    assert (c1.Num_of_Delayed_Payment_3m, c1.max_dpd_prior, c1.ever_30dpd_prior) == (31, 31, 1)
    assert (c1.Changed_Credit_Limit_sum_3m, c1.count_credit_limit_changes_3m, c1.time_since_last_delay) == (5.0, 1, 60)
    assert (c1.fe_1_sum_7d, c1.fe_1_sum_30d, c1.fe_2_mean_30d) == (4, 10, 1.0)
    assert round(c1.fe_1_std_30d, 6) == round(2**0.5, 6)
    assert (c1.age_band_25_34, c1.Occupation_Lawyer, c1.requested_amount) == (1, 1, 10000)
    assert round(c1.EMI_to_income, 4) == round(1055.82 / (50000 / 12), 4)
    assert (c1.Credit_History_Age_Year, c1.Credit_History_Age_Month) == (0, 3)
    # No history at all: zero features, unknown age, and no delay to count from.
    assert (c2.DTI, c2.fe_1_sum_7d, c2.age_band_Unknown, c2.age_band_55, c2.time_since_last_delay) == (0.0, 0, 1, 0, None)


def test_missing_tables_leave_their_features_out(cleaned):
    apps, financials, _, _ = cleaned
    assert "DTI" not in G.build_features(apps).columns
    only = G.build_features(apps, financials)
    assert "DTI" in only.columns and "Age" not in only.columns
    assert only.count() == 2


def test_strict_features_ignore_the_day_itself(cleaned):
    apps, financials, attributes, clicks = cleaned
    same_day = financials.where("snapshot_date = '2024-02-01'").withColumn("snapshot_date", F.lit(D("2024-03-01")))
    loose = G.build_features(apps, same_day).where("Customer_ID = 'c1'").first()
    strict = G.build_features(apps, same_day, strict=True).where("Customer_ID = 'c1'").first()
    assert (loose.Annual_Income, strict.Annual_Income) == (50000.0, 0.0)


def test_top_occupations(spark):
    df = spark.createDataFrame([("b",), ("b",), ("a",), ("c",), (None,)], "o string")
    out = G.one_hot_top(df, "o", 2, "job")
    assert out.columns == ["o", "job_b", "job_a"]
    assert [r[0] for r in G.top_values(df, "o", 2).collect()] == ["b", "a"]
