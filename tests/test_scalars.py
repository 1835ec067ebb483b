import pytest
from pyspark.sql import functions as F

from riskflow.constants import AGE_LABELS, LOAN_TYPES, PAYMENT_BEHAVIOURS
from riskflow.functions import scalars as S


def one(spark, values, column, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(column).collect()]


def test_dirty_number(spark):
    assert one(spark, ["12_", "1,000", " 7 ", "1-2", "abc", "", None, "-3", "1.5%"], S.dirty_number("x")) == [
        12.0, 1000.0, 7.0, None, None, None, None, -3.0, 1.5,
    ]


def test_ratio_has_no_value_without_positive_denominator(spark):
    assert one(spark, [2.0, 0.0, -1.0, None], S.ratio(F.lit(1.0), "x"), "double") == [0.5, None, None, None]


def test_instalment(spark):
    assert round(one(spark, [10, 0, None], S.instalment(F.lit(10000), "x"), "int")[0], 2) == 1055.82
    assert one(spark, [0, None], S.instalment(F.lit(10000), "x"), "int") == [None, None]


def test_duration_part(spark):
    text = ["22 Years and 1 Months", "3Months", "5 Years", None, "none"]
    assert one(spark, text, S.duration_part("x", "Years")) == [22, None, 5, None, None]
    assert one(spark, text, S.duration_part("x", "Months")) == [1, 3, None, None, None]


def test_normalise_category(spark):
    values = [" Low_spent_Small_value_payments ", "!@9#%8", "NA", "", "Low_spent", None]
    assert one(spark, values, S.normalise_category("x", PAYMENT_BEHAVIOURS)) == [
        "Low_spent_Small_value_payments", "Unknown", "Unknown", "Unknown", "Unknown", "Unknown",
    ]
    assert one(spark, ["n/a", "Good", "_", "?"], S.normalise_category("x")) == ["Unknown", "Good", "_", "Unknown"]


def test_age_band(spark):
    assert one(spark, [24, 25, 35, 45, 55, None], S.age_band("x"), "int") == [*AGE_LABELS, "Unknown"]
    assert one(spark, [0], S.age_band("x", zero_is_unknown=True), "int") == ["Unknown"]


def test_income_band(spark):
    assert one(spark, [0.0, 20000.0, 99999.0, 1e6, None], S.income_band("x"), "double") == [
        "0-20k", "20-50k", "50-100k", "100k+", None,
    ]


def test_interval_label_is_closed_on_the_right(spark):
    band = S.interval_label("x", (0, 0.2, 1.0), ("low", "high"))
    assert one(spark, [0.0, 0.2, 0.3, 1.0, 1.1, None, -1.0], band, "double") == [None, "low", "high", "high", None, None, None]


def test_age_unit_tries_days_before_months(spark):
    values = [None, 0, 30, 110, 900, 10000, 130, 90000]
    assert one(spark, values, S.age_unit("x"), "int") == [
        "null", "<=0", "18-100_ok", "other", "looks_months", "looks_days", ">120_other", ">120_other",
    ]


def test_finite_and_clip(spark):
    assert one(spark, [float("inf"), float("-inf"), float("nan"), 2.0, None], S.finite("x"), "double") == [
        None, None, None, 2.0, None,
    ]
    assert one(spark, [-5.0, 0.5, 9.0, None], S.clip("x", 0.0, 1.0), "double") == [0.0, 0.5, 1.0, None]


def test_loan_type_list(spark):
    values = ["Auto Loan, Payday Loan, and Student Loan", "Auto Loan, Auto Loan", None, ""]
    assert one(spark, values, S.list_size("x")) == [3, 1, 0, 0]
    flags = S.list_hot("x", LOAN_TYPES, "loan_type__")
    assert one(spark, values, flags["loan_type__AutoLoan"]) == [1, 1, 0, 0]
    assert one(spark, ["Brand#1, Brand#2"], S.list_hot("x", ["Brand#1"], "t")["tBrand#1"]) == [1]


def test_is_known(spark):
    assert one(spark, ["Lawyer", " UNKNOWN ", "", None], S.is_known("x")) == [1, 0, 0, 0]


def test_one_hot_names():
    assert set(S.multi_hot("x", ["Credit-Builder Loan"], "Type_of_Loan")) == {"Type_of_Loan_Credit_Builder_Loan"}
    assert S.slug("55+") == "55" and S.slug("18-24") == "18_24"


@pytest.mark.parametrize("value,expected", [("x", 0), (None, 0), ("Good", 1)])
def test_one_hot_null_is_zero(spark, value, expected):
    assert one(spark, [value], S.one_hot("x", ["Good"], "mix")["mix_Good"]) == [expected]
