from datetime import date

import pytest

from riskflow import schemas
from riskflow.operators import cleaning as C

D = date.fromisoformat


def test_loan_delinquency(spark):
    loans = spark.createDataFrame(
        [
            ("L1", D("2024-03-31"), 1000.0, 0.0),
            ("L2", D("2024-03-31"), 1000.0, 1000.0),
            ("L3", D("2024-03-01"), 1000.0, 1500.0),
            ("L4", D("2024-03-01"), 0.0, 500.0),
        ],
        "loan_id string, snapshot_date date, due_amt double, overdue_amt double",
    )
    out = C.loan_delinquency(loans, installment=None).orderBy("loan_id")
    assert [tuple(r) for r in out.select("installments_missed", "first_missed_date", "dpd").collect()] == [
        (0, None, 0),
        (1, D("2024-02-29"), 31),
        (2, D("2024-01-01"), 60),
        (None, None, None),
    ]


@pytest.mark.parametrize(
    "values,kind,expected",
    [
        (
            ["12", "12_", "1,000", " 7 ", "5.0", "-3", "8%", "9", "10", "abc"],
            "bigint",
            [12, 12, 1000, 7, 5, -3, 8, 9, 10, None],
        ),
        (["1.5_", "2", "3", "4", "5", "6", "7", "8", "9", "10"], "double", [1.5, 2, 3, 4, 5, 6, 7, 8, 9, 10]),
        (["1-2", "a", "b", "4"], "string", ["1-2", "a", "b", "4"]),
        (["9999999999", "1"], "bigint", [9999999999, 1]),
    ],
)
def test_numeric_sweep(spark, values, kind, expected):
    df = spark.createDataFrame([(i, v, "keep") for i, v in enumerate(values)], "i int, x string, Customer_ID string")
    out = C.sweep_numeric(df)
    assert out.columns == ["i", "x", "Customer_ID"]
    assert dict(out.dtypes)["x"] == kind
    assert [r.x for r in out.orderBy("i").collect()] == expected


def test_numeric_profile_of_a_table_without_text(spark):
    assert C.numeric_profile(spark.range(3)).count() == 0


def test_enforce_schema(spark):
    df = spark.createDataFrame([("c1", "3_", "2024-01-01", "z")], "Customer_ID string, fe_1 string, snapshot_date string, extra string")
    out = C.enforce_schema(df, schemas.CLICKSTREAM, keep_extra=True)
    assert out.columns == [*schemas.CLICKSTREAM.fieldNames(), "extra"]
    row = out.first()
    assert (row.fe_1, row.fe_2, row.snapshot_date, row.extra) == (3, None, D("2024-01-01"), "z")
    assert dict(out.dtypes)["fe_2"] == "int"


def test_survivor_does_not_depend_on_order(spark):
    rows = [("c1", 1, "a"), ("c1", 1, "b"), ("c1", 0, "z"), ("c2", 5, None)]
    for data in (rows, rows[::-1]):
        df = spark.createDataFrame(data, "k string, v int, t string").repartition(3)
        out = C.keep_one_per_grain(df, ["k"], ["v"])
        assert sorted(map(tuple, out.collect())) == [("c1", 1, "b"), ("c2", 5, None)]


def test_required_columns(spark):
    with pytest.raises(ValueError, match="lacks columns: a, b"):
        C.require_columns(spark.range(1), ["b", "id", "a"])


def test_clean_attributes_drops_personal_data(spark):
    raw = spark.createDataFrame(
        [("c1", "Ann", "1", "17_", "unknown", "2024-01-01"), ("c2", "Bo", "2", "40", "Lawyer", "2024-01-01")],
        "Customer_ID string, Name string, SSN string, Age string, Occupation string, snapshot_date string",
    )
    out = C.clean_attributes(raw, schemas.ATTRIBUTES, ["Customer_ID", "snapshot_date"])
    assert not {"Name", "SSN"} & set(out.columns)
    got = {r.Customer_ID: (r.Age, r.age_clean, r.age_invalid_flag, r.is_occu_known, r.asof_date) for r in out.collect()}
    assert got == {"c1": (17, None, 1, 0, D("2024-01-01")), "c2": (40, 40, 0, 1, D("2024-01-01"))}


def test_fill_and_floats(spark):
    df = spark.createDataFrame([(None, None, "c")], "a int, b float, Customer_ID string")
    assert dict(C.floats_to_doubles(df).dtypes)["b"] == "double"
    assert tuple(C.fill_numeric(df).first()) == (0, 0.0, "c")
    assert tuple(C.fill_numeric(df, exclude=["a"]).first()) == (None, 0.0, "c")


def test_key_quality_and_invalid_categories(spark):
    df = spark.createDataFrame([("a", "Good"), ("a", "x"), (None, None)], "Customer_ID string, mix string")
    assert tuple(C.key_quality(df).first()) == (3, 1, 1)
    assert [tuple(r) for r in C.invalid_categories(df, {"mix": ["Good"]}).collect()] == [("mix", 2)]


def test_mean_of_sweep_is_one_pass(spark):
    df = spark.createDataFrame([("1", "2")], "a string, b string")
    plan = C.numeric_profile(df, exclude=())._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1
