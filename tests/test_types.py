"""Types of undeclared columns over snapshots: they only move up, whichever months a run reads."""

from datetime import date

import pytest

from riskflow.operators import cleaning as C
from riskflow.plans import layers
from riskflow.sources import tables

HEAD = "Customer_ID,Age,Occupation,Points,Rate,Note,Name,SSN,snapshot_date"
MONTHS = {
    "2024-01-01": ["C1,30,Lawyer,12,5,1,N,1", "C2,31,Doctor,13_,6,,N,1"],
    "2024-02-01": ["C1,30,Lawyer,9000000000,5.5,,N,1", "C2,31,Doctor,$14,6,x,N,1"],
    "2024-03-01": ["C1,30,Lawyer,lost,5.5,,N,1", "C2,31,Doctor,gone,1.5E3_,x,N,1"],
}


@pytest.fixture
def root(spark, tmp_path):
    for day, rows in MONTHS.items():
        (tmp_path / "features_attributes.csv").write_text("\n".join([HEAD, *[f"{r},{day}" for r in rows]]) + "\n")
        layers.bronze(spark, str(tmp_path / "features_attributes.csv"), "features_attributes", str(tmp_path / "store"))
    return str(tmp_path / "store")


def kinds(spark, root):
    df = tables.read_table(spark, f"{root}/silver/features_attributes")
    return {c: t for c, t in df.dtypes if c in ("Points", "Rate", "Note")}, df


def test_types_move_up_and_stored_months_follow(spark, root):
    one = lambda day: layers.silver(spark, "features_attributes", root, dates=[day], sweep=True)
    one("2024-01-01")
    assert kinds(spark, root)[0] == {"Points": "bigint", "Rate": "bigint", "Note": "string"}
    one("2024-02-01")
    types, df = kinds(spark, root)
    assert types["Points"] == "bigint" and types["Rate"] == "double"
    assert {(str(r.snapshot_date), r.Customer_ID): (r.Points, r.Rate) for r in df.collect()} == {
        ("2024-01-01", "C1"): (12, 5.0), ("2024-01-01", "C2"): (13, 6.0), ("2024-02-01", "C1"): (9_000_000_000, 5.5), ("2024-02-01", "C2"): (14, 6.0),
    }
    one("2024-03-01")
    types, df = kinds(spark, root)
    assert types["Points"] == "string" and types["Rate"] == "double"
    assert {r.Points for r in df.collect()} == {"12", "13_", "9000000000", "$14", "lost", "gone"}
    assert df.where("snapshot_date = DATE '2024-03-01' AND Customer_ID = 'C2'").first().Rate == 1500.0
    drift = {(r["column"], str(r.snapshot_date)): r.type for r in C.type_drift(tables.read_table(spark, f"{root}/types/features_attributes")).collect()}
    assert drift["Points", "2024-01-01"] == "bigint" and drift["Rate", "2024-01-01"] == "bigint" and ("Rate", "2024-02-01") not in drift


def test_order_of_months_does_not_matter(spark, root):
    layers.silver(spark, "features_attributes", root, dates=["2024-03-01"], sweep=True)
    layers.silver(spark, "features_attributes", root, only_new=True, sweep=True)
    types, df = kinds(spark, root)
    assert types == {"Points": "string", "Rate": "double", "Note": "string"} and df.count() == 6
    assert {r.Rate for r in df.collect()} == {5.0, 6.0, 5.5, 1500.0}


def test_lattice(spark):
    rows = [("a", 1, "bigint"), ("a", 2, "void"), ("b", 1, "double"), ("b", 2, "bigint"), ("c", 1, "void"), ("d", 1, "string"), ("d", 2, "double")]
    types = spark.createDataFrame(rows, "column string, m int, type string")
    assert {r["column"]: r.type for r in C.merged_types(types).collect()} == {"a": "bigint", "b": "double", "c": "void", "d": "string"}
    assert [c.column for c in C.casts_of(C.merged_types(types))] == ["a", "b"]
    assert C.type_drift(types, "m").count() == 3 and C.merged_types(types.limit(0)).count() == 0


def test_snapshot_dates_by_folder(spark, root):
    assert tables.stored_dates(spark, f"{root}/bronze/features_attributes") == [date(2024, m, 1) for m in (1, 2, 3)]
