from datetime import date

import pytest
from pyspark.sql import functions as F

from riskflow.operators import applications as A
from riskflow.operators import labels as L
from riskflow.schemas import PREDICTIONS
from riskflow.session import scratch_dir
from riskflow.sources import sinks, tables
from riskflow.streaming.incremental import refresh_snapshots

D = date.fromisoformat
JAN, FEB = D("2024-01-01"), D("2024-02-01")


@pytest.fixture
def root(spark, tmp_path):
    path = str(tmp_path / "table")
    df = spark.createDataFrame([(JAN, 1), (JAN, 2), (FEB, 3)], "snapshot_date date, v int")
    return sinks.write_snapshots(df, path)


def test_rewriting_one_month_keeps_the_others(spark, root):
    sinks.write_snapshots(spark.createDataFrame([(FEB, 9)], "snapshot_date date, v int"), root)
    assert sorted((r.snapshot_date, r.v) for r in spark.read.parquet(root).collect()) == [(JAN, 1), (JAN, 2), (FEB, 9)]
    sinks.write_snapshots(spark.createDataFrame([(FEB, 9)], "snapshot_date date, v int"), root)
    assert spark.read.parquet(root).count() == 3


def test_partition_column_survives_reading_folders(spark, root):
    some = tables.read_paths(spark, [f"{root}/snapshot_date=2024-01-01"], root)
    assert set(some.columns) == {"snapshot_date", "v"} and some.count() == 2
    assert tables.read_paths(spark, f"{root}/snapshot_date=2024-*", root).count() == 3


def test_date_filters_prune_partitions(spark, root):
    df = tables.read_table(spark, root)
    for pruned in (
        tables.at_snapshot(df, "2024-01-01"),
        tables.up_to(df, JAN),
        tables.between(df, "2024-01-01", "2024-01-31"),
        tables.at_snapshots(df, [JAN]),
        tables.read_asof(spark, root, JAN),
    ):
        plan = pruned._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(snapshot_date" in plan or "PartitionFilters: [snapshot_date" in plan
        assert pruned.count() == 2


def test_missing_table(spark, tmp_path):
    assert tables.read_table(spark, str(tmp_path / "none"), missing="none") is None
    assert tables.read_asof(spark, str(tmp_path / "none"), JAN) is None
    with pytest.raises(FileNotFoundError):
        tables.read_table(spark, str(tmp_path / "none"))


def test_new_dates(spark, root):
    source = spark.createDataFrame([(JAN, 5), (D("2024-03-01"), 6)], "snapshot_date date, v int")
    held = tables.read_table(spark, root)
    assert [r[0] for r in tables.missing_dates(source, held).collect()] == [D("2024-03-01")]
    assert [r.v for r in tables.only_new(source, held).collect()] == [6]
    assert tables.only_new(source, None).count() == 2 and tables.missing_dates(source, None).count() == 2


def test_new_dates_prune_the_source(spark, root, tmp_path):
    held = spark.createDataFrame([(JAN, 0)], "snapshot_date date, v int")
    new = tables.only_new(tables.read_table(spark, root), held)
    assert [r.v for r in new.collect()] == [3]
    assert "PartitionFilters: [isnotnull(snapshot_date" in new._jdf.queryExecution().executedPlan().toString()
    assert tables.only_new(held, tables.read_table(spark, root)).count() == 0


def test_months(spark):
    assert tables.month_list("2023-01-15", "2023-03-01") == [D("2023-01-01"), D("2023-02-01"), D("2023-03-01")]
    assert len(tables.month_list("2023-01-01", "2024-12-01")) == 24
    df = spark.createDataFrame([(D("2023-01-15"),), (D("2023-03-01"),)], "d date")
    assert [r.month for r in tables.month_starts(df, "d").orderBy("month").collect()] == tables.month_list("2023-01-15", "2023-03-01")


def test_csv(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text("a,b\n1_,x\n2,y\n")
    raw = tables.read_raw_csv(spark, str(path), lineage=True)
    assert dict(raw.dtypes) == {"a": "string", "b": "string", "source_file": "string", "ingested_at": "timestamp"}
    assert raw.where(F.col("source_file").endswith("raw.csv")).count() == 2
    out = sinks.write_report(raw.select("a"), str(tmp_path / "report"))
    assert len([p for p in (tmp_path / "report").glob("*.csv")]) == 1
    assert tables.read_table(spark, out, format="csv").count() == 2


def test_prediction_sink(spark, tmp_path):
    df = spark.createDataFrame([("c1", JAN, "LR", 0.5)], "Customer_ID string, snapshot_date date, model_name string, model_predictions double")
    path = sinks.write_predictions(df, str(tmp_path / "p"), "csv")
    back = tables.read_table(spark, path, schema=PREDICTIONS, format="csv").first()
    assert (back.Customer_ID, back.model_name, back.snapshot_date, back.model_predictions) == ("c1", "LR", JAN, 0.5)


def test_stream_rebuilds_touched_months(spark, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("source", "target", "state"))

    def arrive(rows):
        df = spark.createDataFrame(rows, "snapshot_date date, v int")
        df.write.mode("append").parquet(source)
        refresh_snapshots(spark, source, df.schema, target, state, lambda d: d.distinct())
        return sorted((r.snapshot_date, r.v) for r in spark.read.parquet(target).collect())

    assert arrive([(JAN, 1), (JAN, 1), (FEB, 2)]) == [(JAN, 1), (FEB, 2)]
    assert arrive([(FEB, 2), (FEB, 3)]) == [(JAN, 1), (FEB, 2), (FEB, 3)]


def test_scratch_folder_is_the_shared_one(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    a, b = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert a.startswith(base) and a != b


# ---- applications and labels ----


@pytest.fixture
def loans(spark):
    rows = [
        ("L1", "c1", JAN, 1, 0, JAN),
        ("L1", "c1", JAN, 2, 31, FEB),
        ("L2", "c1", JAN, 1, 45, JAN),
        ("L3", "c2", FEB, 1, None, FEB),
        ("L4", "c3", None, 1, 0, FEB),
    ]
    return spark.createDataFrame(rows, "loan_id string, Customer_ID string, loan_start_date date, mob int, dpd int, snapshot_date date")


def test_application_store(loans):
    store = A.application_store(loans)
    assert sorted(map(tuple, store.collect())) == [("c1", JAN, 10000, 10), ("c2", FEB, 10000, 10)]
    assert [r.Customer_ID for r in A.application_store(loans, ["2024-02-01"]).collect()] == ["c2"]
    assert [r.Customer_ID for r in A.select_dates(store).collect()] == ["c2"]
    assert A.select_dates(store, "all").count() == 2
    assert A.select_dates(store, "range", "2024-01-01", "2024-01-31").count() == 1
    assert A.select_dates(store, "2024-01-01").count() == 1


def test_first_snapshots(loans):
    first = A.first_snapshots(loans, "2024-01-31")
    assert sorted((r.loan_id, r.mob) for r in first.collect()) == [("L1", 1), ("L2", 1)]


def test_requests(spark):
    out = A.requests(spark, [("c1", "2024-01-01"), ("c2", JAN, 500, 6)])
    assert sorted(map(tuple, out.collect())) == [("c1", JAN, 10000, 10), ("c2", JAN, 500, 6)]


def test_labels(loans):
    out = L.snapshot_labels(loans, 30, 1)
    assert sorted((r.loan_id, r.label, r.label_def) for r in out.collect()) == [
        ("L1", 0, "30dpd_1mob"),
        ("L2", 1, "30dpd_1mob"),
        ("L3", 0, "30dpd_1mob"),
        ("L4", 0, "30dpd_1mob"),
    ]
    apps = loans.select("loan_id", "Customer_ID", F.col("loan_start_date").alias("application_date"))
    ever = L.ever_default_labels(apps, loans, 30, 2)
    assert sorted((r.loan_id, r.label) for r in ever.collect()) == [("L1", 1), ("L2", 0), ("L3", 0), ("L4", 0)]
    worst = L.worst_dpd_labels(loans, 30, 1)
    assert sorted((r.loan_id, r.label) for r in worst.where("loan_id <> 'L4'").collect()) == [("L1", 1), ("L2", 1), ("L3", None)]


def test_progression(loans):
    out = {r.mob: r for r in L.dpd_progression(loans).collect()}
    assert (out[1].mean_dpd, out[1].median_dpd, out[1].loans_late, out[1].total_loans) == (15.0, 0.0, 1, 4)
    assert out[1].default_rate == 25.0
    counts = L.dpd_threshold_counts(loans).first()
    assert (counts.n_current, counts.n_dpd_30_plus, counts.n_dpd_60_plus, counts.pct_current) == (2, 2, 0, 40.0)
    assert L.vintage_curve(loans, "2024-02-01").where("mob = 1").first().bad_rate == 0.5
    assert L.mob_summary(loans.withColumn("overdue_amt", F.lit(1.0))).where("mob = 2").first().loans_with_dpd == 1
