"""Changes are told by folders: nothing of an untouched date is opened."""

import time
from datetime import date

from pyspark.sql import functions as F

from riskflow.plans import layers
from riskflow.sources import sinks, tables
from riskflow.streaming.incremental import refresh_snapshots

SCHEMA = "k long, v long, snapshot_date date"


def rows(spark, *triples):
    return spark.createDataFrame([(k, v, date.fromisoformat(d) if d else None) for k, v, d in triples], SCHEMA)


def test_stream_rebuilds_touched_dates_from_their_folders(spark, tmp_path):
    source, target, check = (str(tmp_path / n) for n in ("source", "target", "check"))
    read = []

    def clean(df):
        plan = df._jdf.queryExecution().executedPlan().toString()
        read.append((plan.split("PartitionFilters: [")[1].split("]")[0], {f.split("snapshot_date=")[1][:10] for f in {r[0] for r in df.select(F.input_file_name()).collect()}}))
        return df.groupBy("k", "snapshot_date").agg(F.max("v").alias("v"))

    def arrive(*triples):
        rows(spark, *triples).coalesce(1).write.mode("append").parquet(source)
        refresh_snapshots(spark, source, rows(spark).schema, target, check, clean)
        return {(r.k, str(r.snapshot_date)): r.v for r in tables.read_table(spark, target).collect()}

    assert arrive((1, 10, "2024-01-01"), (2, 20, "2024-02-01"), (3, 30, None)) == {(1, "2024-01-01"): 10, (2, "2024-02-01"): 20}
    untouched = {f for f in tables.read_table(spark, target).inputFiles() if "2024-01-01" in f}
    # Late rows for February and a new month: January is neither read nor written.
    assert arrive((2, 25, "2024-02-01"), (4, 40, "2024-02-01"), (5, 50, "2024-03-01")) == {
        (1, "2024-01-01"): 10, (2, "2024-02-01"): 25, (4, "2024-02-01"): 40, (5, "2024-03-01"): 50,
    }
    assert read[-1][1] == {"2024-02-01", "2024-03-01"} and "2024-02-01" in read[-1][0] or "snapshot_date" in read[-1][0]
    assert untouched <= set(tables.read_table(spark, target).inputFiles())
    n = len(read)
    assert len(arrive((6, 60, None))) == 4 and len(read) == n  # nothing dated came


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    landing = str(tmp_path / "landing")
    batch = rows(spark, (1, 1, "2024-01-01"), (2, 2, "2024-02-01")).withColumn("batch", F.lit(7))
    for _ in range(2):
        sinks.write_snapshots(batch, landing, ["snapshot_date", "batch"])
    assert tables.read_table(spark, landing).count() == 2


def test_changed_dates(spark, tmp_path):
    root, mark = str(tmp_path / "t"), str(tmp_path / "mark")
    assert tables.changed_dates(spark, root, mark) == {}
    sinks.write_snapshots(rows(spark, (1, 1, "2024-01-01"), (2, 2, "2024-02-01")), root)
    first = tables.changed_dates(spark, root, mark)
    assert sorted(first) == [date(2024, 1, 1), date(2024, 2, 1)]
    sinks.write_snapshots(spark.createDataFrame(sorted(first.items()), "snapshot_date date, modified long"), mark)
    assert tables.changed_dates(spark, root, mark) == {}
    time.sleep(0.05)
    sinks.write_snapshots(rows(spark, (2, 3, "2024-02-01"), (3, 3, "2024-03-01")), root)
    assert sorted(tables.changed_dates(spark, root, mark)) == [date(2024, 2, 1), date(2024, 3, 1)]


def test_silver_of_changed_months(spark, tmp_path):
    store = str(tmp_path / "store")
    head = "Customer_ID,Age,Occupation,Name,SSN,snapshot_date\n"

    def deliver(*lines):
        path = tmp_path / "features_attributes.csv"
        path.write_text(head + "\n".join(lines) + "\n")
        layers.bronze(spark, str(path), "features_attributes", store)
        layers.silver(spark, "features_attributes", store, only_changed=True)
        return tables.read_table(spark, f"{store}/silver/features_attributes")

    first = deliver("C1,30,Lawyer,N,1,2024-01-01", "C1,30,Lawyer,N,1,2024-02-01")
    files = set(first.inputFiles())
    assert first.count() == 2
    layers.silver(spark, "features_attributes", store, only_changed=True)
    assert set(tables.read_table(spark, f"{store}/silver/features_attributes").inputFiles()) == files
    time.sleep(0.05)
    again = deliver("C1,44,Lawyer,N,1,2024-02-01", "C2,50,Doctor,N,1,2024-02-01")
    assert {(str(r.snapshot_date), r.Customer_ID, r.Age) for r in again.collect()} == {("2024-01-01", "C1", 30), ("2024-02-01", "C1", 44), ("2024-02-01", "C2", 50)}
    assert {f for f in files if "2024-01-01" in f} <= set(again.inputFiles())
