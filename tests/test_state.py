"""Features from stored customer state must equal those from the whole history."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from riskflow import jobs
from riskflow.operators import features as G
from riskflow.operators import state as T
from riskflow.operators.applications import requests
from riskflow.plans import layers
from riskflow.sources import sinks, tables

START = date(2020, 1, 1)
FINANCIALS = "Customer_ID string, snapshot_date date, Annual_Income double, Outstanding_Debt double, Payment_Behaviour string, Credit_Mix string, Type_of_Loan string, Credit_History_Age string, Num_of_Loan int, Num_of_Delayed_Payment int, Changed_Credit_Limit double, asof_date date"
ATTRIBUTES = "Customer_ID string, snapshot_date date, Age int, Occupation string"
CLICKS = "Customer_ID string, snapshot_date date, " + ", ".join(f"fe_{i} int" for i in range(1, 21))


def book(seed=1, days=900, customers=12):
    """Histories with gaps, null keys and null values; one customer has a row every day."""
    rnd = random.Random(seed)
    out = {"features_financials": [], "features_attributes": [], "feature_clickstream": []}
    for c in range(customers):
        for d in range(days):
            if c and rnd.random() > 0.03:
                continue
            name, day = (None if rnd.random() < 0.02 else f"C{c}"), START + timedelta(d)
            some = lambda x: None if rnd.random() < 0.2 else x
            out["features_financials"].append((name, day, some(rnd.random() * 1e5), some(rnd.random() * 1e4), "Unknown", "Good", "Auto Loan", "3 Years and 2 Months", 2, some(rnd.choice([0, 0, 0, 7, 40])), some(rnd.choice([0.0, 2.5, -1.0])), day))
            out["features_attributes"].append((name, day, rnd.randrange(10, 95), rnd.choice(["Lawyer", "Doctor"])))
            out["feature_clickstream"].append((name, day, *[some(rnd.randrange(-5, 90)) for _ in range(20)]))
    apps = [(f"C{rnd.randrange(customers + 2)}", START + timedelta(rnd.randrange(days)), 10_000, 10) for _ in range(150)] + [(None, START + timedelta(400), 10_000, 10)]
    return out, apps


@pytest.fixture(scope="module")
def mart(spark, tmp_path_factory):
    """The book as silver tables and an application store."""
    root = str(tmp_path_factory.mktemp("state"))
    out, apps = book()
    for name, schema in zip(out, (FINANCIALS, ATTRIBUTES, CLICKS)):
        sinks.write_snapshots(spark.createDataFrame(out[name], schema).withColumn("snapshot_date", F.trunc("snapshot_date", "MM")).dropDuplicates(["Customer_ID", "snapshot_date"]), f"{root}/silver/{name}")
    store = spark.createDataFrame(apps, "Customer_ID string, application_date date, loan_amt int, tenure int")
    sinks.write_snapshots(store.dropDuplicates(["Customer_ID", "application_date"]), f"{root}/gold/application_store", "application_date")
    return root


@pytest.mark.parametrize("strict", [False, True])
def test_steps_equal_whole_history(spark, strict):
    out, apps = book()
    kept = T.feature_states()
    whole = [spark.createDataFrame(out[n], s) for n, s in zip(out, (FINANCIALS, ATTRIBUTES, CLICKS))]
    applications = spark.createDataFrame(apps, "Customer_ID string, application_date date, loan_amt int, tenure int").dropDuplicates(["Customer_ID", "application_date"])
    cuts = [START + timedelta(d) for d in (100, 131, 500, 899)]
    states, through, parts = dict.fromkeys(kept), None, []
    for end in cuts:
        new = [h.where((F.col("snapshot_date") <= F.lit(end)) & (F.lit(through is None) | (F.col("snapshot_date") > F.lit(through or START)))) for h in whole]
        mine = applications.where((F.col("application_date") <= F.lit(end)) & (F.lit(through is None) | (F.col("application_date") > F.lit(through or START))))
        parts.append(G.build_features(mine, *[T.history(states[n], h, kept[n], through, end) for n, h in zip(kept, new)], strict=strict, top_occupations=["Doctor"]))
        # A state is written by its users; a checkpoint does as well here.
        spark.sparkContext.setCheckpointDir(spark.conf.get("spark.checkpoint.dir"))
        states = {n: T.merge(states[n], h, kept[n], end, buckets=3).checkpoint() for n, h in zip(kept, new)}
        through = end
    full = G.build_features(applications, *whole, strict=strict, top_occupations=["Doctor"])
    got = tables.union_snapshots(parts, strict=True)
    rounded = lambda df: df.select([F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in full.dtypes])
    assert got.count() == full.count() and rounded(got).exceptAll(rounded(full)).count() == 0


def test_state_is_short_and_steps_do_not_matter(spark):
    out, _ = book()
    kept = T.feature_states()["features_financials"]
    whole = spark.createDataFrame(out["features_financials"], FINANCIALS)
    end = START + timedelta(899)
    once = T.merge(None, whole, kept, end, buckets=3)
    twice = T.merge(T.merge(None, whole.where(F.col("snapshot_date") < "2021-05-05"), kept, "2021-05-04", buckets=3), whole.where(F.col("snapshot_date") >= "2021-05-05"), kept, end, buckets=3)
    assert once.exceptAll(twice).count() == twice.exceptAll(once).count() == 0
    assert once.groupBy("Customer_ID").count().agg(F.max("count")).first()[0] <= kept.days + 2
    assert once.where("Customer_ID IS NULL").count() == 0


def test_totals(spark):
    out, _ = book()
    kept = T.Kept(total=True, columns=("fe_1", "fe_2"))
    whole = spark.createDataFrame(out["feature_clickstream"], CLICKS)
    early, late = whole.where("snapshot_date <= DATE '2021-01-31'"), whole.where("snapshot_date > DATE '2021-01-31'")
    state = T.merge(None, early, kept, "2021-01-31")
    apps = spark.createDataFrame([(f"C{i}", date(2021, m, 15)) for i in range(12) for m in (2, 9)], "Customer_ID string, application_date date")
    columns = ["Customer_ID", "application_date", "fe_1_sum_all", "fe_2_sum_all"]
    full = G.click_totals(whole.select("Customer_ID", "snapshot_date", "fe_1", "fe_2"), apps).select(columns)
    part = G.click_totals(T.history(state, late, kept, "2021-01-31", "2021-12-31"), apps).select(columns)
    assert full.exceptAll(part).count() == 0 and part.where("fe_1_sum_all IS NOT NULL").count() > 12
    again = T.merge(state, late, kept, "2022-12-31").select("Customer_ID", "fe_1")
    assert again.exceptAll(whole.where("Customer_ID IS NOT NULL").groupBy("Customer_ID").agg(F.sum("fe_1").alias("fe_1"))).count() == 0


def step(spark, root, *argv):
    jobs.run(spark, jobs.parser().parse_args([argv[0], "--root", root, *argv[1:]]))


def test_rebuilt_days_equal_the_full_build(spark, mart):
    step(spark, mart, "features")
    store = f"{mart}/gold/feature_store"
    full = tables.read_table(spark, store)
    expected = {tuple(r) for r in full.collect()}
    schema, files = full.schema, set(full.inputFiles())
    step(spark, mart, "state", "--through", "2020-12-31")
    step(spark, mart, "state", "--through", "2021-06-30")
    days = [str(d) for d in tables.stored_dates(spark, f"{mart}/gold/application_store", "application_date") if date(2021, 7, 1) <= d <= date(2021, 12, 31)]
    step(spark, mart, "features", "--dates", *days)
    again = tables.read_table(spark, store)
    assert again.schema == schema and {tuple(r) for r in again.collect()} == expected
    assert {f.split("snapshot_date=")[1][:10] for f in files ^ set(again.inputFiles())} == set(days)


def test_only_new_days(spark, mart):
    store = f"{mart}/gold/feature_store"
    step(spark, mart, "features", "--asof", "2021-08-31")
    files = set(tables.read_table(spark, store).inputFiles())
    more = spark.createDataFrame([("C0", date(2022, 5, 5), 10_000, 10)], "Customer_ID string, application_date date, loan_amt int, tenure int")
    sinks.write_snapshots(more, f"{mart}/gold/application_store", "application_date")
    layers.feature_table(spark, mart, only_new=True)
    after = tables.read_table(spark, store)
    assert files < set(after.inputFiles()) and after.where("snapshot_date = DATE '2022-05-05'").count() == 1
    files = set(after.inputFiles())
    layers.feature_table(spark, mart, only_new=True)
    assert set(tables.read_table(spark, store).inputFiles()) == files


def test_plan_reads_state_and_new_partitions_only(spark, mart):
    layers.customer_state(spark, mart, "2021-10-31")
    df = layers.feature_history(spark, mart, "features_financials", date(2021, 11, 1), date(2021, 11, 30))
    plan = df._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.split("\n") if "FileScan" in line]
    assert len(scans) == 2
    assert all("PartitionFilters: [isnotnull(" in s for s in scans)
    assert any("through" in s and "2021-10-31" in s for s in scans)
    read = {f for f in df.inputFiles()}
    kept = tables.read_table(spark, f"{mart}/silver/features_financials").where("snapshot_date > DATE '2021-10-31' AND snapshot_date <= DATE '2021-11-30'")
    assert kept.count() > 0 and {r[0] for r in df.select(F.input_file_name()).distinct().collect()} <= read
    assert not {f for f in {r[0] for r in df.select(F.input_file_name()).distinct().collect()} if "silver" in f and "2021-11-01" not in f}


def test_state_of_some_customers_reads_their_buckets(spark, mart):
    layers.customer_state(spark, mart, "2021-10-31")
    whole = T.read_state(spark, f"{mart}/gold/customer_state/features_attributes", "2021-10-31")
    asked = spark.createDataFrame([("C3",), (None,)], "Customer_ID string")
    one = T.of_customers(whole, asked)
    assert {r.Customer_ID for r in one.collect()} == {"C3"}
    assert "bucket" in one._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1][:200]
    assert T.of_customers(whole, asked.limit(0)).count() == 0


def test_requests_equal_the_batch_build(spark, mart):
    layers.customer_state(spark, mart, "2021-09-30")
    asked = requests(spark, [("C0", "2021-12-03"), ("C5", "2021-11-20"), ("nobody", "2021-12-03"), (None, "2021-12-03")])
    got = layers.request_features(spark, mart, asked)
    silver = [tables.read_table(spark, f"{mart}/silver/{n}") for n in T.feature_states()]
    batch = G.build_features(asked, *silver, top_occupations=layers.categories(spark, mart)).drop("income_band")
    assert got.columns == batch.columns and got.count() == 4
    rounded = lambda df: df.select([F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in batch.dtypes])
    assert rounded(got).exceptAll(rounded(batch)).count() == 0
    assert layers.request_features(spark, mart, asked.limit(0)).count() == 0


def test_categories_are_fitted_once(spark, mart):
    first = layers.categories(spark, mart)
    sinks.write_snapshots(spark.createDataFrame([(f"N{i}", date(2022, 7, 1), 30, "Pilot") for i in range(900)], ATTRIBUTES), f"{mart}/silver/features_attributes")
    assert layers.categories(spark, mart) == first and "Pilot" not in first
    assert layers.categories(spark, mart, refit=True)[0] == "Pilot"


def test_stored_dates(spark, mart, tmp_path):
    days = tables.stored_dates(spark, f"{mart}/silver/feature_clickstream")
    assert days == sorted(r[0] for r in tables.read_table(spark, f"{mart}/silver/feature_clickstream").select("snapshot_date").distinct().collect())
    assert tables.stored_dates(spark, str(tmp_path / "none")) == []
