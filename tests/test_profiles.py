"""Profiles that are kept per partition and merged."""

import math
import random
from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskflow.operators import profiles as P
from riskflow.plans import layers
from riskflow.sources import sinks, tables

SCHEMA = "k string, v double, note string, snapshot_date date"
MONTHS = [date(2024, m, 1) for m in (1, 2, 3)]


def book(spark, n=900, seed=3):
    """A third of all rows in one month; large values close together, nulls, NaN, texts that repeat."""
    rnd = random.Random(seed)

    def value():
        return rnd.choice([None, float("nan"), 1e9 + rnd.random(), 1e9 + rnd.random()])

    rows = [(f"k{rnd.randrange(n)}", value(), rnd.choice(["a", "b", "", None]), rnd.choice([*MONTHS, MONTHS[0]])) for _ in range(n)]
    return rows, spark.createDataFrame(rows, SCHEMA)


def by_column(df):
    return {r["column"]: r for r in df.collect()}


def test_merged_profile_equals_plain_figures(spark):
    rows, df = book(spark)
    found = by_column(P.read_profile(P.merge_profiles(P.partition_profiles(df, ["snapshot_date"]))))
    assert set(found) == {"k", "v", "note"}
    known = np.array([r[1] for r in rows if r[1] is not None and not math.isnan(r[1])])
    v = found["v"]
    assert (v.n_rows, v.missing_count) == (len(rows), sum(r[1] is None for r in rows))
    assert v["mean"] == pytest.approx(known.mean(), rel=1e-14) and v["std"] == pytest.approx(known.std(ddof=1), rel=1e-5)
    assert (v["min"], v["max"]) == (known.min(), known.max())
    assert (found["note"].missing_count, found["note"]["mean"]) == (sum(r[2] is None for r in rows), None)
    exact = len({r[0] for r in rows})
    assert abs(found["k"].approx_distinct / exact - 1) <= 4 * P.sketch_error()


def test_merging_in_steps_changes_nothing(spark):
    _, df = book(spark)
    parts = P.partition_profiles(df, ["snapshot_date"]).cache()
    at_once = by_column(P.read_profile(P.merge_profiles(parts)))
    early = P.merge_profiles(parts.where("snapshot_date < '2024-03-01'"))
    late = parts.where("snapshot_date = '2024-03-01'").drop("snapshot_date")
    steps = by_column(P.read_profile(P.merge_profiles(early.unionByName(late))))
    for c, row in at_once.items():
        exact = P.exact_distinct(P.value_counts_of(df, ["snapshot_date"], [c])).first().n_distinct
        assert all(abs(r.approx_distinct / exact - 1) <= 4 * P.sketch_error() for r in (row, steps[c]))
        for name in set(row.asDict()) - {"approx_distinct"}:
            assert steps[c][name] == (pytest.approx(row[name], rel=1e-7) if isinstance(row[name], float) else row[name]), (c, name)
    parts.unpersist()


def test_exact_counts_equal_plain_counts(spark):
    rows, df = book(spark)
    found = by_column(P.exact_distinct(P.value_counts_of(df, ["snapshot_date"], ["k", "note"])))
    for i, c in ((0, "k"), (2, "note")):
        counts: dict = {}
        for r in rows:
            if r[i] is not None:
                counts[r[i]] = counts.get(r[i], 0) + 1
        top = min(counts, key=lambda x: (-counts[x], x))
        assert found[c].asDict() == {"column": c, "n_distinct": len(counts), "top_value": top, "top_n": counts[top], "n_repeated": sum(n > 1 for n in counts.values())}


def test_odd_tables(spark):
    assert P.read_profile(P.merge_profiles(P.partition_profiles(spark.createDataFrame([], SCHEMA), ["snapshot_date"]))).collect() == []
    one = spark.createDataFrame([(None, None, None, None)], SCHEMA)
    found = by_column(P.read_profile(P.merge_profiles(P.partition_profiles(one, ["snapshot_date"]))))
    assert {(r.n_rows, r.missing_count, r["mean"], r["std"], r.approx_distinct) for r in found.values()} == {(1, 1, None, None, 0)}
    assert P.exact_distinct(P.value_counts_of(one, ["snapshot_date"], ["k", "v"])).collect() == []
    (whole,) = P.store_completeness(P.merge_profiles(P.partition_profiles(one, ["snapshot_date"]))).collect()
    assert (whole.n_rows, whole.n_columns, whole.null_share) == (1, 3, 1.0)


def test_a_new_month_is_the_only_one_read(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "mart")
    rows, df = book(spark)
    read = []
    plain = P.partition_profiles

    def noted(new, *args):
        read.append({f.split("snapshot_date=")[1][:10] for f in (r[0] for r in new.select(F.input_file_name()).distinct().collect())})
        return plain(new, *args)

    monkeypatch.setattr(P, "partition_profiles", noted)
    sinks.write_snapshots(df.where("snapshot_date < '2024-03-01'"), f"{root}/silver/book")
    layers.profile(spark, root, "book")
    sinks.write_snapshots(df.where("snapshot_date = '2024-03-01'"), f"{root}/silver/book")
    found = by_column(layers.profile(spark, root, "book", exact=["note"]))
    assert read == [{"2024-01-01", "2024-02-01"}, {"2024-03-01"}]
    assert found["k"].n_rows == len(rows) and (found["note"].n_distinct, found["k"].n_distinct) == (3, None)
    layers.profile(spark, root, "book")
    assert len(read) == 2  # nothing was written since
    path = layers.profile_report(spark, root, "book", exact=["note", "absent"])
    assert spark.read.csv(path, header=True).count() == 3
    assert tables.read_table(spark, f"{root}/profiles/silver/book").select("snapshot_date").distinct().count() == 3
