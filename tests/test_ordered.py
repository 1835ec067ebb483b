import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskflow.operators.ordered import cumulate, cut_order, exact_quantiles, first_rows


def _clustered(seed=1):
    """Values of all magnitudes and signs; a third of them lie within a billionth of each other."""
    rnd = random.Random(seed)
    out = [1.0 + rnd.random() * 1e-9 for _ in range(400)]
    out += [rnd.random() * 10 ** rnd.randrange(-12, 12) * rnd.choice([-1, 1]) for _ in range(800)]
    return sorted({*out, 0.0, -1e300, 1e300, 5e-324})


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("rows_per_part", [7, 50_000])
def test_running_totals(spark, descending, rows_per_part):
    values = _clustered()
    data = [(g, v, i % 5 + 1) for i, v in enumerate(values) for g in ("a", "b") if g == "a" or i % 3 == 0]
    df = spark.createDataFrame(data, "g string, v double, n int")
    out = cumulate(df, "v", ["n"], ["g"], descending=descending, rows_per_part=rows_per_part)
    assert out.columns == ["g", "v", "n", "tot_n", "cum_n"]
    got = {(r.g, r.v): (r.cum_n, r.tot_n) for r in out.collect()}
    assert len(got) == len(data)
    for g in ("a", "b"):
        rows = sorted([(v, n) for h, v, n in data if h == g], reverse=descending)
        total, running = sum(n for _, n in rows), 0
        for v, n in rows:
            running += n
            assert got[(g, v)] == (running, total)


def _peaked(rnd):
    return [0.02 + rnd.random() * 1e-4 for _ in range(6000)]


def _outliers(rnd):
    """Nearly all values within a billionth of their size, and two far away in the same power of two."""
    return [0.99999 + rnd.random() * 2e-10 for _ in range(6000)] + [0.75, 0.9999999]


def _nested(rnd):
    """A peak within a peak within a peak."""
    return [1 + rnd.random() * 10.0 ** -rnd.choice([0, 4, 8, 12]) for _ in range(6000)]


@pytest.mark.parametrize("values", [lambda r: [r.random() for _ in range(6000)], _peaked, _outliers, _nested, lambda r: [-(10.0 ** r.uniform(-300, 300)) for _ in range(6000)]])
def test_no_part_is_large(spark, values):
    """Whatever the distribution, the largest part stays below twice the target, and parts are ranges."""
    found = sorted(set(values(random.Random(3))))
    df = spark.createDataFrame([(v, 1) for v in found], "v double, n int").repartition(4)
    parts = cut_order(df, ["v"], rows_per_part=200).groupBy("__part").agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).orderBy("lo").collect()
    assert sum(r.n for r in parts) == len(found) and max(r.n for r in parts) <= 400
    assert all(a.hi < b.lo for a, b in zip(parts, parts[1:]))
    totals = cumulate(df, "v", ["n"], rows_per_part=200)
    assert [r.cum_n for r in totals.orderBy("v").collect()] == list(range(1, len(found) + 1))


def test_small_and_large_groups(spark):
    """A group that holds nearly all rows is cut, thousands of groups of one row are not; both at once."""
    data = [("big", float(i) ** 3, 1) for i in range(5000)] + [(f"g{i}", float(i), 2) for i in range(3000)]
    out = cumulate(spark.createDataFrame(data, "g string, v double, n int"), "v", ["n"], ["g"], rows_per_part=300)
    got = {(r.g, r.v): (r.cum_n, r.tot_n) for r in out.collect()}
    assert len(got) == len(data)
    assert all(got["big", float(i) ** 3] == (i + 1, 5000) and (i >= 3000 or got[f"g{i}", float(i)] == (2, 2)) for i in range(5000))


def test_rows_that_cannot_be_cut(spark):
    df = spark.createDataFrame([(1.0, i) for i in range(500)], "v double, n int")
    assert cut_order(df, ["v"], rows_per_part=10).count() == 500
    assert cumulate(df.limit(0), "v", ["n"]).count() == 0


def test_quantiles_equal_linear_interpolation(spark):
    rnd = np.random.default_rng(2)
    a = np.concatenate([rnd.normal(0, 1, 500), np.full(300, 0.25), rnd.lognormal(5, 3, 200)])
    b = rnd.integers(-5, 5, 1000).astype(float)
    rows = [(i % 2, float(x), None if i % 7 == 0 else float(y)) for i, (x, y) in enumerate(zip(a, b))]
    df = spark.createDataFrame([*rows, (0, float("nan"), None)], "g int, a double, b double")
    p = {"q01": 0.01, "q25": 0.25, "q50": 0.5, "q99": 0.99, "lo": 0.0, "hi": 1.0}
    for groups in ([], ["g"]):
        for r in exact_quantiles(df, ["a", "b"], p, groups).collect():
            values = [x[1] if r.column == "a" else x[2] for x in rows if not groups or x[0] == r.g]
            values = [v for v in values if v is not None]
            for name, q in p.items():
                assert r[name] == pytest.approx(np.quantile(values, q), rel=1e-12, abs=1e-12)


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "a double")
    assert exact_quantiles(df, ["a"], {"q": 0.5}).count() == 0


def test_first_rows_are_limited_before_the_shuffle(spark):
    df = spark.range(100).withColumn("k", F.when(F.col("id") < 90, 0).otherwise(F.col("id")))
    out = first_rows(df, ["k"], [F.desc("id")])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit [") == 2
    assert out.where("k = 0").first().id == 89 and out.count() == 11


def test_written_once_and_spread_by_part(spark, tmp_path):
    path = str(tmp_path / "scores")
    spark.range(1000).selectExpr("id % 3 AS g", "id / 1000 AS v").write.parquet(path)
    counts = spark.read.parquet(path).groupBy("g", "v").agg(F.count("*").alias("n"))
    out = cumulate(counts, "v", ["n"], ["g"])
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert path not in plan and "hashpartitioning(__part" in plan
