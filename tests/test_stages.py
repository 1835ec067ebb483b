import random

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel

from riskflow.operators import modeling as M
from riskflow.operators import stages as P

NAN, INF = float("nan"), float("inf")


@pytest.fixture(scope="module")
def data(spark):
    rnd = random.Random(4)
    rows = []
    for i in range(400):
        a, b = rnd.gauss(0, 1), rnd.gauss(0, 1)
        label = int(a + 0.3 * b + rnd.gauss(0, 0.5) > 0.8)
        rows.append((i, a if i % 9 else None, b if i % 5 else INF, rnd.random() if i % 3 == 0 else None, 2.5, rnd.gauss(0, 1), rnd.choice(["x", "x", "x", "y", "y", "z", None]), label))
    return spark.createDataFrame(rows, "id long, a double, b double, rare double, flat double, noise double, kind string, label int")


FEATURES = ["a", "b", "rare", "flat", "noise"]


@pytest.fixture(scope="module")
def fitted(data):
    return Pipeline(stages=P.preparation(FEATURES, categories=["kind"], k=3, top=2, weight="weight")).fit(data)


def test_what_is_learned(data, fitted, spark):
    got = {(r.stage, r.feature): (r.value, r.kept) for r in P.fitted_values(fitted, spark).collect()}
    wide = data.toPandas().replace([np.inf, -np.inf], np.nan)
    assert got["CategoryFlags", "x"] == (1.0, True) and ("CategoryFlags", "z") not in got
    assert got["MissingRateFilter", "rare"][1] is False and got["MissingRateFilter", "b"][0] == pytest.approx(wide.b.isna().mean())
    for c in ("a", "b", "noise"):
        assert got["MedianImputer", c][0] == pytest.approx(wide[c].median(), abs=1e-12)
        assert got["CorrelationFilter", c][0] == pytest.approx(wide[c].fillna(wide[c].median()).corr(wide.label), abs=1e-9)
    assert got["ConstantFilter", "flat"] == (1.0, False) and ("CorrelationFilter", "flat") not in got
    n, pos = len(wide), wide.label.sum()
    assert got["ClassWeight", "1"][0] == pytest.approx(n / (2 * pos)) and got["ClassWeight", "0"][0] == pytest.approx(n / (2 * (n - pos)))
    assert P.selected_features(fitted)[0] == "a" and len(P.selected_features(fitted)) == 3


def test_saved_and_loaded(data, fitted, spark, tmp_path):
    fitted.write().overwrite().save(str(tmp_path / "p"))
    again = PipelineModel.load(str(tmp_path / "p"))
    assert P.fitted_values(again, spark).collect() == P.fitted_values(fitted, spark).collect()
    one, two = (m.transform(data).select("id", "raw_features", "weight").orderBy("id").collect() for m in (fitted, again))
    assert one == two and len(one[0].raw_features) == 3
    assert not any(np.isnan(r.raw_features.toArray()).any() for r in one)


def test_odd_rows_when_scoring(data, fitted, spark):
    """Values never seen, none at all, no label column, extra columns."""
    rows = [(1, None, None, None, None, None, "new"), (2, NAN, -INF, INF, 1.0, 0.0, None), (3, 0.5, 0.5, 0.5, 0.5, 0.5, "x")]
    odd = spark.createDataFrame(rows, "id long, a double, b double, rare double, flat double, noise double, kind string").selectExpr("*", "7 AS extra")
    out = fitted.transform(odd).orderBy("id").collect()
    medians = dict(zip(*[next(s for s in fitted.stages if isinstance(s, P.MedianImputerModel)).getOrDefault(p) for p in ("names", "medians")]))
    names = P.selected_features(fitted)
    assert list(out[0].raw_features) == [0.0 if n.startswith("kind") else medians[n] for n in names]
    assert "weight" not in out[0].asDict() and out[0].extra == 7
    assert fitted.transform(odd.limit(0)).count() == 0


def test_nothing_left(spark):
    df = spark.createDataFrame([(None, 1), (None, 0)], "a double, label int")
    with pytest.raises(ValueError, match="leaves no feature"):
        Pipeline(stages=P.preparation(["a"])).fit(df)


def test_inside_the_search(data, spark, tmp_path):
    found = M.search(data, FEATURES, key="id", n_trials=2, folds=2, stages=P.preparation(FEATURES, k=2, weight="weight"), weight="weight")
    assert found.cv_auc > 0.8 and P.selected_features(found.model) == ["a", "b"]
    found.model.write().overwrite().save(str(tmp_path / "m"))
    again = M.score(PipelineModel.load(str(tmp_path / "m")), data.drop("label"))
    assert again.columns == [*data.drop("label").columns, "model_predictions"]
    assert [r[0] for r in again.orderBy("id").select("model_predictions").collect()] == [r[0] for r in M.score(found.model, data).orderBy("id").select("model_predictions").collect()]
    # Balanced weights centre the probabilities, whatever the share of the class.
    assert 0.35 < again.agg({"model_predictions": "avg"}).first()[0] < 0.65
    top = M.coefficients(found.model, P.selected_features(found.model), spark).first()
    assert top.feature == "a"
