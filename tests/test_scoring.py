"""Model set, mapInPandas scoring, failure isolation, Spark ML scoring (M1-M5, T16)."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelcast.operators import scoring


def tensors(spark, n=5, k=6, f=6):
    rng = np.random.default_rng(0)
    rows = [(f"E{i}", rng.normal(size=(k, f)).round(3).tolist()) for i in range(n)]
    return spark.createDataFrame(rows, "district string, tensor array<array<double>>"), rows


def test_score_matches_numpy_and_isolates_failures(spark):
    class Broken:                              # local classes travel to workers by value
        def predict(self, x):
            raise RuntimeError("boom")

    class WrongShape:
        def predict(self, x):
            return np.zeros((len(x), 4))

    df, rows = tensors(spark)
    w = np.arange(3 * 36, dtype=float).reshape(3, 36) / 100.0
    lin = scoring.LinearModel(scoring.as_tuple(w), (0.5, 0.0, -0.5))
    ms = scoring.ModelSet({"lin": lin, "broken": Broken(), "wide": WrongShape()})
    out = scoring.score(df, ms, 3).collect()
    good = {(r.district, r.horizon): r.y for r in out if r.model == "lin"}
    for name, t in rows:
        y = w @ np.asarray(t).reshape(-1) + np.array([0.5, 0.0, -0.5])
        for h in range(3):
            assert good[(name, h + 1)] == pytest.approx(y[h])
    errs = [r for r in out if r.model in ("broken", "wide")]
    assert len(errs) == 10 and all(r.error for r in errs)          # M4, T16
    assert scoring.good_rows(scoring.score(df, ms, 3)).count() == 15


def test_dense_model_and_npz_loading(spark, tmp_dir):
    df, rows = tensors(spark)
    rng = np.random.default_rng(1)
    w1, b1, w2, b2 = rng.normal(size=(8, 36)), rng.normal(size=8), rng.normal(size=(3, 8)), rng.normal(size=3)
    np.savez(f"{tmp_dir}/dense.npz", w1=w1, b1=b1, w2=w2, b2=b2)
    ms = scoring.ModelSet.load({"Dense": scoring.NpzModel(f"{tmp_dir}/dense.npz"),
                                "Missing": scoring.NpzModel(f"{tmp_dir}/absent.npz")})
    assert ms.names == ["Dense"]                                      # M3: missing model skipped
    got = {(r.district, r.horizon): r.y for r in scoring.good_rows(scoring.score(df, ms)).collect()}
    x = np.asarray(rows[0][1]).reshape(-1)
    y = np.maximum(w1 @ x + b1, 0) @ w2.T + b2
    assert got[("E0", 1)] == pytest.approx(y[0])


def test_no_model_loads_is_an_error():
    with pytest.raises(RuntimeError, match="no model"):
        scoring.ModelSet.load({"x": scoring.NpzModel("/nonexistent.npz")})


def test_linear_scores_as_columns_equal_numpy_scoring(spark):
    df, rows = tensors(spark)
    w = np.linspace(-1, 1, 3 * 36).reshape(3, 36)
    lin = scoring.LinearModel(scoring.as_tuple(w), (0.0, 0.1, 0.2))
    a = {(r.district, r.horizon): r.y for r in
         scoring.linear_scores(df, {"m": lin}, F.flatten("tensor"), ["district"]).collect()}
    b = {(r.district, r.horizon): r.y for r in scoring.score(df, scoring.ModelSet({"m": lin})).collect()}
    assert a.keys() == b.keys()
    for key in a:
        assert a[key] == pytest.approx(b[key], abs=1e-9)


def test_spark_ml_scoring_on_flat_features_with_one_hot(spark):
    from pyspark.ml.regression import LinearRegression
    rng = np.random.default_rng(2)
    rows = [(f"E{i}", i, rng.normal(size=30).tolist()) for i in range(20)]
    df = spark.createDataFrame(rows, "district string, entity_id int, flat array<double>")
    ids = df.select("entity_id")
    feats = scoring.feature_vector(df, "flat", "entity_id", ids)
    assert feats.first().features.size == 30 + 20
    train = feats.withColumn("label", F.element_at("flat", 1) * 2.0 + 1.0)
    models = {h: LinearRegression(regParam=0.0).fit(train) for h in (1, 2, 3)}
    out = scoring.score_spark_ml(feats, models)
    assert out.count() == 60
    r = out.filter("district = 'E3' AND horizon = 2").first()
    assert r.y == pytest.approx(rows[3][2][0] * 2.0 + 1.0, abs=1e-6)


def test_tabular_one_hot_effect(spark):
    rows = [("A", 0, [1.0] * 30), ("B", 2, [0.0] * 30), ("C", 9, [0.0] * 30)]
    df = spark.createDataFrame(rows, "district string, entity_id int, flat array<double>")
    effects = spark.createDataFrame([(0, [0.0, 0.0, 0.0]), (1, [1.0, 1.0, 1.0]), (2, [5.0, 6.0, 7.0])],
                                    "entity_id int, effect array<double>")
    m = scoring.TabularLinear(scoring.as_tuple(np.ones((3, 30))), (0.0, 0.0, 0.0))
    got = {(r.district, r.horizon): r.y for r in scoring.score_tabular(df, m, effects).collect()}
    assert got[("A", 1)] == 30.0 and got[("B", 3)] == 7.0 and got[("C", 2)] == 0.0
