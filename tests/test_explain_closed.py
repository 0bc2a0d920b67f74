"""Closed forms of explanations against the sampled ones."""
import numpy as np
from pyspark.sql import functions as F

from quarry.operators import explain, forest

COLS = ["a", "b", "c"]


class Opaque:
    """A scorer whose kind isn't known, so that it is sampled."""

    def __init__(self, f):
        self.f = f

    def __call__(self, x):
        return self.f(x)


def _rows(spark, missing=True):
    rng = np.random.default_rng(4)
    rows = [(i // 2, *map(float, rng.integers(0, 9, 3)), int(rng.random() < 0.5)) for i in range(60)]
    if missing:
        rows += [(90, None, 1.0, 2.0, 0), (91, 1.0, float("nan"), 2.0, 1), (None, 1.0, 2.0, 3.0, 0)]
    return spark.createDataFrame(rows, "id long, a double, b double, c double, y int")


def test_linear_values_are_columns(spark):
    df, bg = _rows(spark), np.arange(15.0).reshape(5, 3)
    f = explain.LinearScorer([1.5, -2.0, 0.25], 3.0)
    got = explain.shapley(df, f, COLS, bg, ["id"])
    want = explain.shapley(df, f, COLS, bg, ["id"], exact=False)
    assert "mapInPandas" not in got._jdf.queryExecution().toString() and "MapInPandas" not in got._jdf.queryExecution().toString()
    assert got.schema.names == want.schema.names
    def listed(x):
        return sorted((tuple(None if v is None else round(v, 9) if isinstance(v, float) else v for v in r) for r in x.collect()), key=repr)
    assert listed(got) == listed(want)


def test_waterfall_computes_the_values_once(spark):
    f = explain.LinearScorer([1.5, -2.0, 0.25], 3.0)
    sh = explain.shapley(_rows(spark), f, COLS, np.ones((2, 3)), ["id"])
    got = explain.shap_waterfall(sh, ["id"], 2)
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Generate explode") == 1
    by_id = {}
    for r in sh.collect():
        by_id.setdefault(r["id"], []).append(r["shap_value"])
    for r in got.collect():
        vals = sorted((v for v in by_id[r["id"]] if v is not None), key=lambda v: -abs(v))
        if not vals:
            assert r["shap_value"] is None
        elif r["position"] == 1:
            assert abs(abs(r["shap_value"]) - abs(vals[0])) < 1e-12
        else:
            assert r["position"] == 2 and r["feature"] == "rest" and len(vals) > 1


def test_interactions_by_leaf(spark, monkeypatch):
    df = _rows(spark)
    m = forest.fit_forest(df, COLS, "y", "id", n_trees=4, max_depth=4, max_features="all")
    f = explain.ForestScorer(m)
    bg = np.array([[float(v) for v in r] for r in _rows(spark, False).limit(7).select(*COLS).collect()])
    want = {(r["feature_a"], r["feature_b"]): r["strength"] for r in explain.shap_interactions(df, Opaque(f), COLS, bg, 4, 3).collect()}
    monkeypatch.setattr(explain, "_interactions", None)  # 8 x orders x background evaluations of the forest for each pair and row
    got = {(r["feature_a"], r["feature_b"]): r["strength"] for r in explain.shap_interactions(df, f, COLS, bg, 4, 3).collect()}
    assert want.keys() == got.keys() and all(abs(want[k] - got[k]) < 1e-9 for k in want) and max(want.values()) == 1.0
