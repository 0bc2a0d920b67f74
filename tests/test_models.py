import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import explain, forest, svr


def test_one_split_recovered(spark):
    rows = [(i, float(i), float(i % 7), int(i >= 30)) for i in range(60)]
    df = spark.createDataFrame(rows, "k int, a double, b double, y int")
    m = forest.fit_forest(df, ["a", "b"], "y", "k", n_trees=1, max_depth=3, max_features="all",
                          bootstrap_rows=False, min_samples_leaf=1, min_samples_split=2, impurity="gini")
    t = m.trees[0]
    assert m.features[t["feat"][0]] == "a" and t["thr"][0] == 29.5
    # children counts add up, children are pure leaves
    for i in range(len(t["feat"])):
        if t["feat"][i] >= 0:
            l, r = t["left"][i], t["right"][i]
            assert t["c0"][i] + t["c1"][i] == pytest.approx(t["c0"][l] + t["c1"][l] + t["c0"][r] + t["c1"][r])
    assert len(t["feat"]) == 3
    p = forest.predict_forest(df, m).filter(F.col("prediction") != F.col("y")).count()
    assert p == 0


def test_labels_must_be_binary(spark):
    df = spark.createDataFrame([(1, 1.0, 2), (2, 2.0, 0)], "k int, a double, y int")
    with pytest.raises(ValueError):
        forest.fit_forest(df, ["a"], "y", "k", n_trees=1)


def test_bootstrap_weights_mean_one(spark):
    df = spark.range(20000).withColumnRenamed("id", "k")
    b = forest.bootstrap(df, "k", 2, 3)
    m = b.agg(F.avg("weight"), F.avg((F.col("weight") == 0).cast("double"))).first()
    assert abs(m[0] - 1.0) < 0.03 and abs(m[1] - np.exp(-1)) < 0.02


def test_svr_objective_and_beats_constant(spark):
    rng = np.random.default_rng(1)
    x = rng.uniform(-2, 2, size=(800, 2))
    y = np.sin(x[:, 0]) * 3 + x[:, 1] + rng.normal(scale=0.1, size=800)
    df = spark.createDataFrame([(i, float(a), float(b), float(t)) for i, ((a, b), t) in enumerate(zip(x, y))],
                               "k int, a double, b double, y double")
    m = svr.fit_svr(df, ["a", "b"], "y", kernel="rbf", C=1.0, epsilon=0.1, n_landmarks=60, key="k")
    best = np.minimum.accumulate(m.objective)
    assert all(np.diff(best) <= 1e-9)
    pred = svr.predict_svr(df, m)
    mse = pred.agg(F.avg((F.col("y") - F.col("prediction")) ** 2)).first()[0]
    assert mse < 0.2 * np.var(y)


def test_kernels():
    a = np.array([[0.0, 1.0]])
    b = np.array([[1.0, 1.0]])
    assert svr.kernel_matrix(a, b, "rbf", 0.5)[0, 0] == pytest.approx(np.exp(-0.5))
    assert svr.kernel_matrix(a, b, "poly", 1.0, 1.0, 2)[0, 0] == pytest.approx(4.0)
    assert svr.kernel_matrix(a, b, "linear", 0.0)[0, 0] == pytest.approx(1.0)


def test_shap_sums_to_prediction(spark):
    rows = [(i, float(i % 10), float(i % 3), int((i % 10) > 4)) for i in range(200)]
    df = spark.createDataFrame(rows, "k int, a double, b double, y int")
    m = forest.fit_forest(df, ["a", "b"], "y", "k", n_trees=5, max_depth=4, max_features="all")
    bg = explain.background(df, ["a", "b"], 20, "k", 0)
    sh = explain.shapley(df, explain.ForestScorer(m), ["a", "b"], bg, ["k"], n_permutations=4)
    chk = sh.groupBy("k").agg((F.sum("shap_value") + F.first("base_value") - F.first("prediction")).alias("d"))
    assert chk.agg(F.max(F.abs("d"))).first()[0] < 1e-9


def test_forest_shapley_equals_all_subsets(spark):
    """Exact values against the definition: every subset of features, against the same background; with missing values."""
    from itertools import combinations
    from math import factorial

    rng = np.random.default_rng(6)
    data = rng.integers(0, 6, size=(300, 4)).astype(float)
    y = ((data[:, 0] > 2) ^ (data[:, 1] + data[:, 2] > 6)).astype(int)
    cols = list("abcd")
    df = spark.createDataFrame([(i, *map(float, r), int(t)) for i, (r, t) in enumerate(zip(data, y))], "k int, a double, b double, c double, d double, y int")
    m = forest.fit_forest(df, cols, "y", "k", n_trees=4, max_depth=5, max_features=3, min_samples_leaf=1, min_samples_split=2)
    f = explain.ForestScorer(m)
    x, bg = data[:12].copy(), data[100:117].copy()
    x[3, 1] = x[4, 0] = bg[2, 2] = np.nan

    def value(row, subset):
        z = bg.copy()
        z[:, list(subset)] = row[list(subset)]
        return f(z).mean()

    want = np.zeros_like(x)
    for r in range(len(x)):
        for j in range(4):
            rest = [i for i in range(4) if i != j]
            for n in range(4):
                for s in combinations(rest, n):
                    want[r, j] += factorial(n) * factorial(3 - n) / 24 * (value(x[r], (*s, j)) - value(x[r], s))
    assert np.allclose(explain.forest_shapley(m, x, bg), want, atol=1e-12)
    sh = explain.shapley(df.filter("k < 40"), f, cols, bg, ["k"])
    off = sh.groupBy("k").agg((F.sum("shap_value") + F.first("base_value") - F.first("prediction")).alias("d"))
    assert off.agg(F.max(F.abs("d"))).first()[0] < 1e-12


def test_svr_candidates_share_passes(spark, monkeypatch):
    """All candidates of a fold are fitted in the same passes, to the models and scores that they have alone."""
    from quarry.operators import search, svr
    rng = np.random.default_rng(3)
    a, b = rng.normal(size=400), rng.normal(size=400)
    rows = [(i, float(a[i]), float(b[i]), float(np.sin(a[i]) + 0.5 * b[i]), i % 2) for i in range(400)]
    df = spark.createDataFrame([*rows, (400, None, 1.0, 1.0, 0), (401, 1.0, 1.0, None, 1)], "k long, a double, b double, y double, fold int")
    grid = [{"kernel": "linear", "C": 1.0}, {"kernel": "rbf", "C": 0.5, "n_landmarks": 20}, {"kernel": "rbf", "C": 2.0, "n_landmarks": 20}]
    alone = [svr.fit_svr(df, ["a", "b"], "y", key="k", **g) for g in grid]
    calls, one = [], svr._pass
    monkeypatch.setattr(svr, "_pass", lambda *x: calls.append(1) or one(*x))
    for m, n in zip(svr.fit_svrs(df, ["a", "b"], "y", grid, "k"), alone):
        assert np.allclose(m.objective, n.objective, rtol=1e-9) and np.allclose(m.w, n.w, rtol=1e-6, atol=1e-9) and abs(m.b - n.b) < 1e-6
    assert len(calls) <= max(len(m.objective) for m in alone) + 1
    calls.clear()
    cv, best, _ = search.grid_search(df, "fold", "svr", ["a", "b"], "y", "k", [{c: [v] for c, v in g.items()} for g in grid],
                                     "regression", "root_mean_squared_error", refit=False)
    assert cv.count() == 3 * 2 * 11 and best["kernel"] == "rbf" and len(calls) <= 2 * 16
    for i, g in enumerate(grid):
        one_cv = search.cross_validate(df, "fold", "svr", ["a", "b"], "y", "k", g, "regression", prep=None)
        want = {(r.fold, r.metric): r.value for r in one_cv.collect()}
        got = {(r.fold, r.metric): r.value for r in cv.filter(f"candidate_id = {i}").collect()}
        assert got.keys() == want.keys() and all(x == got[k] or abs(x - got[k]) <= 1e-6 * abs(x) for k, x in want.items() if x is not None)
