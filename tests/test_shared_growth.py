"""Forests that are grown together, searches and experiments with any preprocessing."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import experiments, forest, models, search, splits


@pytest.fixture(scope="module")
def rows(spark):
    data = [(i, float(i % 17), float((i * 7) % 23), "abc"[i % 3] if i % 11 else None, int((i % 17 > 8) ^ (i % 5 == 0))) for i in range(400)]
    return spark.createDataFrame(data, "k long, a double, b double, c string, y int").repartition(3).persist()


def same(one, two):
    assert len(one.trees) == len(two.trees)
    for s, t in zip(one.trees, two.trees):
        for name in s:
            assert np.array_equal(s[name], t[name], equal_nan=True), name


def test_forests_grown_together_equal_single_fits(rows, monkeypatch):
    train = [rows.filter("k % 3 != 0"), rows.filter("k % 3 != 1")]
    params = [{"n_trees": 3, "max_depth": 4, "seed": 1}, {"n_trees": 5, "max_depth": 2, "impurity": "gini", "max_bins": 8, "seed": 1},
              {"n_trees": 2, "max_depth": 6, "min_samples_leaf": 9, "bootstrap_rows": False, "max_features": "all"}]
    single = [forest.fit_forest(train[t], ["a", "b"], "y", "k", **p) for t in (0, 1) for p in params]
    for waves in (2000, 6):
        monkeypatch.setattr(forest, "WAVE_TREES", waves)
        together = forest.fit_forests([(t, ["a", "b"]) for t in train], "y", "k", [(t, p) for t in (0, 1) for p in params])
        for a, b in zip(single, together):
            same(a, b)


def test_levels_are_shared(spark, rows, monkeypatch):
    """Jobs that grow: one a level, whatever the number of candidates and folds."""
    levels = []
    kernel = forest._level_kernel
    monkeypatch.setattr(forest, "_level_kernel", lambda shared, depth: levels.append(depth) or kernel(shared, depth))
    d = splits.stratified_kfold(rows, "y", 3, "k", 42)
    grid = {"n_trees": [2, 4], "max_depth": [3, 4], "vote": ["soft", "hard"]}
    cv, best, fitted = search.grid_search(d, "fold", "random_forest", ["a", "b"], "y", "k", grid, "classification", refit=False)
    assert levels == [0, 1, 2, 3]
    got = {(r.candidate_id, r.fold, r.metric): r.value for r in cv.collect()}
    cands = search.expand_grid(grid)
    for i in (0, 5):  # as by single fits, one fold after the other
        for k in range(3):
            f = models.fit_model(d.filter(F.col("fold") != k), "random_forest", ["a", "b"], "y", "k", cands[i])
            p = models.predict_model(d.filter(F.col("fold") == k), f)
            assert got[i, k, "accuracy"] == pytest.approx(p.filter("prediction = y").count() / p.count(), abs=1e-12)
    assert {r.candidate_id: r.params for r in cv.collect()} == {i: {k: str(v) for k, v in c.items()} for i, c in enumerate(cands)}


@pytest.mark.parametrize("grid", [None, {"n_trees": [3], "max_depth": [2, 3]}])
def test_experiment_with_indicators(spark, rows, grid, tmp_path):
    bundle, cv = experiments.run_experiment(rows, "random_forest", ["a", "c"], "y", "k", {"n_trees": 3, "max_depth": 3}, grid=grid, k=3,
                                            prep={"encoder": "one_hot", "scaler": "min_max"})
    assert bundle.fitted.features == ["a", "c_Unknown", "c_a", "c_b", "c_c"]
    p = experiments.predict(rows, bundle)
    assert p.count() == 400 and p.filter("prediction NOT IN (0, 1)").count() == 0
    assert {r.metric for r in experiments.score(rows, bundle).collect()} >= {"accuracy", "f1", "log_loss"}
    experiments.save_bundle(bundle, str(tmp_path / "bundle"), spark)
    again = experiments.predict(rows, experiments.load_bundle(spark, str(tmp_path / "bundle")))
    assert {r.k: r.prediction for r in p.collect()} == {r.k: r.prediction for r in again.collect()}
    assert (cv is None) == (grid is None)


def test_cut_points_by_one_rule(spark, monkeypatch):
    """Few values: all midpoints; many: an even choice among neighbours; the same for any partitions."""
    assert forest.cut_points(np.array([1.0, 2.0, 4.0])).tolist() == [1.5, 3.0]
    assert forest.cut_points(np.array([1.0])).tolist() == [] and len(forest.cut_points(np.arange(1000.0), 64)) == 64
    df = spark.range(5000).select((F.col("id") % 3).cast("double").alias("few"), (F.col("id") * 1.5).alias("many"),
                                  F.when(F.col("id") > 4990, F.lit(None)).when(F.col("id") > 10, F.lit(float("nan"))).otherwise(-F.col("id") * 0.0).alias("zero"))
    monkeypatch.setattr(forest, "SAMPLED_VALUES", 300)
    one, many = (forest.sample_values(df.repartition(n), ["few", "many", "zero"]) for n in (1, 13))
    assert all(np.array_equal(one[c], many[c]) for c in one)
    assert one["few"].tolist() == [0.0, 1.0, 2.0] and len(one["many"]) == 300 and one["zero"].tolist() == [0.0]
    cuts = forest.fit_bins(df, ["few", "many", "zero"], 16)
    assert cuts["few"].tolist() == [0.5, 1.5] and len(cuts["many"]) == 16 and not len(cuts["zero"])
