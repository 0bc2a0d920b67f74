"""Answers that must not hang on the number of buckets, on nulls or on the session's settings."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.functions import special
from quarry.operators import cleaning, encoding, explain, forest, metrics, pipeline, scaling, scoring, splits, svr
from quarry.operators import stattests as G
from quarry.plans.quantiles import group_quantiles
from quarry.plans.ranks import row_number_global


@pytest.fixture(scope="module")
def mixed(spark):
    rng = random.Random(1)
    rows = [(i, None if i % 4 == 0 else "ab"[i % 2], None if i % 10 == 0 else round(rng.random(), 1)) for i in range(1000)]
    return spark.createDataFrame(rows, "k int, label string, score double").cache()


@pytest.mark.parametrize("ascending", [True, False])
def test_positions_with_nulls(mixed, ascending):
    got = [{r["k"]: r["rn"] for r in row_number_global(mixed, [("score", ascending), "k"], ["label"], n_buckets=b).collect()}
           for b in (1, 7)]
    key = lambda r: ((r["score"] is not None) if ascending else (r["score"] is None), (r["score"] or 0) * (1 if ascending else -1), r["k"])
    want = {}
    for label in (None, "a", "b"):
        for i, r in enumerate(sorted((r for r in mixed.collect() if r["label"] == label), key=key)):
            want[r["k"]] = i
    assert got[0] == got[1] == want


def test_folds_keep_null_labels(mixed):
    folds = [{r["k"]: r["fold"] for r in splits.stratified_kfold(mixed, "label", 4, "k", 3, n_buckets=b).collect()} for b in (1, 7)]
    assert folds[0] == folds[1] and len(folds[0]) == 1000
    filled = [{r["k"]: r["score"] for r in cleaning.interpolate(mixed, ["score"], ["k"], ["label"], n_buckets=b).collect()} for b in (1, 7)]
    assert filled[0] == filled[1] and len(filled[0]) == 1000 and None not in filled[0].values()


def test_quantiles_and_null_groups(mixed):
    rows = {r["label"]: r["quantiles"] for r in group_quantiles(mixed, "score", ["label"], [0, 0.3, 0.5, 1]).collect()}
    for label, got in rows.items():
        v = [r["score"] for r in mixed.collect() if r["label"] == label and r["score"] is not None]
        assert np.allclose(got, np.quantile(v, [0, 0.3, 0.5, 1]))
    assert set(rows) == {None, "a", "b"}
    assert {r["label"] for r in G.describe_groups(mixed, "score", "label").collect()} == {None, "a", "b"}
    assert {r["label"] for r in G.analyze_groups(mixed, "score", "label").collect()} == {None, "a", "b"}


def test_shapiro_reads_all_rows(spark):
    rng = np.random.default_rng(3)
    x = np.sort(np.r_[rng.normal(size=4000), np.zeros(3000)])
    df = spark.createDataFrame([(float(v),) for v in rng.permutation(x)], "v double")
    r = G.shapiro(df, "v").first()
    n = len(x)
    m = special.norm_ppf_array((np.arange(n) + 0.625) / (n + 0.25))
    u, q = n ** -0.5, m @ m
    an, an1 = m[-1] / q ** 0.5 + G._poly(G._SW_C1, u), m[-2] / q ** 0.5 + G._poly(G._SW_C2, u)
    a = m / math.sqrt((q - 2 * m[-1] ** 2 - 2 * m[-2] ** 2) / (1 - 2 * an ** 2 - 2 * an1 ** 2))
    a[-1], a[0], a[-2], a[1] = an, -an, an1, -an1
    assert r["n"] == n and r["p_value"] is None
    assert abs(r["statistic"] - (a @ x) ** 2 / ((x - x.mean()) ** 2).sum()) < 1e-9
    assert np.allclose(special.norm_ppf_array([0.001, 0.3, 0.5, 0.99]), [special.norm_ppf(p) for p in (0.001, 0.3, 0.5, 0.99)])


def test_pairs_of_columns_with_nulls(spark):
    rows = [(float(i) if i % 3 else None, 2.0 * i if i % 5 else None, float(i % 7)) for i in range(200)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    corr = {(r["x"], r["y"]): r["corr"] for r in scoring.correlation_matrix(df, ["a", "b"]).collect()}
    assert abs(corr["a", "b"] - 1) < 1e-12
    score = {r["feature"]: r["raw"] for r in scoring.score_correlation(df, "b", ["a"]).collect()}
    assert abs(score["a"] - 1) < 1e-12


def test_wilcoxon_and_t_at_the_ends(spark):
    big = spark.range(2_300_000).select(F.lit(2.0).alias("a"), F.lit(1.0).alias("b"))
    assert G.wilcoxon(big, "a", "b", with_p=False).first()["statistic"] == 0
    one = spark.createDataFrame([(2.0, 1.0)], "a double, b double")
    assert G.paired_ttest(one, "a", "b", with_p=False).first()["statistic"] is None
    lone = spark.createDataFrame([(1, "x", 1.0), (1, "y", 2.0), (2, "x", 3.0)], "k int, v string, z double")
    with pytest.raises(Exception, match="lacks one of the variants"):
        G.compare_variants(lone, "k", "v", "z", "x", "y").collect()
    assert G.compare_variants(lone, "k", "v", "z", "x", "y", unpaired="drop").first()["n"] == 1


def test_missing_features_go_one_way(spark):
    rows = [(i, None if i < 100 else float(i), 1 if i < 100 else 0) for i in range(300)]
    df = spark.createDataFrame(rows, "k int, x double, y int")
    m = forest.fit_forest(df, ["x"], "y", "k", n_trees=1, max_depth=2, bootstrap_rows=False, max_features=1)
    hit = forest.predict_forest(df, m).filter("x is null").select(F.avg("prediction")).first()[0]
    assert hit == 1.0


def test_kernel_median(spark):
    rng = np.random.default_rng(5)
    x, marks = rng.normal(size=(300, 2)), rng.normal(size=(7, 2))
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double")
    m = svr.SVRModel(["a", "b"], "rbf", 0.5, 0.0, 3, 1.0, 0.1, marks, np.eye(7), np.zeros(7), 0.0, [])
    K = svr.kernel_matrix(x, marks, "rbf", 0.5, 0.0, 3)
    for parts in (1, 5):
        r = svr.kernel_stats(df.repartition(parts), m).first()
        assert r["median"] == pytest.approx(np.median(K), abs=0) or abs(r["median"] - np.median(K)) < 1e-15
        assert abs(r["std"] - K.std()) < 1e-9


def _product(z):
    return z[:, 0] * z[:, 1] * (z[:, 2] - 0.5)


def test_interactions_average_before_the_modulus(spark):
    df = spark.createDataFrame([(1.0, 1.0, 1.0)] * 3, "a double, b double, c double")
    r = {(x["feature_a"], x["feature_b"]): x["strength"]
         for x in explain.shap_interactions(df, _product, ["a", "b", "c"], np.zeros((1, 3)), n_permutations=2).collect()}
    assert r["a", "b"] == pytest.approx(0, abs=1e-12) and max(r.values()) == 1


def test_power_beyond_the_first_bracket(spark):
    df = spark.createDataFrame([(float(-(1 + i) ** -3.0),) for i in range(400)], "x double")
    lam = scaling.fit_scaler(df, ["x"], "power").lam["x"]
    x = np.array([r[0] for r in df.collect()])

    def likelihood(l):
        y = scaling._yj_np(x, l)
        return -len(x) / 2 * np.log(y.var()) + (l - 1) * (np.sign(x) * np.log1p(np.abs(x))).sum()
    assert likelihood(lam) >= max(likelihood(l) for l in np.linspace(-8, 8, 81)) - 1e-3


def test_state_without_arrow(spark, tmp_path):
    df = spark.createDataFrame([(float(i), "ab"[i % 2]) for i in range(20)], "x double, c string")
    before = spark.conf.get("spark.sql.execution.arrow.pyspark.enabled")
    spark.conf.set("spark.sql.execution.arrow.pyspark.enabled", "false")
    try:
        for scaler in ("robust", "quantile", "power"):
            st = pipeline.fit_preprocessor(df, numeric=["x"], categorical=["c"], scaler=scaler, encoder="label")
            pipeline.save_preprocessor(st, str(tmp_path / scaler), spark)
            again = pipeline.load_preprocessor(spark, str(tmp_path / scaler))
            a, b = (pipeline.apply_preprocessor(df, s).collect() for s in (st, again))
            assert a == b
    finally:
        spark.conf.set("spark.sql.execution.arrow.pyspark.enabled", before)


@pytest.mark.parametrize("method,rows", [
    ("one_hot", ["u", "v", "w", "u", None]), ("binarize", ["u", "v", "u", None]), ("multi_label", [["u", "v"], [], ["w"]])])
def test_indicators_back_to_categories(spark, method, rows):
    kind = "array<string>" if method == "multi_label" else "string"
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"k int, c {kind}")
    st = encoding.fit_encoder(df, ["c"], method)
    back = {r["k"]: r["c"] for r in encoding.inverse_transform(encoding.transform(df, st), st).collect()}
    assert [back[i] for i in range(len(rows))] == rows


def test_null_scores_in_curves(spark):
    rows = [(1 if i % 3 == 0 else 0, None if i % 7 == 0 else round((i * 37 % 100) / 100, 2)) for i in range(500)]
    df = spark.createDataFrame(rows, "y int, s double")
    assert metrics.roc_auc_score(df, "y", "s", n_buckets=1).first()["value"] == pytest.approx(
        metrics.roc_auc_score(df, "y", "s", n_buckets=6).first()["value"])


def test_classes_of_any_type(spark):
    names = {0: "none", 1: "mild", 2: "severe"}
    rows = [(float(i % 7), i % 3, (i * 5) % 3 if i % 4 else i % 3) for i in range(400)]
    df = spark.createDataFrame(rows, "x double, y int, p int")
    named = spark.createDataFrame([(x, names[y], names[p]) for x, y, p in rows], "x double, y string, p string")
    for average in ("macro", "weighted", "micro"):
        a, b = (metrics.classification_report(d, "y", "p", average=average).first() for d in (df, named))
        assert a["f1"] == pytest.approx(b["f1"]) and a["accuracy"] == b["accuracy"]
    for score in (scoring.score_chi2, scoring.chi2_contingency, scoring.score_mi_classif):
        a, b = (score(d, "y", ["x"]).first()["raw"] for d in (df, named))
        assert a == pytest.approx(b)
    assert metrics.class_list(named, "y") == ["mild", "none", "severe"]


def test_preprocessing_inside_folds(spark):
    from quarry.operators import search
    rows = [(i, float(i % 11) if i % 5 else None, "abc"[i % 3], i // 3 % 3, float(i % 3)) for i in range(240)]
    df = spark.createDataFrame(rows, "k int, x double, c string, fold int, y double")
    for prep in ({"encoder": "one_hot"}, {"encoder": "label", "order_by": ["k"]}):
        cv, best, model = search.grid_search(df, "fold", "svr", ["x", "c"], "y", "k", {"C": [1.0]}, "regression",
                                             refit_metric="mean_absolute_error",
                                             prep={"scaler": "standard", "order_by": ["k"], **prep})
        assert cv.select("fold").distinct().count() == 3
        from quarry.operators import models
        assert models.predict_model(df, model).count() == 240


def test_predictions_run_once(spark):
    calls = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            calls.add(len(b))
            yield b
    df = spark.createDataFrame([(i % 2, (i // 2) % 2, (i % 7) / 7) for i in range(100)], "y int, p int, s double")
    out = metrics.score_table(df.mapInPandas(counted, df.schema), "classification", "y", "p", "s").collect()
    assert calls.value == 100 and len(out) == 8


def test_neighbours_of_equal_distance(spark):
    from quarry.operators import neighbors
    df = spark.createDataFrame([(i, [float(i % 2), 0.0]) for i in range(60)], "id long, v array<double>")
    got = [{(r["id"], r["rank"]): r["nbr"] for r in neighbors.knn_graph(df, "id", "v", 4, n_blocks=b).collect()} for b in (1, 2, 5)]
    assert got[0] == got[1] == got[2] and [got[0][7, r] for r in (1, 2, 3, 4)] == [1, 3, 5, 9]
