"""Nulls, NaN, fractional labels and missing classes, each against plain code."""
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import metrics, pipeline, scoring, svr
from quarry.operators.relief import relief_weights

NAN = float("nan")


def test_anova_leaves_out_what_is_missing(spark):
    rng = np.random.default_rng(0)
    rows = [(i, "abc"[i % 3] if i % 10 else None, float(rng.normal() + i % 3), float(i % 7)) for i in range(300)]
    rows = [(i, c, None if i % 3 == 1 and i % 2 else NAN if i % 13 == 0 else a, b) for i, c, a, b in rows]
    df = spark.createDataFrame(rows, "id long, y string, a double, b double")
    got = {r.feature: r.raw for r in scoring.score_f_classif(df, "y", ["a", "b"]).collect()}
    for k, name in ((2, "a"), (3, "b")):
        groups = {}
        for r in rows:
            if r[1] and r[k] is not None and not math.isnan(r[k]):
                groups.setdefault(r[1], []).append(r[k])
        x = [np.array(g) for g in groups.values()]
        n, grand = sum(map(len, x)), np.concatenate(x).mean()
        f = (sum(len(g) * (g.mean() - grand) ** 2 for g in x) / (len(x) - 1)) / (sum(((g - g.mean()) ** 2).sum() for g in x) / (n - len(x)))
        assert got[name] == pytest.approx(f, rel=1e-9)


def test_nan_counts_as_missing_in_scores(spark):
    df = spark.createDataFrame([(1.0, "a", 3.0), (NAN, "b", 1.0), (2.0, "b", NAN), (None, "a", 2.0)], "x double, y string, z double")
    assert scoring.score_mi_classif(df, "y", ["x"]).first().raw == pytest.approx(math.log(2))
    binned = scoring.discretize(df, ["x"], 2).collect()
    assert [r.x for r in binned] == [0, None, 1, None]
    clean = spark.createDataFrame([(float(i), float(i * i), "ab"[i % 2]) for i in range(10)], "x double, z double, y string")
    holes = clean.unionByName(spark.createDataFrame([(NAN, 4.0, "a"), (4.0, NAN, "b"), (None, 1.0, "a")], clean.schema))
    both = holes.filter("NOT isnan(x) AND NOT isnan(z) AND x IS NOT NULL")
    for f in (scoring.score_correlation, scoring.score_f_regression):
        assert f(holes, "z", ["x"]).first().raw == pytest.approx(f(both, "z", ["x"]).first().raw)
    for f in (scoring.score_chi2, scoring.chi2_contingency, scoring.score_mi_classif, scoring.score_f_classif):
        assert f(holes, "y", ["z"]).first().raw == pytest.approx(f(holes.filter("NOT isnan(z)"), "y", ["z"]).first().raw)


def test_fractional_labels_stay_apart(spark):
    df = spark.createDataFrame([(1.2, 1.9), (1.9, 1.2), (2.0, 2.0), (1.2, 1.2)], "t double, p double")
    counts = {r["class"]: (r.tp, r.fp, r.fn, r.support) for r in metrics.confusion_counts(df, "t", "p").collect()}
    assert counts == {1.2: (1, 1, 1, 2), 1.9: (0, 1, 1, 1), 2.0: (1, 0, 0, 1)}
    assert metrics.classification_report(df, "t", "p", average="micro").first().accuracy == metrics.accuracy_score(df, "t", "p").first().value == 0.5
    mixed = spark.createDataFrame([(1, 1.0), (0, 0.0), (1, 0.0)], "t int, p double")
    assert {r["class"]: r.tp for r in metrics.confusion_counts(mixed, "t", "p").collect()} == {0: 1, 1: 1}


def test_places_follow_the_models_classes(spark):
    """Class 1 has no row: its place in the arrays must still count."""
    rows = [(0, [0.7, 0.2, 0.1]), (2, [0.1, 0.3, 0.6]), (2, [0.2, 0.5, 0.3]), (0, [0.4, 0.1, 0.5])]
    df = spark.createDataFrame(rows, "y int, p array<double>").withColumn("pred", F.lit(0))
    want = -np.mean([math.log(p[y]) for y, p in rows])
    for classes in ([0, 1, 2], [2, 0, 1]):
        assert metrics.log_loss(df, "y", "p", classes=classes).first().value == pytest.approx(want)

    def auc(c):
        pos, neg = [p[c] for y, p in rows if y == c], [p[c] for y, p in rows if y != c]
        return np.mean([1.0 if a > b else 0.5 if a == b else 0.0 for a in pos for b in neg])

    assert metrics.roc_auc_ovr(df, "y", "p", classes=[0, 1, 2]).first().value == pytest.approx((auc(0) + auc(2)) / 2)
    table = {r.metric: r.value for r in metrics.score_table(df, "classification", "y", "pred", "p", classes=[0, 1, 2]).collect()}
    assert table["log_loss"] == pytest.approx(want) and table["roc_auc"] == pytest.approx((auc(0) + auc(2)) / 2) and "f1_macro" in table


def test_svr_leaves_out_missing_rows(spark):
    rows = [(float(i % 9), float(i % 5), 2.0 * (i % 9) - (i % 5)) for i in range(200)]
    df = spark.createDataFrame(rows, "a double, b double, y double")
    holes = df.unionByName(spark.createDataFrame([(None, 1.0, 1.0), (1.0, NAN, 1.0), (1.0, 1.0, None)], df.schema))
    for kernel in ("auto", "rbf"):
        whole, found = (svr.fit_svr(d, ["a", "b"], "y", kernel=kernel, n_landmarks=20) for d in (df, holes))
        assert found.kernel == ("linear" if kernel == "auto" else "rbf")
        assert np.allclose(whole.w, found.w, atol=1e-6) and whole.b == pytest.approx(found.b, abs=1e-6)
        p = svr.predict_svr(holes, found)
        assert p.filter("prediction IS NULL").count() == 2 and p.filter("isnan(prediction)").count() == 0
    with pytest.raises(svr.SVRError):
        svr.fit_svr(holes.filter("a IS NULL"), ["a", "b"], "y")


def test_contour_levels(spark):
    grid = spark.range(25).select((F.col("id") / 5).cast("int").alias("i"), (F.col("id") % 5).alias("j")).withColumn("prediction", F.col("i") * 1.0)
    got = svr.contour_levels(grid, 3).collect()
    assert {(r.level_id, r.level) for r in got} == {(1, 1.0), (2, 2.0), (3, 3.0)}
    assert {(r.i, r.j) for r in got if r.level_id == 2} == {(1, j) for j in range(4)}
    assert svr.contour_levels(grid.withColumn("prediction", F.lit(1.0))).count() == 0


def test_relief_leaves_out_missing_rows(spark):
    rows = [(i, i % 2, float(i % 7), float(i * 3 % 11)) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, y int, a double, b double")
    holes = df.unionByName(spark.createDataFrame([(100, None, 1.0, 1.0), (101, 1, None, 1.0), (102, 0, 1.0, NAN)], df.schema))
    value = lambda d: {r.feature: r.weight for r in relief_weights(d, ["a", "b"], "y", "id", k=3).collect()}
    assert value(holes) == pytest.approx(value(df))


def test_types_are_decided_at_the_fit(spark):
    train = spark.createDataFrame([(1, 5, 1.0), (2, 300, 2.0)], "id long, n long, x double")
    test = spark.createDataFrame([(3, 7, 1.5)], train.schema)
    st = pipeline.fit_preprocessor(train, numeric=["x"], exclude=["id", "n"], narrow=True)
    kinds = [pipeline.apply_preprocessor(d, st).dtypes for d in (train, test)]
    assert kinds[0] == kinds[1] and dict(kinds[0])["n"] == "smallint"
