import math

import pytest

from quarry.operators import metrics as M


def test_constant_target_r2(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0)], "y double, p double")
    r = M.regression_report(df, "y", "p").first()
    assert r["r2"] == -math.inf and r["explained_variance"] == -math.inf
    r = M.regression_report(df, "y", "p", force_finite=False).first()
    assert math.isnan(r["r2"])


def test_msle_gated_on_negative(spark):
    df = spark.createDataFrame([(-1.0, 1.0), (2.0, 2.0)], "y double, p double")
    assert M.regression_report(df, "y", "p").first()["mean_squared_log_error"] is None


def test_binary_on_multiclass_raises(spark):
    df = spark.createDataFrame([(0, 0), (1, 1), (2, 1)], "y int, p int")
    with pytest.raises(Exception):
        M.classification_report(df, "y", "p", average="binary").collect()


def test_auc_ties_and_missing_class(spark):
    df = spark.createDataFrame([(1, 0.5), (0, 0.5), (1, 0.9), (0, 0.1)], "y int, s double")
    assert M.roc_auc_score(df, "y", "s").first()["value"] == pytest.approx(0.875)
    only = spark.createDataFrame([(1, 0.5), (1, 0.9)], "y int, s double")
    assert M.roc_auc_score(only, "y", "s").first()["value"] == 0.0
    assert M.average_precision_score(df, "y", "s").first()["value"] == pytest.approx(0.5 * 1.0 + 0.5 * (2 / 3))


def test_micro_fbeta_definition(spark):
    df = spark.createDataFrame([(0, 0), (1, 2), (2, 2), (1, 1)], "y int, p int")
    r = M.classification_report(df, "y", "p", average="micro", beta=2.0).first()
    tp, fp, fn = 3, 1, 1
    assert r["fbeta"] == pytest.approx(5 * tp / (5 * tp + 4 * fn + fp))


def test_curve_buckets_do_not_change_auc(spark):
    rows = [(i % 2, (i * 37 % 101) / 101.0) for i in range(500)]
    df = spark.createDataFrame(rows, "y int, s double")
    a = M.roc_auc_score(df, "y", "s").first()["value"]
    b = M.roc_auc_score(df, "y", "s", n_buckets=7).first()["value"]
    assert a == pytest.approx(b, abs=1e-12)
