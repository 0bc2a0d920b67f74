import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import stattests as G

# Fold scores printed in the reference report (SVR cross-validation RMSE).
FOLDS = [5.035965, 4.370107, 4.460083, 4.646090, 2.912629]


@pytest.fixture(scope="module")
def folds(spark):
    return spark.createDataFrame([(i, v) for i, v in enumerate(FOLDS)], "fold int, value double")


def test_golden_describe_and_ci(folds):
    d = G.describe_groups(folds, "value").first()
    assert abs(d["mean"] - 4.284975) < 1e-6
    assert abs(d["std"] - 0.808646) < 1e-6
    assert abs(d["std_error"] - 0.361637) < 1e-6
    assert abs(d["median"] - 4.460083) < 1e-6
    assert abs(d["q1"] - 4.370107) < 1e-6 and abs(d["q3"] - 4.646090) < 1e-6
    assert abs(d["iqr"] - 0.275983) < 1e-6
    assert abs(d["coefficient_of_variation"] - 18.871666) < 1e-5
    ci = G.confidence_interval(folds, "value").first()
    assert abs(ci["lower"] - 3.280908) < 1e-6 and abs(ci["upper"] - 5.289042) < 1e-6
    assert abs(ci["margin_of_error"] - 1.004066) < 1e-6


def test_golden_shapiro(folds):
    r = G.shapiro(folds, "value").first()
    assert abs(r["statistic"] - 0.835010) < 1e-6
    assert abs(r["p_value"] - 0.151595) < 1e-6


def test_shapiro_edge_cases(spark):
    rows = [("same", 1.0)] * 4 + [("two", 1.0), ("two", 2.0)] + [("three", v) for v in (1.0, 2.0, 4.0)] + [(None, v) for v in (3.0, 1.0, 2.5)]
    got = {r["g"]: r for r in G.shapiro(spark.createDataFrame(rows, "g string, v double"), "v", "g").collect()}
    assert (got["same"]["statistic"], got["same"]["p_value"]) == (1.0, 1.0)
    assert got["two"]["statistic"] is None and got["two"]["p_value"] is None
    assert 0 < got["three"]["statistic"] <= 1 and 0 <= got["three"]["p_value"] <= 1 and got[None]["n"] == 3


def test_single_row_group_has_zero_std_and_width(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("b", 4.0)], "g string, v double")
    d = {r["g"]: r for r in G.describe_groups(df, "v", "g").collect()}
    assert d["a"]["std"] == 0.0 and d["a"]["coefficient_of_variation"] == 0.0
    ci = {r["g"]: r for r in G.confidence_interval(df, "v", "g").collect()}
    assert ci["a"]["lower"] == ci["a"]["upper"] == 1.0


def test_paired_tests(spark):
    a = [0.93, 0.92, 0.94, 0.91, 0.95, 0.90]
    b = [0.90, 0.91, 0.92, 0.92, 0.91, 0.88]
    df = spark.createDataFrame(list(zip(a, b)), "a double, b double")
    t = G.paired_ttest(df, "a", "b").first()
    d = np.array(a) - np.array(b)
    assert abs(t["statistic"] - d.mean() / (d.std(ddof=1) / math.sqrt(len(d)))) < 1e-9
    assert 0 < t["p_value"] < 1
    dz = G.cohens_dz(df, "a", "b").first()
    assert abs(dz["effect_size"] - d.mean() / d.std(ddof=1)) < 1e-9
    w = G.wilcoxon(df, "a", "b").first()
    assert w["statistic"] == min(w["w_plus"], w["w_minus"])


def test_zero_spread_and_all_zero_differences(spark):
    df = spark.createDataFrame([(1.0, 0.5)] * 6, "a double, b double")
    assert G.cohens_dz(df, "a", "b").first()["effect_size"] == math.inf
    same = spark.createDataFrame([(1.0, 1.0)] * 6, "a double, b double")
    assert G.cohens_dz(same, "a", "b").first()["effect_size"] == 0.0
    assert G.wilcoxon(same, "a", "b").first()["statistic"] is None


def test_wilcoxon_exact_p():
    assert G._wilcoxon_exact_p(10, 8) == pytest.approx(0.048828125)


def test_jarque_bera_normal(spark):
    rng = np.random.default_rng(0)
    df = spark.createDataFrame([(float(v),) for v in rng.normal(size=5000)], "v double")
    assert G.jarque_bera(df, "v").first()["p_value"] > 0.01


def test_compare_variants_rejects_duplicates(spark):
    df = spark.createDataFrame([(1, "x", 1.0), (1, "x", 2.0), (1, "y", 1.0)], "k int, var string, v double")
    with pytest.raises(Exception):
        G.compare_variants(df, "k", "var", "v", "x", "y").collect()
