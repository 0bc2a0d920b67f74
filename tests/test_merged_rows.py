"""Forests from merged binned rows against forests from all of them."""
import numpy as np

from quarry.operators import forest


def _df(spark, n=3000):
    rng = np.random.default_rng(9)
    a, b, c = rng.integers(0, 6, n), rng.integers(0, 4, n), rng.integers(0, 3, n)
    y = ((a > 2) & (b > 0) | (rng.random(n) < 0.1)).astype(int)
    return spark.createDataFrame([(i // 3 if i % 50 else None, None if a[i] == 5 else float(a[i]), float(b[i]), float(c[i]), int(y[i]))
                                  for i in range(n)], "id long, a double, b double, c double, y int")


def test_same_forest(spark, monkeypatch):
    df, merged = _df(spark), []
    whole = forest._merged
    monkeypatch.setattr(forest, "_merged", lambda *a: merged.append(whole(*a)) or merged[-1])
    kw = dict(n_trees=6, max_depth=5, seed=3)
    got = forest.fit_forest(df, ["a", "b", "c"], "y", "id", **kw)
    assert merged and merged[0].count() <= 6 * 4 * 3 * 2  # a level reads these rows, not all 3000
    monkeypatch.setattr(forest, "MERGED_ROWS", 1 << 40)
    want = forest.fit_forest(df, ["a", "b", "c"], "y", "id", **kw)
    assert len(merged) == 1
    for x, z in zip(got.trees, want.trees):
        assert all(np.array_equal(x[k], z[k], equal_nan=k == "thr") for k in x)


def test_rows_handed_on_before_all_are_merged(spark, monkeypatch):
    df, kw = _df(spark), dict(n_trees=3, max_depth=4)
    want = forest.fit_forest(df, ["a", "b", "c"], "y", "id", **kw)
    monkeypatch.setattr(forest, "MERGED_AT_ONCE", 20)
    got = forest.fit_forest(df, ["a", "b", "c"], "y", "id", **kw)
    for x, z in zip(got.trees, want.trees):
        assert all(np.array_equal(x[k], z[k], equal_nan=k == "thr") for k in x)
