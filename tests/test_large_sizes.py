"""Sizes that only large tables reach: their sums and counts, from small rows."""
from pyspark.sql import functions as F

from quarry.operators import scoring, svr


def _counted(spark, counts):
    return spark.createDataFrame([("x", b, c, n) for (b, c), n in counts.items()], "feature string, bin int, cls int, cnt long")


def test_contingency_of_many_rows(spark, monkeypatch):
    counts = {(0, 0): 40_000_000, (0, 1): 10_000_000, (1, 0): 20_000_000, (1, 1): 30_000_000}
    monkeypatch.setattr(scoring, "_binned_counts", lambda *a: _counted(spark, counts))
    df = spark.createDataFrame([(1.0, 0)], "x double, cls int")
    raw = scoring.chi2_contingency(df, "cls", ["x"]).first()["raw"]
    n, rb, cc = 100_000_000, (50_000_000, 50_000_000), (60_000_000, 40_000_000)
    want = sum((o - rb[b] * cc[c] / n) ** 2 / (rb[b] * cc[c] / n) for (b, c), o in counts.items())
    assert abs(raw - want) < 1e-6 * want


def test_mutual_information_of_many_rows(spark):
    big = 2_000_000_000
    raw = scoring._mi(_counted(spark, {(0, 0): big, (1, 1): big})).first()["raw"]
    assert abs(raw - 0.6931471805599453) < 1e-12


def test_no_support_rows(spark):
    p = spark.createDataFrame([(1, 2.0, 0.5)], "id int, prediction double, excess double")
    got = svr.stratified_top(p.filter("id > 1"), "prediction", "excess", 5, 10, ["id"])
    assert got.count() == 0 and "bin" in got.columns


def test_neighbour_shuffles_stay_narrow(spark):
    """Floats aren't widened for the shuffles, and differences of features don't leave a block."""
    import numpy as np
    from quarry.operators import neighbors, relief
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.random(4).astype(np.float32)], int(i % 3)) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, v array<float>, y int")
    x, ids = np.array([r[1] for r in rows]), np.arange(300)
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    np.fill_diagonal(d, np.inf)
    want = {(i, k + 1): j for i in range(300) for k, j in enumerate(np.lexsort((ids, d[i]))[:3])}
    for kw in ({"method": "exact"}, {"method": "exact", "n_blocks": 3}, {"probes": 1000}):
        g = neighbors.knn_graph(df, "id", "v", 3, **kw)
        assert "array<double>" not in g._jdf.queryExecution().optimizedPlan().toString()
        assert {(r["id"], r["rank"]): r["nbr"] for r in g.collect()} == want
    kernel = relief._block_kernel(np.ones(4), 2)
    import pandas as pd
    block = pd.DataFrame({"key": ids, "cls": ids % 3, "x": list(x), "row": ids})
    assert not {"diff", "x"} & set(kernel(block, block).columns)
