import random

import numpy as np
import pytest

from quarry.operators import neighbors


def brute(rows, k):
    """Neighbours of each id by all pairs: (nbr, rounded distance) by distance, then id."""
    ids = [i for i, _ in rows]
    x = np.array([v for _, v in rows], dtype=float)
    out = {}
    for a, i in enumerate(ids):
        d = np.sqrt(((x - x[a]) ** 2).sum(axis=1))
        out[i] = [(ids[b], round(float(d[b]), 9)) for b in sorted((b for b in range(len(ids)) if b != a), key=lambda b: (d[b], ids[b]))[:k]]
    return out


def graph(df, k, **kw):
    got = {}
    for r in neighbors.knn_graph(df, "id", "v", k, **kw).orderBy("id", "rank").collect():
        got.setdefault(r.id, []).append((r.nbr, round(r.dist, 9)))
        assert r["rank"] == len(got[r.id])
    return got


def test_lists_with_all_probes_are_exact(spark):
    """Repeated vectors, ties and small tasks; every list is probed, so nothing may be missed."""
    rng = random.Random(3)
    rows = [(i, [rng.randint(0, 3) * 1.0, rng.randint(0, 3) * 1.0, rng.random()]) for i in range(150)]
    rows += [(1000 + i, [1.0, 2.0, 0.5]) for i in range(60)]  # one hot vector
    df = spark.createDataFrame(rows, "id long, v array<double>").repartition(3)
    want = brute(rows, 4)
    assert graph(df, 4, method="exact", block_rows=64) == want
    assert graph(df, 4, probes=10_000) == want


def test_lists_in_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(neighbors, "QUERY_ROWS", 7)
    monkeypatch.setattr(neighbors, "LIST_ROWS", 5)
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(90, 4)))]
    assert graph(spark.createDataFrame(rows, "id long, v array<double>"), 3, probes=10_000) == brute(rows, 3)


def test_missing_and_empty(spark):
    rows = [(1, [0.0, 0.0]), (2, [0.0, 1.0]), (3, None), (4, [None, 1.0]), (None, [0.0, 0.0]), (5, [float("nan"), 0.0])]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    for method in ("lists", "exact"):
        assert graph(df, 3, method=method) == {1: [(2, 1.0)], 2: [(1, 1.0)]}
        assert graph(df.filter("id = 3"), 3, method=method) == {}
    with pytest.raises(ValueError):
        neighbors.knn_graph(df, "id", "v", 3, method="guess")


def test_recall_on_the_given_vectors(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").selectExpr("vec_id AS id", "embedding AS v")
    exact, lists = graph(df, 10, method="exact"), graph(df, 10)
    found = sum(len({n for n, _ in exact[i]} & {n for n, _ in lists[i]}) for i in exact)
    recall = found / sum(map(len, exact.values()))
    print(f"recall {recall:.4f}")
    assert recall >= 0.9
    few = graph(df, 10, recall=0.3)
    assert recall > sum(len({n for n, _ in exact[i]} & {n for n, _ in few[i]}) for i in exact) / sum(map(len, exact.values())) >= 0.2


def test_rows_shipped_grow_nearly_linearly(spark):
    """Each vector is a candidate of one list and a query of ``probes`` lists, whatever n is."""
    rng = np.random.default_rng(2)
    sent = {}
    for n in (1000, 4000):
        rows = [(i, [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(n, 8)))]
        df = spark.createDataFrame(rows, "id long, v array<double>").repartition(4)
        seen = spark.sparkContext.accumulator(0)
        whole = neighbors._nearest_pairs

        def counted(qi, qv, ci, cv, k, seen=seen):
            seen.add(len(qi))
            return whole(qi, qv, ci, cv, k)

        neighbors._nearest_pairs = counted
        try:
            assert neighbors.knn_graph(df, "id", "v", 3, probes=4).count() == 3 * n
        finally:
            neighbors._nearest_pairs = whole
        sent[n] = seen.value
    assert sent[4000] <= 4.4 * sent[1000]
