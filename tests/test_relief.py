import random

import numpy as np
import pytest

from quarry.operators.relief import relief_weights


def brute(X, y, k):
    """Weights with every row as an anchor, by all pairs; keys are the row numbers."""
    rg = X.max(axis=0) - X.min(axis=0)
    diff = np.abs(X[:, None, :] - X[None, :, :]) / np.where(rg == 0, np.inf, rg)
    dist = diff.sum(axis=2)
    n, w = len(X), np.zeros(X.shape[1])
    prior = {c: (y == c).mean() for c in set(y)}
    for a in range(n):
        for c, p in prior.items():
            near = sorted((dist[a, b], b) for b in range(n) if b != a and y[b] == c)[:k]
            for _, b in near:
                w += diff[a, b] / (n * k) * (-1 if c == y[a] else p / (1 - prior[y[a]]))
    return w


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    return [(i, i % 3, rng.random() + i % 3, rng.random(), round(rng.random(), 1), 5.0) for i in range(120)]


@pytest.mark.parametrize("batch", [50, 256])
def test_every_row_is_an_anchor(spark, rows, batch):
    df = spark.createDataFrame(rows, "id long, y int, a double, b double, c double, d double")
    want = brute(np.array([r[2:] for r in rows]), np.array([r[1] for r in rows]), 4)
    got = {r.feature: r.weight for r in relief_weights(df, list("abcd"), "y", "id", k=4, block_rows=batch).collect()}
    assert got == pytest.approx(dict(zip("abcd", want)), abs=1e-9)


def test_given_anchors_in_batches(spark, rows):
    df = spark.createDataFrame(rows, "id long, y int, a double, b double, c double, d double")
    one, many = ({r.feature: r.weight for r in relief_weights(df, list("abcd"), "y", "id", n_anchors=40, block_rows=b)
                  .collect()} for b in (256, 16))
    assert one == pytest.approx(many, abs=1e-9)


def _features(kind, rng, n, d):
    x = rng.normal(size=(n, d))
    return {"normal": x, "heavy": np.exp(4 * x), "offset": 1e9 + x / 1000, "rounded": np.round(x),
            "one wide": np.c_[x[:, 1:] / 1000 + (rng.random((n, d - 1)) > 0.99), x[:, 0] > 0]}[kind]


def _as_rows(x, keys, cls):
    from quarry.operators import relief
    return relief._Rows(x, keys, np.ones(len(x), bool), cls, np.arange(len(x)))


@pytest.mark.parametrize("kind", ["normal", "heavy", "offset", "rounded", "one wide"])
def test_bounds_stay_below_distances(kind):
    from quarry.operators import relief
    x = _features(kind, np.random.default_rng(4), 300, 9)
    rg = np.ptp(x, axis=0)
    grid = relief._Grid(x[:100], rg)
    q, off = grid(x)
    assert q.min() >= 0 and q.max() <= grid.LEVELS
    sums = np.abs(q[:, None].astype(int) - q[None]).sum(axis=2)
    dist = (np.abs(x[:, None] - x[None]) / rg).sum(axis=2)
    assert (sums <= grid.scale * dist + off[:, None] + off[None, :] + 1e-6).all()


@pytest.mark.parametrize("kind", ["normal", "heavy", "offset", "rounded", "one wide"])
def test_nearest_of_rows_in_batches(kind):
    from quarry.operators import relief
    rng = np.random.default_rng(5)
    x, cls, k = _features(kind, rng, 400, 9), rng.integers(0, 3, 400), 4
    rg, keys = np.ptp(x, axis=0), np.arange(400) // 2
    rows = _as_rows(x, keys, cls)
    search = relief._Nearest(rows[:90], rg, k, np.bincount(cls))
    for part in np.array_split(rng.permutation(400), 5):
        search.add(rows[part])
    i, c, dist, _, row = search.found()
    for a in range(90):
        exact = (np.abs(x[a] - x) / rg).sum(axis=1)
        for of in range(3):
            want = sorted((exact[b], keys[b], b) for b in np.flatnonzero((cls == of) & (keys != keys[a])))[:k]
            assert dist[(i == a) & (c == of)] == pytest.approx([w[0] for w in want])
            if kind != "rounded":   # sums of other orders may part equal distances
                assert list(row[(i == a) & (c == of)]) == [w[2] for w in want]


@pytest.mark.parametrize("flag, share", [(False, 25), (True, 10)])
def test_few_distances_are_computed(monkeypatch, flag, share):
    from quarry.operators import relief
    rng, done = np.random.default_rng(6), []
    whole = relief._Nearest._distances
    monkeypatch.setattr(relief._Nearest, "_distances", lambda self, i, j, rows: done.append(len(i)) or whole(self, i, j, rows))
    x, cls = rng.normal(size=(20_000, 24)), rng.integers(0, 2, 20_000)
    if flag:   # all but one feature have a small part of their range
        x = np.c_[x[:, 1:] / 100 + (rng.random((20_000, 23)) > 0.9999), x[:, 0] > 0]
    rows = _as_rows(x, np.arange(20_000), cls)
    search = relief._Nearest(rows[:200], np.ptp(x, axis=0), 5, np.bincount(cls))
    for at in range(0, 20_000, 4000):
        search.add(rows[at:at + 4000])
    assert len(search.found()[0]) == 200 * 2 * 5
    assert sum(done) < 200 * 20_000 / share


def test_anchors_of_one_key_share_their_neighbours(spark):
    rng = np.random.default_rng(7)
    x, y, keys = rng.normal(size=(90, 3)), [int(v) for v in rng.integers(0, 2, 90)], [i // 2 for i in range(90)]
    df = spark.createDataFrame([(keys[i], y[i], *map(float, x[i])) for i in range(90)], "id long, y int, a double, b double, c double")
    rg = np.ptp(x, axis=0)
    diff = np.abs(x[:, None] - x[None]) / rg
    dist, prior, want = diff.sum(axis=2), np.bincount(y) / 90, np.zeros(3)
    for name in set(keys):
        for c in (0, 1):
            pairs = sorted((dist[a, b], keys[b], a, b) for a in range(90) if keys[a] == name for b in range(90) if keys[b] != name and y[b] == c)[:3]
            for _, _, a, b in pairs:
                want += diff[a, b] / (90 * 3) * (-1 if c == y[a] else prior[c] / (1 - prior[y[a]]))
    for named in (df, df.withColumn("id", df.id.cast("string"))):
        got = {r.feature: r.weight for r in relief_weights(named, list("abc"), "y", "id", k=3, block_rows=16).collect()}
        assert got == pytest.approx(dict(zip("abc", want)), abs=1e-9)


def test_neighbours_are_summed_where_they_are_found(spark, rows):
    """All rows pass by the blocks; neither neighbours nor their features are shuffled to be ranked or joined."""
    df = spark.createDataFrame(rows, "id long, y int, a double, b double, c double, d double")
    seen, plans = type(df).mapInArrow, []
    type(df).mapInArrow = lambda self, *a, **kw: plans.append(self._jdf.queryExecution().executedPlan().toString()) or seen(self, *a, **kw)
    try:
        relief_weights(df, list("abcd"), "y", "id", k=4).collect()
    finally:
        type(df).mapInArrow = seen
    assert plans and not any(word in p for p in plans for word in ("Window", "Join", "CoGroup"))
