import numpy as np

from quarry.llm import embed_dup
from quarry.llm.queries import ORACLES, QUERIES
from tests.oracle_check import compare, duck


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.1"
    name = "op8_pq_near_vectors"
    msg, *_ = compare(spark, duck(sf), name, QUERIES[name], ORACLES[name], sf)
    assert not msg, msg


def brute(rows, cosine):
    of, links = {}, {}
    good = [(i, np.array(v, float), l) for i, v, l in rows if l is not None and v and all(
        x is not None and np.isfinite(x) for x in v) and any(v)]
    root = {i: i for i, *_ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, *_ in rows:
        links[i] = 0
    for x, (i, a, l) in enumerate(good):
        for j, b, m in good[:x]:
            if l == m and len(a) == len(b):
                a1, b1 = a / np.abs(a).max(), b / np.abs(b).max()
                if a1 @ b1 / np.linalg.norm(a1) / np.linalg.norm(b1) >= cosine:
                    links[i] += 1
                    links[j] += 1
                    p, q = sorted((find(i), find(j)))
                    root[q] = p
    return {i: (links[i], find(i)) for i, *_ in rows}


def test_planted(spark, monkeypatch):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(12, 16))
    rows = []
    for c in range(12):
        for k in range(25):
            rows.append(((base[c] + rng.normal(size=16) * 0.12 * (k % 5)).tolist(), c % 3))
    rows += [((base[0] * 3).tolist(), 0)] * 20 + [((base[1] * 1e-200).tolist(), 1), ((base[1] * 1e200).tolist(), 1)]
    rows += [(None, 0), ([0.0] * 16, 0), ([float("nan")] * 16, 0), ([1.0, None], 0), ([], 0), ([1.0, 2.0], 0), ([2.0, 4.0], 0),
             (base[0].tolist(), None), ([float("inf")] * 16, 0)]
    rows = [(i + 5, v, l) for i, (v, l) in enumerate(rows)]
    df = spark.createDataFrame([(i, v, l, 0) for i, v, l in rows], "vec_id long, embedding array<double>, label int, links int")
    monkeypatch.setattr(embed_dup, "BLOCK", 16)
    got = embed_dup.near_vectors(df, lists=6, codewords=8).collect()
    want = brute(rows, 0.98)
    found = sum(min(r.n_links, want[r.vec_id][0]) for r in got)
    print("recall", found / sum(n for n, _ in want.values()))
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == want
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)
    assert embed_dup.near_vectors(df.limit(0)).count() == 0
    none = embed_dup.near_vectors(df.filter("label is null")).collect()
    assert [(r.n_links, r.kept) for r in none] == [(0, True)]
