import random
import zlib

import numpy as np

from quarry.llm import quality
from quarry.llm.queries import QUERIES


def auc(score, label):
    pos, neg = [s for s, y in zip(score, label) if y], [s for s, y in zip(score, label) if not y]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def test_query_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    rows = QUERIES["op6_random_indexing_quality"](spark, sf).collect()
    labels = dict(spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality").collect())
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [(r.score, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    a = auc(*zip(*held))
    accuracy = np.mean([(s >= 0.5) == y for s, y in held])
    print("held out", len(held), "AUC", a, "accuracy", accuracy)
    assert a > 0.9 and accuracy > 0.9


def test_vectors_equal_brute_force(spark, monkeypatch):
    rng = random.Random(2)
    texts = [" ".join(rng.choice("abcdefgh") for _ in range(n)) for n in (0, 1, 2, 50, 300)] + [None]
    want = np.zeros((quality.BUCKETS + 1, quality.DIMS))
    index, hashes = quality._index_vectors(), quality.WordHashes()
    for t in texts:
        w = quality._buckets(t, hashes)
        for i in range(len(w)):
            for j in range(max(0, i - quality.WINDOW), min(len(w), i + quality.WINDOW + 1)):
                if i != j:
                    want[w[i]] += index[w[j]]
    want /= np.maximum(np.linalg.norm(want, axis=1, keepdims=True), 1e-9)
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    assert np.allclose(quality.word_vectors(df), want, atol=1e-6)
    pieces = list(quality._pieces(np.arange(10)))
    monkeypatch.setattr(quality, "CHUNK", 4)
    cut = list(quality._pieces(np.arange(10)))
    assert [list(p[c]) for p, c in cut] == [[0, 1, 2, 3], [4, 5, 6, 7], [8, 9]] and len(pieces) == 1
    a, b = np.zeros((quality.BUCKETS, quality.DIMS), np.int64), np.zeros((quality.BUCKETS, quality.DIMS), np.int64)
    both = np.vstack([index, np.zeros((1, quality.DIMS), np.int8)])
    quality._add_neighbours(a, pieces, both)
    quality._add_neighbours(b, cut, both)
    assert (a == b).all()


def test_edges(spark):
    docs = spark.createDataFrame([(1, "good words here", "a"), (1, "good words here", "a"), (2, None, "b"), (3, "", "c"),
                                  (4, "bad " * 100_000, "d"), (None, "x", "e")], "doc_id long, text string, score string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    rows = quality.score(docs, none).collect()
    assert len(rows) == 6 and all(r.score == 0.5 and r.predicted == 1 for r in rows)
    some = spark.createDataFrame([(i, i % 2) for i in range(1, 5)] + [(1, 0), (2, None)], "doc_id long, quality int")
    rows = quality.score(docs, some).collect()
    assert len(rows) == 6 and len({r.score for r in rows if r.doc_id == 1}) == 1
    assert quality.score(docs.limit(0), some).count() == 0


def test_network():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, 5))
    y = ((x[:, 0] * x[:, 1] > 0) ^ (rng.random(2000) < 0.1)).astype(int)
    net = quality.train(x, y, rounds=30)
    p = net(x)
    assert np.mean((p > 0.5) == y) > 0.85
    assert abs(p.mean() - y.mean()) < 0.05 and 0.25 <= net.temperature <= 8
    assert quality.train(x, np.ones(2000)) is None
