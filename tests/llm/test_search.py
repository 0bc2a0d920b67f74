import math
import random
import re
from collections import Counter

import numpy as np

from quarry.llm import search
from quarry.llm.queries import ORACLES, QUERIES
from tests.oracle_check import compare, duck

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain(docs, items, top):
    """Every document scored for every item."""
    held = [(d, Counter(terms(t))) for d, t, *_ in docs if terms(t)]
    n_docs, n_terms = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = {}
    for item in {i for i, *_ in items if i is not None}:
        asked = sum((Counter(terms(t)) for t in {t for i, t, *_ in items if i == item}), Counter())
        found = []
        for d, c in held:
            m = 25 + 75 * sum(c.values()) * n_docs // n_terms
            s = sum(r * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
                    for t, r in asked.items() if c[t])
            if s > 0:
                found.append((-s, d is None, d))
        out.update({(item, k + 1): (d, -s) for k, (s, _, d) in enumerate(sorted(found, key=lambda x: (x[0], x[1], x[2] or 0))[:top])})
    return out


def answer(spark, docs, items, top):
    docs = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, score string").repartition(3)
    items = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, rank int")
    rows = search.search(docs, items, top).collect()
    got = {(r.item_id, r["rank"]): (r.doc_id, r.score) for r in rows}
    assert len(got) == len(rows)
    return got


def test_terms():
    for text in ("Ab9_Ç-é ſ\x7f漢字 x", "", None, "É1 a\x00b"):
        assert [t.decode() for t in search.terms_of(text)] == terms(text)


def test_brute_force(spark, monkeypatch):
    monkeypatch.setattr(search, "BLOCK_DOCS", 16)
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(60)] + ["É", "漢字"]
    word = lambda: vocabulary[min(int(rng.expovariate(0.08)), 61)]
    docs = [(i, " ".join(word() for _ in range(rng.randint(1, 40)))) for i in range(200)]
    docs += [(200 + i, docs[i % 3][1]) for i in range(40)] + [(5, docs[5][1]), (None, docs[7][1]), (900, None), (901, ""), (902, " - ")]
    docs += [(903, "W1 w1 w2 " * 5000)]
    items = [(i, " ".join(word() for _ in range(rng.randint(1, 12)))) for i in range(12)]
    items += [(50, None), (51, ""), (52, "nowhere"), (None, "w1"), (3, items[3][1]), (3, "w9 w9"), (60, " ".join(vocabulary * 3)),
              (61, " ".join(f"w{i} z{i}" for i in range(200)))]
    expected = plain(docs, items, 10)
    assert answer(spark, docs, items, 10) == expected
    monkeypatch.setattr(search, "PASS_TERMS", 40)  # several passes
    assert answer(spark, docs, items, 10) == expected
    assert answer(spark, docs, items, 1000) == plain(docs, items, 1000)


def test_wide_masks_and_long_documents():
    """More than 64 terms, and lengths beyond 64 bits."""
    ranking = search._Ranking([("i", np.arange(70), np.ones(70, np.int64))], np.ones(70, np.int64), 1 << 40, 1 << 50, 3)
    sizes = np.array([1 << 30, 2, 3])
    assert ranking._lengths(sizes).tolist() == [25 + 75 * n * (1 << 40) // (1 << 50) for n in sizes.tolist()]
    at = np.concatenate([np.arange(3)] * 70)
    ranking.read([7, 8, 9], sizes, np.arange(70), np.arange(3, 213, 3), at, np.ones(210, np.int64))
    assert [d for _, d, _ in ranking.rows()] == [8, 9, 7]


def test_empty(spark):
    assert answer(spark, [], [(1, "w1")], 10) == {} and answer(spark, [(1, "w1")], [], 10) == {}
    assert answer(spark, [(1, None)], [(1, "w1")], 10) == {}


def test_query(spark, sf):
    name = "op12_ranked_search"
    assert compare(spark, duck(sf), name, QUERIES[name], ORACLES[name], sf)[0] == []
