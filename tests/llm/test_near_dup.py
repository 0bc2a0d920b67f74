import random

import numpy as np

from quarry.llm import near_dup
from quarry.llm.near_dup import Bands, joint_estimate, near_duplicates, sketch
from quarry.llm.queries import QUERIES


def brute(texts, k, percent):
    """doc_id -> (set size, component) by comparing all pairs."""
    ids = sorted(texts)
    sets = {}
    for i in ids:
        w = (texts[i] or "").encode().lower().split()
        sets[i] = {tuple(w[j:j + k]) for j in range(max(1, len(w) - k + 1))} if w else set()
    of = {i: i for i in ids}

    def root(i):
        while of[i] != i:
            i = of[i]
        return i
    for x, i in enumerate(ids):
        for j in ids[:x]:
            a, b = sets[i], sets[j]
            if a and b and 100 * min(len(a), len(b)) >= percent * max(len(a), len(b)):
                n = len(a & b)
                if 100 * n >= percent * (len(a) + len(b) - n):
                    p, q = sorted((root(i), root(j)))
                    of[q] = p
    return {i: (len(sets[i]), root(i)) for i in ids}


def check(rows, want):
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def test_query_equals_brute_force(spark, sf):
    texts = dict(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    check(QUERIES["op2_setsketch_near_dup"](spark, sf).collect(), brute(texts, 3, 85))


def test_planted(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    texts = {0: None, 1: "", 2: " \t\n", 3: "one two", 4: "ONE  two", 5: "x" * 50_000}
    base = [word() for _ in range(400)]
    for i in range(10, 60):  # near copies, each with other words replaced
        w = list(base)
        for _ in range(rng.randint(0, 9)):
            w[rng.randrange(400)] = word()
        texts[i] = " ".join(w)
    chain = [word() for _ in range(200)]
    for i in range(70, 90):  # each linked to the next only
        texts[i] = " ".join(chain)
        chain = chain[4:] + [word() for _ in range(4)]
    passage = [word() for _ in range(100)]
    for i in range(100, 130):  # a shared half, no links
        texts[i] = " ".join(passage + [word() for _ in range(60)])
    rows = [(i, t, "s", 1) for i, t in texts.items()]
    df = spark.createDataFrame(rows, "doc_id long, text string, set_key string, n long")
    check(near_duplicates(df, 5, 80).collect(), brute(texts, 5, 80))
    twice = near_duplicates(df.union(df), 5, 80).collect()
    assert len(twice) == 2 * len(rows)
    check(twice, brute(texts, 5, 80))
    assert near_duplicates(df.limit(0)).count() == 0


def test_registers():
    factors, offsets = near_dup._multipliers(4096)
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 2 ** 63, 3000, dtype=np.uint64)
    a, b = pool[:2000], pool[1000:]
    ra, rb = sketch(a, factors, offsets), sketch(b, factors, offsets)
    assert (np.maximum(ra, rb) == sketch(pool, factors, offsets)).all()  # mergeable
    best, loss = joint_estimate(ra[None].astype(int), rb[None].astype(int), np.array([2000.0]), np.array([2000.0]), 0.85)
    assert abs(best[0] - 1 / 3) < 0.03 and loss[0] > near_dup.HOPELESS
    assert Bands.for_threshold(0.85) == Bands(30, 6) and Bands.for_threshold(0.8) == Bands(36, 5)


def test_search_within_bands(spark, monkeypatch):
    """Loose near copies: few links, many candidates, bands in several blocks."""
    monkeypatch.setattr(near_dup, "BAND_BLOCK", 8)
    rng = random.Random(9)
    base = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(150)]
    texts = {}
    for i in range(120):
        w = list(base)
        for at in rng.sample(range(150), rng.choice((1, 4, 5))):
            w[at] = f"w{rng.randrange(10 ** 6)}"
        texts[i] = " ".join(w)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    check(near_duplicates(df, 3, 85).collect(), brute(texts, 3, 85))
    sets = [np.array(sorted(rng.sample(range(40), 20)), np.uint64) for _ in range(60)]
    root = near_dup._linked_within(sets, 60)
    of = {}
    for i, a in enumerate(sets):
        of[i] = i
        for j in range(i):
            n = len(set(a.tolist()) & set(sets[j].tolist()))
            if 100 * n >= 60 * (40 - n):
                old, new = max(of[i], of[j]), min(of[i], of[j])
                of = {k: new if v == old else v for k, v in of.items()}
    assert root.tolist() == [of[i] for i in range(60)]


def test_null_doc_ids(spark):
    words = [f"w{i}" for i in range(240)]
    part = lambda a: " ".join(words[a:a + 200])
    other = [f"v{i}" for i in range(100)]
    rows = [(1, part(0)), (None, part(12)), (3, part(24)), (None, " ".join(other)), (None, " ".join(other[1:])), (7, "alone"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_duplicates(df, 3, 85).collect()), key=str)
    assert got == sorted([(1, 198, 1, True), (None, 198, 1, False), (3, 198, 1, False), (None, 98, None, True),
                          (None, 97, None, True), (7, 1, 7, True), (None, 0, None, True)], key=str)
