import hashlib
import random

import numpy as np

from quarry.llm import fingerprints as fp
from quarry.llm.queries import QUERIES


def lz_phrases(data):
    """The dictionary of LZ78, by byte strings."""
    seen, phrase = set(), b""
    for i in range(len(data)):
        phrase += data[i:i + 1]
        if phrase not in seen:
            seen.add(phrase)
            phrase = b""
    return seen


def hash_of(phrase):
    h = 0
    for c in phrase:
        h = (h + c + 1) * fp._GROW & fp._MASK
    return h


def by_brute_force(text):
    s = np.array([hash_of(p) for p in lz_phrases(text.encode())], np.uint64)
    return fp.signature(fp.mix(s))


def check(rows, texts):
    order = sorted(texts, key=lambda d: (d is not None, d))
    assert len(rows) == len(texts)
    got = {r.doc_id: r for r in rows}
    for d, n in zip(order, order[1:] + order[:1]):
        r, t, u = got[d], texts[d] or "", texts[n] or ""
        half = len(t) // 2
        edited = t[:len(t) - half] + u[:half]
        assert r.n_chars == len(t)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.fingerprint == by_brute_force(t) and r.edited_fingerprint == by_brute_force(edited)
        assert r.near_edited == fp.likeness(r.fingerprint, r.edited_fingerprint)
        assert r.near_next == fp.likeness(r.fingerprint, by_brute_force(u))


def test_query(spark, sf):
    texts = dict(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    rows = QUERIES["op10_lz_fingerprints"](spark, sf).collect()
    check(rows, texts)
    assert np.mean([r.near_edited for r in rows]) > np.mean([r.near_next for r in rows]) + 0.15


def test_edges(spark):
    texts = {None: "first of all", 2 ** 60 + 1: "", 3: None, 5: "a" * 100_000, 7: "ñ漢🙂" * 50, 8: "x", 9: "ñ漢🙂" * 50}
    df = spark.createDataFrame([(d, t, "p") for d, t in texts.items()], "doc_id long, text string, part string")
    check(fp.with_next(df).collect(), texts)
    assert fp.with_next(df.limit(0)).count() == 0
    one = fp.with_next(df.filter("doc_id = 7")).collect()
    check(one, {7: texts[7]})
    assert one[0].near_next == 1
    twice = fp.with_next(df.union(df)).collect()
    assert len(twice) == 2 * len(texts)
    same = {r.doc_id: r.fingerprint for r in fp.fingerprints(df).collect()}
    assert same[7] == same[9] and same[3] == same[2 ** 60 + 1] == "f" * 512


def test_likeness_estimates_the_phrase_sets():
    rng = random.Random(1)
    words = ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(400)]
    t = " ".join(rng.choice(words) for _ in range(3000))
    u = t[:12000] + " ".join(rng.choice(words) for _ in range(1500))
    a, b = lz_phrases(t.encode()), lz_phrases(u.encode())
    assert abs(fp.likeness(fp.fingerprint(t), fp.fingerprint(u)) - len(a & b) / len(a | b)) < 0.15
