import hashlib
import random

import numpy as np

from quarry.llm import suffix_dedup
from quarry.llm.queries import QUERIES


def brute(rows, length):
    """Result of each (doc_id, text) by a table of all strings."""
    least = {}
    for d, t in rows:
        b = (t or "").encode()
        if d is not None:
            for i in range(len(b) - length + 1):
                s = b[i:i + length]
                if least.get(s, d) >= d:
                    least[s] = d
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        if d is not None:
            for i in range(len(b) - length + 1):
                if least[b[i:i + length]] < d:
                    gone[i:i + length] = b"\x01" * length
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=lambda r: (r[0] is not None, *r))


def check(got, rows, length):
    assert sorted(map(tuple, got), key=lambda r: (r[0] is not None, *r)) == brute(rows, length)


def test_covers():
    for period, cover in suffix_dedup.COVERS.items():
        for i in range(period):
            assert all(any((i + k) % period in cover and (j + k) % period in cover for k in range(period))
                       for j in range(period))


def test_query(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op5_suffix_dedup"](spark, sf).collect()
    check(got, rows, 50)
    assert sum(r.n_removed for r in got) > 0


def test_planted(spark, monkeypatch):
    rng = random.Random(8)
    text = lambda n: "".join(rng.choice("abcdefg é漢") for _ in range(n))
    passage, edge = text(300), text(49)
    rows = [(i, text(rng.randint(0, 200)) + passage[rng.randint(0, 100):rng.randint(120, 300)] + text(rng.randint(0, 200)))
            for i in range(60)]
    rows += [(100, None), (101, ""), (102, "x" * 49), (103, "x" * 49), (104, "y" * 50), (105, "y" * 51), (106, "z" * 3000),
             (107, "z" * 70), (108, rows[3][1]), (1, rows[3][1]), (109, edge), (110, edge + "q"), (None, rows[5][1]), (111, rows[5][1]),
             (112, text(3000) + passage + text(2000)), (113, text(1500) + passage + text(700)), (2, text(10)), (2, passage), (2, passage)]
    df = spark.createDataFrame([(d, t, 0) for d, t in rows], "doc_id long, text string, n_bytes long")
    check(suffix_dedup.remove_repeats(df).collect(), rows, 50)
    check(suffix_dedup.remove_repeats(df, length=16).collect(), rows, 16)
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", 700)   # long documents in pieces
    check(suffix_dedup.remove_repeats(df).collect(), rows, 50)
    assert suffix_dedup.remove_repeats(df.limit(0)).count() == 0


def test_names():
    rng = np.random.default_rng(0)
    v = rng.integers(0, 2 ** 63, 200, dtype=np.uint64)
    for n in (1, 2, 3, 7, 20, 50):
        got = suffix_dedup.names(v, n, suffix_dedup._BASE)
        for i in (0, 5, 200 - n):
            h = 0
            for x in v[i:i + n].tolist():
                h = (h * int(suffix_dedup._BASE) + x) % 2 ** 64
            assert got[i] == suffix_dedup.mix(np.array([h], np.uint64))[0]
    assert len(suffix_dedup.names(v[:3], 4, suffix_dedup._BASE)) == 0
