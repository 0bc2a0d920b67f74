import collections
import math

import pytest

from quarry.llm import mixing
from quarry.llm.queries import ORACLES, QUERIES
from tests.oracle_check import compare, duck


def test_query_equals_sql(spark, sf):
    name = "op3_systematic_mixture"
    msg, *_ = compare(spark, duck(sf), name, QUERIES[name], ORACLES[name], sf)
    assert not msg, msg


def level_by_rounds(sizes, weights, share, most):
    """Targets by sharing out, cutting at the cap and sharing the excess again."""
    aim, open_, left = dict.fromkeys(sizes, 0.0), set(sizes), share * sum(sizes.values())
    while left > 1e-9 and open_:
        w = sum(weights[s] for s in open_)
        for s in open_:
            aim[s] += left * weights[s] / w
        left = 0.0
        for s in list(open_):
            if aim[s] >= most * sizes[s]:
                left += aim[s] - most * sizes[s]
                aim[s] = most * sizes[s]
                open_.discard(s)
    return aim


def test_edges(spark):
    rows = [(i, "w " * (1 + i % 7), "hot", "x") for i in range(300)]
    rows += [(300 + i, "w " * (i * 3), "b", "x") for i in range(40)]
    rows += [(400, None, None, "x"), (401, "one two", None, "x"), (402, "", "empty", "x"), (403, "a\x0bb\x1fc d", "z", "x"),
             (5, rows[5][1], "hot", "x"), (None, "q w", "z", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size string")
    got = mixing.mixture(df).collect()
    assert len(got) == len(rows) and "size" in got[0]
    sizes = collections.Counter()
    for _, t, s, _ in rows:
        sizes[s] += len((t or "").encode().split())
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = level_by_rounds(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}, 1.5, 2.0)
    taken = collections.Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert r.size == len((r.text or "").encode().split())
        e = r.target / r.source_size if r.source_size else 0
        assert math.floor(e) <= r.copies <= math.ceil(e) <= 2
        taken[r.source] += r.copies * r.size
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 2 * max(len((t or "").split()) for _, t, x, _ in rows if x == s)
    again = mixing.mixture(df.repartition(7)).collect()
    key = lambda r: (r.doc_id is None, r.doc_id, r.copies)
    assert sorted(map(key, again)) == sorted(map(key, got))
    assert mixing.emitted(mixing.mixture(df)).count() == sum(r.copies for r in got)
    assert mixing.mixture(df.limit(0)).count() == 0
