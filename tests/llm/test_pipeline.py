import collections
import re

import pytest
import tiktoken

import corpus_pipeline
from quarry.llm import mixing, quality
from quarry.llm.queries import PSEUDONYM_KEY, vocabulary
from tests.llm.test_mixing import level_by_rounds
from tests.llm.test_near_dup import brute
from tests.llm.test_pii import masked

STAGES = dict(corpus_pipeline.STAGES)
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    rows += [rows[3], (None, rows[3][1], "en", None, 5), (None, "alone here now and then", None, None, 5), (10 ** 6, None, "en", "src1", None),
             (10 ** 6 + 1, "", "en", "src1", 0), (10 ** 6 + 2, "write to the.24@mail4.example.com today", "en", None, 3)]
    return spark.createDataFrame(rows, SCHEMA), rows


def test_quality(spark, sf, docs):
    df, rows = docs
    got = STAGES["quality"](spark, df, sf)
    assert got.columns == df.columns
    scored = quality.score(df.select("doc_id", "text"), spark.read.parquet(f"{sf}/labels.parquet")).collect()
    # repeated doc_ids and nulls are told apart by text
    want = collections.Counter(r.doc_id for r in scored if r.score >= 0.5)
    assert collections.Counter(r.doc_id for r in got.collect()) == want and 0 < sum(want.values()) < len(rows)


def test_near_dup(spark, sf, docs):
    df, rows = docs
    got = [tuple(r) for r in STAGES["near_dup"](spark, df, sf).collect()]
    texts = {i: r[1] for i, r in enumerate(rows)}
    component = {i: c for i, (_, c) in brute(texts, 5, 80).items()}
    order = lambda i: (rows[i][0] is None, rows[i][0] or 0)
    groups = collections.defaultdict(list)
    for i in component:
        groups[component[i]].append(i)
    assert len(got) == len(groups)
    assert collections.Counter(r[0] for r in got) == collections.Counter(rows[min(g, key=order)][0] for g in groups.values())


def test_pii(spark, sf, docs):
    df, rows = docs
    got = STAGES["pii"](spark, df, sf)
    assert got.columns == df.columns
    want = collections.Counter()
    for d, t, lang, source, n in rows:
        m, _ = masked(t, PSEUDONYM_KEY)
        want[d, m, lang, source, n if m is None else len(m)] += 1
    assert collections.Counter(map(tuple, got.collect())) == want


def test_mixing(spark, sf, docs):
    df, rows = docs
    got = STAGES["mixing"](spark, df, sf)
    assert got.columns == df.columns
    taken, sizes = collections.Counter(), collections.Counter()
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    for r in got.collect():
        taken[r.source] += words(r.text)
    for _, t, _, s, _ in rows:
        sizes[s] += words(t)
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = level_by_rounds(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}, 1.5, 2.0)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 2 * max(words(r[1]) for r in rows if r[3] == s)
    assert got.count() == sum(r.copies for r in mixing.mixture(df).collect())


def test_bpe(spark, sf, docs):
    df, rows = docs
    ranks, pattern = vocabulary()
    enc = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    got = STAGES["bpe"](spark, df, sf).collect()
    assert len(got) == len(rows)
    want = collections.Counter((r[0], r[1] or "") for r in rows)
    assert collections.Counter((r.doc_id, r.text) for r in got) == want
    assert all(r.ids == enc.encode_ordinary(r.text) and r.n_tokens == len(r.ids) for r in got)


def test_run(spark, sf):
    rows = corpus_pipeline.run(spark, sf).collect()
    ids = {r.doc_id for r in rows}
    assert 0 < len(ids) <= 200 and all(r.n_tokens > 0 for r in rows)
    for name, stage in corpus_pipeline.STAGES:
        empty = spark.createDataFrame([], SCHEMA)
        assert stage(spark, empty, sf).count() == 0, name
