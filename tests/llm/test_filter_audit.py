import hashlib
from itertools import permutations

from quarry.llm import filter_audit
from quarry.llm.queries import ORACLES, QUERIES
from tests.oracle_check import compare, duck

DOCS = "doc_id long, lang string, text string, _at string, term long"


def plain(docs, labels):
    """The audit document by document, order by order."""
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    rows = []
    for doc_id, lang, text, *_ in docs:
        text = text or ""
        words = text.encode().split()
        fails = ("A" * (len(words) < 200) + "B" * (100 * len(set(words)) < 50 * len(words))
                 + "C" * (100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text)) + "D" * any(c in "#$%&*|" for c in text)
                 + "E" * (doc_id is not None and any(d is not None and d < doc_id and (t or "") == text for d, _, t, *_ in docs)))
        rows.append((lang or "", doc_id, fails))
    out, removed = {}, {}
    for part in {r[0] for r in rows}:
        own = [r[1:] for r in rows if r[0] == part]
        for order in map("".join, permutations("ABCDE")):
            for s, f in enumerate(order):
                left = [r for r in own if not set(order[:s]) & set(r[1])]
                gone = [r for r in left if f in r[1]]
                out[part, order, s + 1] = (len(left) - len(gone), len(gone), sum(f in r[1] for r in own) - len(gone),
                                           sum(r[1] == f for r in own), sum(r[0] in good for r in gone), sum(r[0] in toxic for r in gone))
                removed[part, f] = removed.get((part, f), 0) + len(gone)
    return {k: (*v, removed[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def table_of(rows):
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    return {(r.part, r.filter_order, r.step): tuple(r[n] for n in names) for r in rows}


def test_edge_cases(spark):
    long = " ".join(f"w{i}" for i in range(250))
    same = "same words " * 150
    docs = [(1, "en", None), (2, "en", ""), (3, None, ""), (4, "", "A#"), (5, "de", long), (6, "de", long), (5, "de", long),
            (7, "de", same), (8, "en", same.upper()), (None, "de", long), (None, None, "x"), (9, "en", long + " $"),
            (10, "en", "a\tb\nc\vd\fe\rf g"), (11, "en", " ".join(["ÄÖ"] * 400)), (12, "de", long), (0, "es", long)]
    docs = [(*d, "x", 1) for d in docs]
    labels = [(1, 1, 0), (6, 1, 1), (6, 0, 0), (None, 1, 1), (12, None, 1), (99, 1, 1), (8, 0, 1)]
    got = filter_audit.audit(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    got = got.collect()
    assert len(got) == 600 * 4 and table_of(got) == plain(docs, labels)


def test_empty(spark):
    docs = spark.createDataFrame([], DOCS)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(docs, labels).count() == 0
    some = spark.createDataFrame([(1, None, None, "", 0)], DOCS)
    rows = filter_audit.audit(some, labels).collect()
    assert len(rows) == 600 and {r.part for r in rows} == {""} and sum(r.removed for r in rows) == 120


def test_matrix(spark, monkeypatch):
    """Shards of few words give the same matrix as one: a global dictionary and the counts of each text."""
    monkeypatch.setattr(filter_audit, "SHARD_WORDS", 50)
    texts = [(i, "en", " ".join(f"w{(i * j) % 37}" for j in range(i % 23)) or None, "", 0) for i in range(120)]
    matrix, dictionary = filter_audit.term_matrix(spark.createDataFrame(texts, DOCS).repartition(3))
    words = {r.term: bytes(r.word).decode() for r in dictionary.collect()}
    assert sorted(words) == list(range(len(words))) and len(set(words.values())) == len(words)
    seen = {}
    for shard in matrix.collect():
        start = 0
        for doc, end in zip(shard.docs, shard.row_ends):
            seen[doc.doc_id] = {words[t]: n for t, n in zip(shard.terms[start:end], shard.counts[start:end])}
            assert bytes(doc.digest) == hashlib.sha256((texts[doc.doc_id][2] or "").encode()).digest()
            start = end
    expected = {i: {w: t.split().count(w) for w in set(t.split())} if t else {} for i, _, t, *_ in texts}
    assert seen == expected
    totals = {r.doc_id: (r.words, r.distinct_words) for r in filter_audit.row_totals(matrix).collect()}
    assert totals == {i: (sum(c.values()), len(c)) for i, c in expected.items()}


def test_query(spark, sf):
    name = "op11_filter_audit"
    assert compare(spark, duck(sf), name, QUERIES[name], ORACLES[name], sf)[0] == []
