import collections
import zlib

from quarry.llm import sharding
from quarry.llm.queries import QUERIES


def plain(groups, shards):
    loads = [0] * shards
    for w, _ in sorted(groups, key=lambda g: (-g[0], g[1])):
        loads[loads.index(min(loads))] += w
    return sorted(loads)


def check(rows, texts, shards):
    of = collections.defaultdict(set)
    slots = collections.defaultdict(list)
    loads = collections.Counter(dict.fromkeys(range(shards), 0))
    for r in rows:
        b = (texts[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32) == (len(b) + 16, zlib.crc32(b))
        of[b].add(r.shard)
        slots[r.shard].append(r.slot)
        loads[r.shard] += r["size"]
    assert all(len(s) == 1 for s in of.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return sorted(loads.values())


def test_query(spark, sf):
    texts = dict(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    rows = QUERIES["op9_lpt_shards"](spark, sf).collect()
    assert len(rows) == len(texts) and all(r.law == "bytes" and r.grown_shard is None for r in rows)
    loads = check(rows, texts, 40)
    weight = collections.Counter()
    for t in texts.values():
        weight[t] += len(t.encode()) + 16
    want = plain([(w, t) for t, w in weight.items()], 40)
    assert max(loads) <= 1.05 * max(want)


def test_edges(spark):
    texts = {i: "same" * 500 for i in range(100)} | {100 + i: "t" * i for i in range(80)} | {200: None, 201: "", 202: "é" * 9000}
    df = spark.createDataFrame([(i, t, "x") for i, t in texts.items()], "doc_id long, text string, slot string")
    rows = sharding.shard(df, 7, grain=3, bundles=50).collect()
    check(rows, texts, 7)
    assert sorted(sharding.shard(df.repartition(5), 7, grain=3, bundles=50).collect()) == sorted(rows)
    assert sharding.shard(df.limit(0), 7).count() == 0
    twice = sharding.shard(df.union(df), 7).collect()
    assert len(twice) == 2 * len(texts)
    check(twice, texts, 7)
    assert sharding.schedule([(5, "a"), (4, "b"), (3, "c"), (3, "d")], 2) == {"a": 0, "b": 1, "c": 1, "d": 0}
