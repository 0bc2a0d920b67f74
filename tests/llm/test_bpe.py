import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
import tiktoken

import public_tokenizers
from quarry.llm import bpe, common
from quarry.llm.queries import QUERIES, vocabulary

RANKS, PATTERN = vocabulary()
TIKTOKEN = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=RANKS, special_tokens={})

TEXTS = [None, "", " ", "Hello, world's  end\n\n", "<|endoftext|>", "ñandú ß 漢字 🙂🙂   x",
         "a" * 5000, "ab " * 2000, " " * 300 + "x", "1234567890" * 30, "'S 're'LL it's", "\x00\x1f\x85", "é" * 700]


def test_fold_equals_the_library():
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefgh thein~!é漢") for _ in range(rng.randint(1, 120))) for _ in range(300)]
    pairs = bpe.PairRanks(RANKS)
    at_once = [np.frombuffer(ids, np.int32).tolist() for ids in pairs.fold([w.encode() for w in words])]
    assert at_once == [bpe.fold(w.encode(), RANKS) for w in words] and pairs.fold([]) == []
    for w in [*words, *[t for t in TEXTS if t]]:
        got = [i for p in __import__("regex").findall(PATTERN, w) for i in bpe.fold(p.encode(), RANKS)]
        assert got == TIKTOKEN.encode_ordinary(w)


def test_texts(spark):
    df = spark.createDataFrame([(i, t, "s") for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], "s")],
                               "doc_id long, text string, ids string")
    rows = bpe.encode(df.select("doc_id", "text", "ids"), RANKS, PATTERN).collect()
    assert len(rows) == len(TEXTS) + 1
    for r in rows:
        assert r.ids == TIKTOKEN.encode_ordinary(TEXTS[r.doc_id] or "")
    back = bpe.decode(bpe.encode(df, RANKS, PATTERN), RANKS).collect()
    for r in back:
        assert bytes(r.bytes) == (TEXTS[r.doc_id] or "").encode()
    both = bpe.encode_decode(df, RANKS, PATTERN).collect()
    assert len(both) == len(TEXTS) + 1
    for r in both:
        assert r.decoded == (TEXTS[r.doc_id] or "") and r.ids == TIKTOKEN.encode_ordinary(r.decoded) and r.n_tokens == len(r.ids)
    assert bpe.round_trip(df.limit(0), RANKS, PATTERN).count() == 0 and bpe.encode_decode(df.limit(0), RANKS, PATTERN).count() == 0


def test_little_memory(monkeypatch):
    """A worker that forgets all words at each call gives the same ids."""
    monkeypatch.setattr(bpe, "REMEMBERED_BYTES", 0)
    encoder, decoder = bpe._Encoder(RANKS, bpe.PairRanks(RANKS), PATTERN), bpe._Decoder(RANKS)
    for t in TEXTS * 2:
        ids = np.frombuffer(encoder([t])[0], np.int32)
        assert ids.tolist() == TIKTOKEN.encode_ordinary(t or "") and decoder(ids) == (t or "").encode()
    with pytest.raises(ValueError):
        decoder(np.array([len(RANKS) + 5]))


def test_texts_come_in_small_pieces(spark):
    """A function over texts never gets more than PIECE_BYTES at once, but for one text; no row is lost or changes place."""
    lengths = [200_000 if i % 7 == 0 else 30_000 if i % 3 else 5 for i in range(100)] + [600_000, 0]
    df = spark.createDataFrame([(i, "x" * n if n else None) for i, n in enumerate(lengths)], "doc_id int, text string").coalesce(1)

    def start():
        def made(texts):
            held = sum(len(t or "") for t in texts)
            return [pa.array([len(t or "") for t in texts]), pa.array([0 if len(texts) == 1 else held] * len(texts))]
        return made
    rows = common.from_texts(df, "text", "n long, held long", start).collect()
    assert [(r.doc_id, r.n) for r in rows] == list(enumerate(lengths))
    assert max(r.held for r in rows) <= common.PIECE_BYTES
    assert [common._bytes(x) for x in ("67108864b", "64m", "1gb", "2K", "-1b", "5")] == [64 << 20, 64 << 20, 1 << 30, 2048, -1, 5]
    assert common._bytes(spark.conf.get(common.ARROW_BYTES)) <= common.BATCH_BYTES


def test_query_equals_the_library(spark, sf):
    texts = dict(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    rows = QUERIES["op1_byte_bpe"](spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = TIKTOKEN.encode_ordinary(texts[r.doc_id] or "")
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()


def test_words_by_higher_order_functions(spark):
    words = ["the", " thndouha", "Zuschlag", " ", "ñandú", "x", "", None, "aaaaaaaaaaaa", "1999"]
    df = spark.createDataFrame([(w,) for w in words], "word string")
    for r in bpe.encode_words(spark, df, RANKS).collect():
        assert r.ids == (bpe.fold(r.word.encode(), RANKS) if r.word else [])
