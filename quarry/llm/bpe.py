"""Byte-level byte-pair encoding and decoding by a published table of merge ranks.

Method: a word's byte array is folded by ranked merges, once for each distinct
word that a task meets; decoding concatenates the byte pieces of the ids.

Every text is handled where it is read: there is no shuffle.  The rank map (some
50,000 entries, a bound that the vocabulary file gives) goes to each executor
once as a broadcast variable.  ``encode_words`` is the same fold written with
Spark's higher-order functions over a literal rank map, for tables of distinct
words; README.md says why whole corpora don't go that way.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import json
import sys
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import from_texts

#: About what the words that a worker remembers with their ids take; beyond, it starts anew. Bounds memory only.
REMEMBERED_BYTES = 16 << 20
#: Words of more bytes are folded with a heap, and never remembered.
LONG_WORD = 64


def load_ranks(path: str) -> dict[bytes, int]:
    """Rank of each byte piece from a file of lines "base64 rank"."""
    with open(path, "rb") as f:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, filter(bytes.strip, f))}


def fold(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one word: merge the adjacent pair of least rank, the leftmost of equals, until none is left."""
    if word in ranks:
        return [ranks[word]]
    if len(word) > LONG_WORD:
        return _fold_long(word, ranks)
    parts = [word[i:i + 1] for i in range(len(word))]
    get, none = ranks.get, len(ranks) + 1
    while len(parts) > 1:
        pair = [get(a + b, none) for a, b in zip(parts, parts[1:])]
        least = min(pair)
        if least == none:
            break
        i = pair.index(least)
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
    return [ranks[p] for p in parts]


def _fold_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges in n log n steps: a heap of (rank, place) over a linked list of pieces."""
    n = len(word)
    end = list(range(1, n + 1))          # where the piece that starts here ends
    before = list(range(-1, n - 1))      # start of the piece before
    alive = bytearray(b"\x01") * n
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i:i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, j = heapq.heappop(heap)
        if not alive[i] or end[i] >= n or end[end[i]] != j:
            continue
        gone = end[i]
        alive[gone] = 0
        end[i] = j
        if j < n:
            before[j] = i
            if (r := ranks.get(word[i:end[j]])) is not None:
                heapq.heappush(heap, (r, i, end[j]))
        if (p := before[i]) >= 0 and (r := ranks.get(word[p:j])) is not None:
            heapq.heappush(heap, (r, p, j))
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i:end[i]]])
        i = end[i]
    return out


class PairRanks:
    """The rank map as a table over pairs of ids: the rank (and id) of two pieces joined, where that is a piece."""

    def __init__(self, ranks: dict[bytes, int]):
        pairs = {}
        for piece, rank in ranks.items():
            for i in range(1, len(piece)):
                a, b = ranks.get(piece[:i]), ranks.get(piece[i:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = rank
        self.keys = np.array(sorted(pairs), np.int64)
        self.values = np.array([pairs[k] for k in self.keys.tolist()], np.int64)
        self.none = max(ranks.values(), default=0) + 1
        self.bytes = np.array([ranks.get(bytes([i]), -1) for i in range(256)], np.int64)

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(a), self.none)
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.values[at], self.none)

    def fold(self, words: list[bytes]) -> list[bytes]:
        """Ids of many words at once, as 32-bit integers: each round merges, in every word, the leftmost pair of least rank."""
        if not words:
            return []
        size = np.fromiter(map(len, words), np.int64, len(words))
        ids = self.bytes[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), size)
        rank = np.full(len(ids), self.none)  # of a piece with the next of its word
        pair = np.flatnonzero(word[:-1] == word[1:])
        rank[pair] = self(ids[pair], ids[pair + 1])
        out = [b""] * len(words)
        while len(ids):
            start = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            least = np.minimum.reduceat(rank, start)
            size = np.diff(np.r_[start, len(ids)])
            done = least == self.none
            if done.any():
                flat = ids.astype(np.int32).tobytes()
                for w, s, n in zip(word[start[done]].tolist(), start[done].tolist(), size[done].tolist()):
                    out[w] = flat[4 * s:4 * (s + n)]
                keep = np.repeat(~done, size)
                ids, word, rank = ids[keep], word[keep], rank[keep]
                least, size = least[~done], size[~done]
                if not len(ids):
                    break
            hit = np.flatnonzero(rank == np.repeat(least, size))
            at = hit[np.r_[True, word[hit[1:]] != word[hit[:-1]]]]  # the leftmost of each word
            ids[at] = rank[at]
            rank[at] = rank[at + 1]
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            now = at - np.arange(len(at))  # where the merged pieces stand once the others are gone
            ids, word, rank = ids[keep], word[keep], rank[keep]
            for left in (now - 1, now):  # the pairs that a merge has changed
                left = left[(left >= 0) & (left + 1 < len(ids))]
                left = left[word[left] == word[left + 1]]
                rank[left] = self(ids[left], ids[left + 1])
            last = now[(now + 1 >= len(ids)) | (word[np.minimum(now + 1, len(ids) - 1)] != word[now])]
            rank[last] = self.none
        return out


class _Encoder:
    """One worker's view: the rank map and the distinct words met lately, with their ids as 32-bit integers."""

    def __init__(self, ranks: dict[bytes, int], pairs: PairRanks, pattern: str):
        self.ranks, self.pairs, self.words, self.held = ranks, pairs, {}, 0
        self.find = regex.compile(pattern).findall

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text: distinct words are folded once."""
        found = [self.find(t) if t else [] for t in texts]
        known = self.words
        if self.held > REMEMBERED_BYTES:
            known.clear()
            self.held = 0
        short, long = [], {}
        for w in {w for words in found for w in words if w not in known}:
            b = w.encode("utf-8", "replace")
            if (whole := self.ranks.get(b)) is not None:
                known[w] = whole.to_bytes(4, sys.byteorder)
            elif len(b) <= LONG_WORD:
                short.append((w, b))
            else:
                long[w] = np.array(fold(b, self.ranks), np.int32).tobytes()
        known.update(zip([w for w, _ in short], self.pairs.fold([b for _, b in short])))
        self.held += sum(len(b) for _, b in short) * 6 + 200 * len(short)  # about what the dictionary holds
        known = {**known, **long} if long else known
        return [b"".join([known[w] for w in words]) for words in found]


class _Decoder:
    """The byte pieces by id, in one buffer."""

    def __init__(self, ranks: dict[bytes, int]):
        pieces = [b""] * (max(ranks.values(), default=-1) + 1)
        for piece, i in ranks.items():
            pieces[i] = piece
        self.size = np.array([len(p) for p in pieces] or [0], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(pieces), np.uint8)

    def __call__(self, ids: np.ndarray) -> bytes:
        """The pieces of ``ids`` concatenated."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.size) or not self.size[ids].all()):
            raise ValueError("id outside the vocabulary")
        size = self.size[ids]
        at = np.repeat(self.start[ids] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        return self.flat[at].tobytes()


def _mapped(docs: DataFrame, column: str, declared: str, shared: tuple, start: Callable) -> DataFrame:
    """``docs`` with what the function that ``start`` makes of the broadcast values gives for the column."""
    sent = docs.sparkSession.sparkContext.broadcast(shared)
    return from_texts(docs, column, declared, lambda: start(*sent.value))


def _id_lists(ids: list[bytes]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, ids)]) // 4
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(ids), np.int32)))


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text") -> DataFrame:
    """``docs`` with ``ids array<int>`` in the place of the text.

    A null text counts as empty and gives an empty list; other columns pass
    through, one named ``ids`` is replaced; repeated rows stay.
    """
    def start(ranks, pairs):
        encoder = _Encoder(ranks, pairs, pattern)
        return lambda texts: [_id_lists(encoder(texts))]
    return _mapped(docs, text, "ids array<int>", (ranks, PairRanks(ranks)), start)


def decode(encoded: DataFrame, ranks: dict[bytes, int], ids: str = "ids") -> DataFrame:
    """``encoded`` with ``bytes binary``, the pieces of the ids concatenated, in the place of the ids.

    Null ids give empty bytes; an id outside the vocabulary ends the job.
    """
    def start(ranks):
        decoder = _Decoder(ranks)
        return lambda lists: [pa.array([decoder(np.array(x or (), np.int64)) for x in lists], pa.binary())]
    return _mapped(encoded, ids, "bytes binary", (ranks,), start)


def encode_decode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text") -> DataFrame:
    """Encode and decode in one pass: ``docs`` with ``decoded string`` (what the ids decode to), ``ids array<int>``
    and ``n_tokens long`` in the place of the text.

    A null text counts as empty; other columns pass through, those of these names are replaced; repeated rows stay.
    """
    def start(ranks, pairs):
        encoder, decoder = _Encoder(ranks, pairs, pattern), _Decoder(ranks)

        def made(texts):
            ids = encoder(texts)
            back = [decoder(np.frombuffer(x, np.int32)) for x in ids]
            return [pa.array(back, pa.binary()).cast(pa.string()), _id_lists(ids), pa.array([len(x) // 4 for x in ids], pa.int64())]
        return made
    return _mapped(docs, text, "decoded string, ids array<int>, n_tokens long", (ranks, PairRanks(ranks)), start)


def round_trip(docs: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text") -> DataFrame:
    """Encode and decode in one pass, keeping digests only.

    Columns: those of ``docs`` but the text, ``n_tokens long``, ``ids_sha256``
    (of the decimal ids joined by commas) and ``decoded_sha256`` (of the bytes
    that the ids decode to).  A null text counts as empty: no ids.
    """
    def start(ranks, pairs):
        encoder, decoder = _Encoder(ranks, pairs, pattern), _Decoder(ranks)
        sha = lambda b: hashlib.sha256(b).hexdigest()

        def made(texts):
            ids = [np.frombuffer(x, np.int32) for x in encoder(texts)]
            return [pa.array([len(x) for x in ids], pa.int64()), pa.array([sha(",".join(map(str, x.tolist())).encode()) for x in ids]),
                    pa.array([sha(decoder(x)) for x in ids])]
        return made
    return _mapped(docs, text, "n_tokens long, ids_sha256 string, decoded_sha256 string", (ranks, PairRanks(ranks)), start)


#: Small maps that the literal rank map is dealt into: Spark searches a map from end to end.
RANK_BUCKETS = 16384


def _bucket(piece_hex: Column) -> Column:
    return F.pmod(F.crc32(piece_hex), F.lit(RANK_BUCKETS)) + 1


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once; null where the value is null."""
    return F.get(F.transform(F.filter(F.array(value), lambda v: v.isNotNull()), body), F.lit(0))


def encode_words(spark: SparkSession, words: DataFrame, ranks: dict[bytes, int], word: str = "word") -> DataFrame:
    """``words`` with ``ids array<int>`` by Spark's own functions: for tables of distinct words.

    The bytes are an array of hexadecimal pieces; ``aggregate`` folds one merge
    for each byte but the first, as long as a pair has a rank.  A null word
    gives an empty list.  The square of a word's length in look-ups.
    """
    import zlib

    dealt: list[dict[str, int]] = [{} for _ in range(RANK_BUCKETS)]
    for piece, rank in ranks.items():
        h = piece.hex().upper()
        dealt[zlib.crc32(h.encode()) % RANK_BUCKETS][h] = rank
    literal = F.from_json(F.lit(json.dumps(dealt)), "array<map<string,int>>")

    def rank(piece: Column) -> Column:
        return F.try_element_at(F.element_at(literal, _bucket(piece).cast("int")), piece)

    def merged(parts: Column, pairs: Column) -> Column:
        """``parts`` with the leftmost pair of least rank joined; as they are where no pair has a rank."""
        at = F.nullif(F.array_position(pairs, F.array_min(pairs)).cast("int"), F.lit(0))
        return F.coalesce(_let(at, lambda i: F.concat(
            F.slice(parts, F.lit(1), i - 1), F.array(F.concat(F.element_at(parts, i), F.element_at(parts, i + 1))),
            F.slice(parts, i + 2, F.size(parts)))), parts)

    def step(parts: Column, _: Column) -> Column:
        pairs = F.transform(F.slice(parts, 2, F.size(parts)), lambda b, i: rank(F.concat(F.get(parts, i), b)))
        return _let(pairs, lambda ranks: merged(parts, ranks))

    h = F.hex(F.encode(F.coalesce(F.col(word), F.lit("")), "UTF-8"))
    n = (F.length(h) / 2).cast("int")
    parts = F.when(n == 0, F.array().cast("array<string>")).otherwise(
        F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.substring(h, (i * 2 - 1).cast("int"), F.lit(2))))
    folded = F.aggregate(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), parts, step)
    return words.withColumn("ids", F.transform(folded, rank))
