"""Lempel-Ziv phrase fingerprints: likeness of documents as a compressor would see it.

A text's UTF-8 bytes are parsed into dictionary phrases (LZ78: each phrase is the
longest phrase met before, and one byte more).  The set of phrases is hashed, and a
minimum-hash signature of the set is the fingerprint; the share of equal entries in
two signatures estimates the Jaccard similarity of the phrase sets, which is high
where one text helps to compress the other.

``with_next`` pairs each document with the next by doc_id without a global sort in
one task: one range shuffle puts neighbours together, a task runs through its sorted
rows once, and only the rows at the ends of partitions meet in a second, small join.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import cut, from_texts, shuffle_partitions, small_batches
from quarry.llm.words import mix

#: Entries of a signature; each is 16 bits, 4 characters of the fingerprint.
ENTRIES = 128
_MASK = (1 << 64) - 1
_GROW = 0x9E3779B97F4A7C15


class Parser:
    """LZ78 over bytes: a trie in one dictionary, and a hash of each phrase's bytes."""

    __slots__ = ("trie", "hashes", "node")

    def __init__(self):
        self.trie: dict[int, int] = {}
        self.hashes: list[int] = [0]  # of the phrase of each node; 0 is the root
        self.node = 0                 # where the unfinished phrase stands

    def copy(self) -> Parser:
        out = Parser()
        out.trie, out.hashes, out.node = self.trie.copy(), self.hashes.copy(), self.node
        return out

    def feed(self, data: bytes) -> Parser:
        trie, hashes, node = self.trie, self.hashes, self.node
        get, add = trie.get, hashes.append
        for c in data:
            key = node << 8 | c
            there = get(key)
            if there is None:
                trie[key] = len(hashes)
                add((hashes[node] + c + 1) * _GROW & _MASK)
                node = 0
            else:
                node = there
        self.node = node
        return self

    def phrases(self) -> np.ndarray:
        """Hashes of the dictionary's phrases; an unfinished one at the end is among them already."""
        return mix(np.array(self.hashes[1:], np.uint64))


_FACTORS = mix(np.arange(1, ENTRIES + 1, dtype=np.uint64)) | np.uint64(1)
_OFFSETS = mix(np.arange(1, ENTRIES + 1, dtype=np.uint64) + np.uint64(1 << 32))


def signature(phrases: np.ndarray) -> str:
    """Least hash of the set in each entry's own order, 16 bits each, as hexadecimal; all ones for no phrases."""
    least = np.full(ENTRIES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(phrases), 512):
        part = (phrases[at:at + 512, None] ^ _OFFSETS) * _FACTORS
        np.minimum(least, part.min(axis=0), out=least)
    # the low bits of a least product are worn; mix before cutting to 16 bits
    return mix(least).astype(">u2").tobytes().hex() if len(phrases) else "f" * (4 * ENTRIES)


def fingerprint(text: str | None) -> str:
    """Of a whole text; a null text counts as empty."""
    return signature(Parser().feed((text or "").encode("utf-8", "replace")).phrases())


def likeness(a: str, b: str) -> float:
    """Share of equal entries."""
    x, y = (np.frombuffer(bytes.fromhex(s), ">u2") for s in (a, b))
    return float(np.mean(x == y))


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``fingerprint`` in the place of the text; columns of that name are replaced.

    Equal texts have equal fingerprints, null and empty ones the same; other
    columns and repeated rows pass through.
    """
    return from_texts(docs, text, "fingerprint string",
                      lambda: lambda texts: [pa.array([fingerprint(t) for t in texts], pa.string())])


class _Half:
    """A text's fingerprint, and its first part parsed: what its edited form begins with too."""

    def __init__(self, text: str):
        self.text, self.tail = text, len(text) // 2
        self.head = text[:len(text) - self.tail]
        self.start = Parser().feed(self.head.encode("utf-8", "replace"))
        rest = text[len(text) - self.tail:].encode("utf-8", "replace")
        self.fingerprint = signature(self.start.copy().feed(rest).phrases())

    def before(self, next_text: str, next_fingerprint: str) -> tuple:
        """The columns of ``_MADE``; call it once."""
        new = next_text[:self.tail]
        edited = signature(self.start.feed(new.encode("utf-8", "replace")).phrases())
        return (len(self.text), hashlib.sha256((self.head + new).encode("utf-8", "replace")).hexdigest(),
                self.fingerprint, edited, likeness(self.fingerprint, edited), likeness(self.fingerprint, next_fingerprint))


_MADE = {"n_chars": (pa.int64(), "long"), "edited_sha256": (pa.string(), "string"), "fingerprint": (pa.string(), "string"),
         "edited_fingerprint": (pa.string(), "string"), "near_edited": (pa.float64(), "double"),
         "near_next": (pa.float64(), "double")}


def with_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of each row.

    The edited text has the last floor(n_chars / 2) code points replaced by the
    first as many of the next document (all, if it has fewer); next is by
    ascending doc_id (null first; equal ones by text), and after the last comes
    the first.  Null texts count as empty, and two empty fingerprints are alike (1).
    A single document is its own next; repeated rows follow each other; other
    columns are ignored; no rows give no rows.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    dealt = rows.repartitionByRange(shuffle_partitions(spark), "doc_id", F.xxhash64("text")).sortWithinPartitions(
        "doc_id", F.xxhash64("text")).withColumn("part", F.spark_partition_id())
    kind = rows.schema["doc_id"].dataType.simpleString()
    ends = {"part": pa.int32(), "last_text": pa.string(), "first_text": pa.string(), "first_fingerprint": pa.string()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each row once its next has come; the partition's last row as an end, with its text and the first row's."""
        held = first = part = ids_type = None  # held: (doc_id, _Half) of the row that waits

        def rows_of(ids, made, end):
            columns = [pa.array(ids, ids_type)]
            columns += [pa.array([m[i] for m in made], t) for i, (t, _) in enumerate(_MADE.values())]
            columns += [pa.array([end[i]] * len(ids), t) for i, t in enumerate(ends.values())]
            return pa.RecordBatch.from_arrays(columns, ["doc_id", *_MADE, *ends])

        for b in batches:
            ids, made, ids_type = [], [], b.schema.field(0).type
            for doc, t, at in zip(*(c.to_pylist() for c in b.columns)):
                now = _Half(t)
                if held is None:
                    first, part = now, at
                else:
                    ids.append(held[0])
                    made.append(held[1].before(t, now.fingerprint))
                held = (doc, now)
            yield rows_of(ids, made, [None] * len(ends))
        if held is not None:
            yield rows_of([held[0]], [[None] * len(_MADE)], [part, held[1].text, first.text, first.fingerprint])

    declared = ", ".join([f"doc_id {kind}", *[f"{k} {t}" for k, (_, t) in _MADE.items()],
                          "part int, last_text string, first_text string, first_fingerprint string"])
    found = cut(dealt.mapInArrow(run, declared))
    end = found.filter("part is not null").select("doc_id", "part", "last_text", "first_text", "first_fingerprint")
    order = Window.orderBy("part")  # one number for each partition
    following = end.select("part", F.coalesce(F.lead("part").over(order), F.min("part").over(
        order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("after"))
    heads = end.select(F.col("part").alias("after"), F.col("first_text").alias("next_text"),
                       F.col("first_fingerprint").alias("next_fingerprint"))
    pairs = end.select("doc_id", "part", "last_text").join(following, "part").join(heads, "after")

    def finish(batches):
        for b in batches:
            made = [_Half(t).before(n, f) for t, n, f in zip(b["last_text"], b["next_text"], b["next_fingerprint"])]
            out = pd.DataFrame(made, columns=list(_MADE))
            out.insert(0, "doc_key", b["doc_key"].to_numpy())
            yield out

    # the doc_id goes through pandas as text, which keeps nulls and large numbers
    finished = pairs.select(F.col("doc_id").cast("string").alias("doc_key"), "last_text", "next_text", "next_fingerprint")
    finished = finished.mapInPandas(finish, ", ".join(["doc_key string", *[f"{k} {t}" for k, (_, t) in _MADE.items()]]))
    finished = finished.select(F.col("doc_key").cast(kind).alias("doc_id"), *_MADE)
    return found.filter("part is null").select("doc_id", *_MADE).union(finished)
