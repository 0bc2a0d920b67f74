"""Ranked lexical search of all documents for a set of items.

Method: presence masks.  Documents are indexed in blocks by term; for an item, a
block's documents are grouped by the mask of the item's terms that they hold
(bitmaps of the terms, packed and grouped), and the distinct masks are evaluated
by descending maximum score until no other mask can reach the best ones.

The items are the stated query set: their terms are looked up in every document,
a bounded number of terms at a time.  A task gives out ``top`` rows an item at most.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import cut, small_batches

#: (item, term) pairs that one pass over the documents answers; more items are dealt to several passes.
PASS_TERMS = 1 << 19
#: A block of the index ends with the document that brings it to so many documents or words.
BLOCK_DOCS, BLOCK_WORDS = 4096, 1 << 22
#: Bytes that part terms become blanks, A-Z become a-z; bytes of longer code points stay.
TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))

BLOCK = "doc_ids array<long>, sizes array<int>, terms array<int>, ends array<int>, at array<int>, tf array<int>"


def terms_of(text: str | bytes | None) -> list[bytes]:
    """Maximal runs of letters, digits and non-ASCII code points, A-Z in lower case."""
    if text is None:
        return []
    return (text.encode("utf-8", "replace") if isinstance(text, str) else text).translate(TERM_BYTES).split()


def item_terms(items: DataFrame, item: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id, term binary, n): occurrences of each term in an item; equal rows count once, other rows of an item add up."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(i, t, n) for i, s in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) for t, n in Counter(terms_of(s)).items()]
            if rows:
                i, t, n = zip(*rows)
                yield pa.RecordBatch.from_arrays([pa.array(i, b.schema.field(0).type), pa.array(t, pa.binary()), pa.array(n, pa.int64())],
                                                 ["item_id", "term", "n"])

    kind = "string" if dict(items.dtypes)[item] == "string" else "bigint"
    given = items.select(F.col(item).cast(kind).alias("item_id"), F.col(text).alias("text")).filter("item_id IS NOT NULL").distinct()
    return given.mapInArrow(run, f"item_id {kind}, term binary, n long").groupBy("item_id", "term").agg(F.sum("n").alias("n"))


class _Block:
    """Documents read since the last block was given out: of their terms, those asked for."""

    def __init__(self):
        self.doc_ids, self.sizes, self.ids, self.words = [], [], [], 0

    def add(self, doc_id: int | None, text: bytes, numbers: dict[bytes, int]) -> None:
        terms = terms_of(text)
        if not terms:
            return
        self.words += len(terms)
        self.doc_ids.append(doc_id)
        self.sizes.append(len(terms))
        get = numbers.get
        self.ids.append(np.array([n for t in terms if (n := get(t)) is not None], np.int64))

    def batch(self) -> pa.RecordBatch:
        doc = np.repeat(np.arange(len(self.ids), dtype=np.int64), [len(x) for x in self.ids])
        cell, tf = np.unique(np.concatenate(self.ids) << 32 | doc, return_counts=True)
        terms, starts = np.unique(cell >> 32, return_index=True)
        lists = [pa.array(self.doc_ids, pa.int64()), *[pa.array(x, pa.int32()) for x in (
            self.sizes, terms, np.r_[starts[1:], len(cell)][:len(terms)], cell & 0xFFFFFFFF, tf)]]
        return pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in lists],
                                          ["doc_ids", "sizes", "terms", "ends", "at", "tf"])


def index_blocks(docs: DataFrame, numbers: dict[bytes, int], text: str = "text") -> DataFrame:
    """Blocks of all documents that hold any term, with the postings of the terms in ``numbers``.

    A row: ``doc_ids`` and ``sizes`` (terms with repeats) of its documents; the
    terms met, where each one's postings end, and the postings: ``at`` (place
    of the document in the block) and ``tf``.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(numbers)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, block = shared.value, _Block()
        for b in batches:
            for doc_id, s in zip(b.column(0).to_pylist(), pc.fill_null(b.column(1), "").cast(pa.binary())):
                block.add(doc_id, s.as_py(), numbers)
                if len(block.ids) >= BLOCK_DOCS or block.words >= BLOCK_WORDS:
                    yield block.batch()
                    block = _Block()
        if block.ids:
            yield block.batch()

    return docs.select(F.col("doc_id").cast("long"), F.col(text)).mapInArrow(run, BLOCK)


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class _Ranking:
    """The best documents of each item so far, as (-score, doc_id is null, doc_id)."""

    def __init__(self, items: list[tuple], weights: np.ndarray, n_docs: int, n_terms: int, top: int):
        self.items, self.weights, self.n_docs, self.n_terms, self.top = items, weights, n_docs, n_terms, top
        self.best: dict[int, list[tuple]] = {}

    def _lengths(self, sizes: np.ndarray) -> np.ndarray:
        """Each document's m; by Python's integers where 64 bits would overflow."""
        if 75 * int(sizes.max()) * self.n_docs < 1 << 63:
            return 25 + 75 * sizes * self.n_docs // self.n_terms
        return np.array([25 + 75 * n * self.n_docs // self.n_terms for n in sizes.tolist()], np.int64)

    def read(self, doc_ids: list, sizes: np.ndarray, terms: np.ndarray, ends: np.ndarray, at: np.ndarray, tf: np.ndarray) -> None:
        if not len(terms):
            return
        starts = np.r_[0, ends[:-1]]
        gain = 1_000_000_000 * tf // (1000 * tf + 8 * self._lengths(sizes)[at])
        most = np.maximum.reduceat(gain, starts)  # a term's largest gain in this block
        gain = np.r_[0, gain]                     # place 0: the term is absent
        for k, (_, wanted, repeats) in enumerate(self.items):
            place = np.searchsorted(terms, wanted)
            here = place < len(terms)
            here[here] = terms[place[here]] == wanted[here]
            if not here.any():
                continue
            place, worth = place[here], repeats[here] * self.weights[wanted[here]]
            posting = np.zeros((len(place), len(sizes)), np.int32)  # of each term and document, from 1
            for row, p in enumerate(place.tolist()):
                s, e = starts[p], ends[p]
                posting[row, at[s:e]] = np.arange(s + 1, e + 1)
            self._masks(k, posting, worth, worth * most[place], gain, doc_ids)

    def _masks(self, k: int, posting: np.ndarray, worth: np.ndarray, bound: np.ndarray, gain: np.ndarray, doc_ids: list) -> None:
        """Group the documents by mask and evaluate the masks by descending bound."""
        bits = np.packbits(posting > 0, axis=0)
        wide = np.zeros((posting.shape[1], -(-len(bits) // 8) * 8), np.uint8)
        wide[:, :len(bits)] = bits.T
        keys = wide.view(np.uint64)[:, 0] if wide.shape[1] == 8 else wide.view(f"V{wide.shape[1]}")[:, 0]
        _, first, group, size = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
        most = (posting[:, first] > 0).T.astype(np.int64) @ bound  # no document of a mask scores more
        order = np.argsort(-most, kind="stable")
        members, starts = np.argsort(group, kind="stable"), np.r_[0, np.cumsum(size)]
        best, done, step = self.best.get(k, []), 0, 4
        while done < len(order):
            least = -best[-1][0] if len(best) == self.top else 0
            taken = order[done:done + step]
            taken = taken[(most[taken] >= least) & (most[taken] > 0)]  # equal scores are decided by doc_id
            if not len(taken):
                break
            docs = np.concatenate([members[starts[g]:starts[g + 1]] for g in taken.tolist()])
            score = (gain[posting[:, docs]] * worth[:, None]).sum(axis=0)
            keep = (score > 0) & (score >= least)
            found = [(-s, doc_ids[d] is None, doc_ids[d] or 0) for s, d in zip(score[keep].tolist(), docs[keep].tolist())]
            best = sorted([*best, *found])[:self.top]
            done, step = done + step, step * 2
        if best:
            self.best[k] = best

    def rows(self) -> list[tuple]:
        return [(self.items[k][0], None if none else d, -s) for k, best in self.best.items() for s, none, d in best]


def _pass(docs: DataFrame, asked: DataFrame, top: int, text: str) -> DataFrame:
    """The best documents of the items in ``asked`` (at most some PASS_TERMS rows, taken to the driver)."""
    kind = asked.schema["item_id"].dataType.simpleString()
    rows = asked.collect()
    numbers = {t: k for k, t in enumerate(sorted({bytes(r["term"]) for r in rows}))}
    blocks = cut(index_blocks(docs, numbers, text))
    total = blocks.agg(F.sum(F.size("doc_ids").cast("long")).alias("docs"),
                       F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x)).alias("terms")).first()
    held = F.transform("terms", lambda t, i: F.struct(
        t.alias("term"), (F.get("ends", i) - F.coalesce(F.get("ends", i - 1), F.lit(0))).alias("n")))
    df = blocks.select(F.explode(held).alias("t")).select("t.*").groupBy("term").agg(F.sum("n").alias("n")).collect()
    weights = np.zeros(len(numbers) + 1, np.int64)
    for r in df:
        weights[r["term"]] = weight(total["docs"], r["n"])
    by_item: dict = {}
    for r in rows:
        by_item.setdefault(r["item_id"], []).append((numbers[bytes(r["term"])], r["n"]))
    items = [(i, *np.array(sorted(t), np.int64).T) for i, t in sorted(by_item.items())]
    shared = docs.sparkSession.sparkContext.broadcast((items, weights, total["docs"] or 0, total["terms"] or 0, top))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranking = _Ranking(*shared.value)
        for b in batches:
            for row in range(b.num_rows):
                ids, *rest = (c[row].values for c in b.columns)
                ranking.read(ids.to_pylist(), *[x.to_numpy(zero_copy_only=False).astype(np.int64) for x in rest])
        found = ranking.rows()
        if found:
            i, d, s = zip(*found)
            yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(d, pa.int64()), pa.array(s, pa.int64())], ["item_id", "doc_id", "score"])

    return blocks.mapInArrow(run, f"item_id {kind}, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, top: int = 10, text: str = "text") -> DataFrame:
    """The ``top`` documents of each item: (item_id, rank int from 1, doc_id, score long).

    Scores above 0 only, equal scores by ascending doc_id.  A null text has no
    terms and is never found; an item without terms, or that nothing matches,
    has no rows; a null doc_id comes last among equal scores, and repeated rows
    are ranked each.  Rows of one item_id are one item (equal rows count once),
    a null item_id is none.  Further columns are not read.
    """
    asked = cut(item_terms(items))
    passes = max(1, math.ceil(asked.count() / PASS_TERMS))
    found = None
    for p in range(passes):
        one = _pass(docs, asked.filter(F.pmod(F.xxhash64("item_id"), F.lit(passes)) == p), top, text)
        found = one if found is None else found.unionByName(one)
    order = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
            .select("item_id", "rank", "doc_id", "score"))
