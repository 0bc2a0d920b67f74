"""How a chain of filters interacts: what each one removes in every order.

Method: a sparse document-term matrix.  Each task writes its documents as CSR
shards over a dictionary of its own; the shards' dictionaries are merged into a
global one, and the columns are renumbered by it.  Row sums and counts of
nonzeros of the matrix decide the filters on words; flags of other kinds are
attached to the rows, and the patterns of flags are counted.

Only (shard, distinct word) pairs are shuffled by word, never occurrences.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import cut, small_batches

#: A shard ends with the document that brings it to so many words; a longer text is a shard of its own.
SHARD_WORDS = 1 << 20
FILTERS = "ABCDE"
CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
MARKS = b"#$%&*|"

SHARD = ("shard long, docs array<struct<doc_id: long, part: string, chars: long, capitals: long, marked: boolean, digest: binary>>, "
         "row_ends array<int>, terms array<int>, counts array<int>, words array<binary>")


class _Places(dict):
    """The place of each word in the order of first sight."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def _lists(values: pa.Array, ends: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), values)


class _Shard:
    """The documents read since the last shard was given out."""

    def __init__(self):
        self.places, self.ids, self.heads, self.facts, self.n_words = _Places(), [], [], [], 0

    def add(self, head: tuple, text: bytes) -> None:
        words = text.split()  # bytes: parted at 20 and 09-0D only
        self.ids.append(np.fromiter(map(self.places.__getitem__, words), np.int32, len(words)))
        self.heads.append(head)
        self.facts.append((len(text) - len(text.translate(None, CAPITALS)), len(text) != len(text.translate(None, MARKS)),
                           hashlib.sha256(text).digest()))
        self.n_words += len(words)

    def batch(self, number: int) -> pa.RecordBatch:
        n = len(self.ids)
        doc = np.repeat(np.arange(n, dtype=np.int64), [len(x) for x in self.ids])
        cell, counts = np.unique(doc << 32 | np.concatenate(self.ids), return_counts=True)
        ends = np.searchsorted(cell, np.arange(1, n + 1, dtype=np.int64) << 32)
        doc_id, part, chars = zip(*self.heads)
        capitals, marked, digest = zip(*self.facts)
        docs = pa.StructArray.from_arrays(
            [pa.array(doc_id, pa.int64()), pa.array(part, pa.string()), pa.array(chars, pa.int64()), pa.array(capitals, pa.int64()),
             pa.array(marked, pa.bool_()), pa.array(digest, pa.binary())],
            ["doc_id", "part", "chars", "capitals", "marked", "digest"])
        one = lambda values: _lists(values, np.array([len(values)]))
        return pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int64()), one(docs), one(pa.array(ends, pa.int32())), one(pa.array(cell & 0xFFFFFFFF, pa.int32())),
             one(pa.array(counts, pa.int32())), one(pa.array(list(self.places), pa.binary()))],
            ["shard", "docs", "row_ends", "terms", "counts", "words"])


def _local_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    number, shard = TaskContext.get().partitionId() << 32, _Shard()
    for b in batches:
        texts = pc.fill_null(b.column(2), "")
        chars = pc.utf8_length(texts).to_pylist()
        for head, text in zip(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), chars), texts.cast(pa.binary())):
            shard.add(head, text.as_py())
            if shard.n_words >= SHARD_WORDS:
                yield shard.batch(number)
                number, shard = number + 1, _Shard()
    if shard.ids:
        yield shard.batch(number)


def term_matrix(docs: DataFrame, text: str = "text", part: str = "lang") -> tuple[DataFrame, DataFrame]:
    """(matrix, dictionary) of the documents' words, both over all documents.

    ``dictionary``: ``word binary, term long``, gapless from 0.  ``matrix``: a
    CSR shard a row, with ``docs`` (doc_id, part and facts of each text),
    ``row_ends array<int>``, ``terms array<long>`` (numbers of the dictionary)
    and ``counts array<int>``.  Words are runs of bytes outside
    ``[\\x20\\x09-\\x0D]``.  A null text counts as empty and has an empty row;
    repeated rows stay; an empty table gives empty tables.  The matrix is a plan:
    whoever reads only its row sums doesn't pay for the renumbered columns.
    """
    small_batches(docs.sparkSession)
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(part), F.lit("")).alias("part"),
                        F.col(text).alias("text"))
    local = cut(given.mapInArrow(_local_shards, SHARD))
    dictionary = _numbered(local.select(F.explode("words").alias("word")).distinct())
    places = local.select("shard", F.posexplode("words").alias("place", "word"))
    codes = (places.join(dictionary, "word").groupBy("shard")
             .agg(F.sort_array(F.collect_list(F.struct("place", "term")))["term"].alias("codes")))
    matrix = local.drop("words").join(codes.hint("shuffle_hash"), "shard", "left")
    return matrix.withColumn("terms", F.transform("terms", lambda t: F.get("codes", t))).drop("codes"), dictionary


def _numbered(words: DataFrame) -> DataFrame:
    """``words`` with gapless numbers: places within partitions, and one small row of counts for each."""
    at = F.col("at")
    placed = cut(words.withColumn("at", F.monotonically_increasing_id())).select(
        "word", F.shiftright(at, 33).alias("block"), at.bitwiseAND(F.lit(2 ** 33 - 1)).alias("at"))
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    bases = (placed.groupBy("block").agg(F.count(F.lit(1)).alias("n"))
             .select("block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")))
    return placed.join(F.broadcast(bases), "block").select("word", (F.col("base") + F.col("at")).alias("term"))


def row_totals(matrix: DataFrame) -> DataFrame:
    """One row per document: its facts, ``words long`` (the row's sum) and ``distinct_words long`` (its nonzeros)."""
    def row(i):
        start = F.when(i == 0, F.lit(0)).otherwise(F.get("row_ends", i - 1))
        n = F.get("row_ends", i) - start
        total = F.aggregate(F.slice("counts", start + 1, n), F.lit(0).cast("long"), lambda a, x: a + x)
        return F.struct(F.get("docs", i).alias("doc"), total.alias("words"), n.cast("long").alias("distinct_words"))

    rows = F.transform(F.sequence(F.lit(0), F.size("docs") - 1), row)
    return matrix.select(F.explode(rows).alias("row")).select("row.doc.*", "row.words", "row.distinct_words")


def orders() -> list[tuple[str, int, int, int]]:
    """(order, step, mask of the filters applied before, bit of the filter itself)."""
    bit = {f: 1 << k for k, f in enumerate(FILTERS)}
    return [(order, s + 1, sum(bit[f] for f in order[:s]), bit[order[s]])
            for order in map("".join, permutations(FILTERS)) for s in range(len(FILTERS))]


def patterns(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents by (part, ``failed``: the mask of failing filters): ``n``, ``good`` and ``toxic`` among them."""
    rows = row_totals(term_matrix(docs)[0])
    failing = {"A": F.col("words") < 200, "B": 100 * F.col("distinct_words") < 50 * F.col("words"),
               "C": 100 * F.col("capitals") > 3 * F.col("chars"), "D": F.col("marked")}
    failed = sum(F.when(fails, F.lit(1 << FILTERS.index(f))).otherwise(F.lit(0)) for f, fails in failing.items())
    rows = cut(rows.select("doc_id", "part", "digest", failed.alias("failed")))
    # the first of equal texts is known by (digest, doc_id), so no group of copies meets in one task
    firsts = rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).filter("doc_id IS NOT NULL").withColumn("first", F.lit(True))
    copies = F.when(F.col("doc_id").isNotNull() & F.col("first").isNull(), F.lit(1 << FILTERS.index("E"))).otherwise(F.lit(0))
    own = (rows.groupBy("doc_id", "part", "digest", "failed").agg(F.count(F.lit(1)).alias("n"))
           .join(firsts, ["digest", "doc_id"], "left").withColumn("failed", F.col("failed") + copies)
           .groupBy("doc_id", "part", "failed").agg(F.sum("n").alias("n")))
    known = labels.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max(F.when(F.col("quality") == 1, 1)).alias("good"), F.max(F.when(F.col("toxic") == 1, 1)).alias("toxic"))
    return own.join(known, "doc_id", "left").groupBy("part", "failed").agg(
        F.sum("n").alias("n"), F.sum(F.coalesce(F.col("good") * F.col("n"), F.lit(0))).alias("good"),
        F.sum(F.coalesce(F.col("toxic") * F.col("n"), F.lit(0))).alias("toxic"))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """What each filter does at each step of all 120 orders of ABCDE, per value of ``lang``.

    ``docs`` needs doc_id, lang and text, ``labels`` doc_id, quality and toxic;
    further columns are not read.  A fails texts under 200 words, B those whose
    distinct words are under half of them, C those with over 3 % of capitals
    A-Z, D those that hold one of ``#$%&*|``, E those equal to the text of a
    smaller doc_id anywhere.

    Columns: ``part`` (a null lang: empty string), ``filter_order``, ``step``
    (1 to 5), and counts of documents: ``kept`` after the step, ``removed`` in
    it, ``redundant`` (fail its filter but went before), ``unique_fails`` (fail
    its filter only), ``good_lost`` and ``toxic_lost`` (removed here, labelled
    so by any row of ``labels``) and ``shapley``, what its filter removes summed
    over all orders.  A null text is empty; a null doc_id is never a copy and
    has no label; rows of one doc_id and text aren't copies of each other; an
    empty table has no parts, so no rows.
    """
    bits = F.col("failed")
    plan = F.array(*[F.struct(F.lit(order).alias("filter_order"), F.lit(step).alias("step"), F.lit(before).alias("before"),
                              F.lit(own).alias("own")) for order, step, before, own in orders()])
    rows = (patterns(docs, labels).withColumn("at", F.explode(plan))
            .select("part", "failed", "n", "good", "toxic", "at.*"))
    gone, fails = bits.bitwiseAND(F.col("before")) != 0, bits.bitwiseAND(F.col("own")) != 0
    here = fails & ~gone
    share = F.lit(120).cast("long") / F.bit_count(bits)  # orders in which one of so many failing filters comes first

    def total(condition, value="n"):
        return F.sum(F.when(condition, F.col(value)).otherwise(F.lit(0))).cast("long")

    return rows.groupBy("part", "filter_order", "step").agg(
        total(~gone & ~fails).alias("kept"), total(here).alias("removed"), total(fails & gone).alias("redundant"),
        total(bits == F.col("own")).alias("unique_fails"), total(here, "good").alias("good_lost"),
        total(here, "toxic").alias("toxic_lost"),
        F.sum(F.when(fails, F.col("n") * share.cast("long")).otherwise(F.lit(0))).cast("long").alias("shapley"))
