"""Near-duplicate documents by SetSketch registers over word shingles.

Method (Ertl, "SetSketch: filling the gap between MinHash and HyperLogLog", 2021):
register i of a set is the truncated logarithm, floor(1 - log_b(min of exponential
hashes)), so registers of unions are maxima (mergeable), and two sets share a
register with a chance near their Jaccard similarity (locality-sensitive).  Runs of
``rows`` registers form ``bands`` keys; documents that share a key are candidates;
a joint likelihood over the registers drops the hopeless; full shingle sets confirm.

Steps, all on Spark:

1. One pass over the texts gives each document's set size, a 128-bit digest of its
   set and its registers.  Equal sets collapse to one class (a grouped minimum,
   combined before the shuffle), so groups of copies of any size cost one row.
2. Candidates in two rounds.  First each class is paired with the least class (hub)
   of each of its bands and the confirmed pairs are joined into components; a band
   whose members are all in one component then needs nothing more.  Second, the
   members of each other band meet with their full sets, block by block, where
   products of incidence matrices compare all of them.  So a big group of near
   copies gives rows in proportion to its size, not to the square.
3. Confirmation of the first round joins the full sets of the classes that are
   candidates; nothing is linked otherwise.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import cut, from_texts, shuffle_partitions, tidy
from quarry.llm.components import components
from quarry.llm.words import WordHashes, mix, shingles, split_words

#: Base of the register scale and largest register: sets of up to 1e18 shingles fit 16 bits.
BASE, TOP = 1.001, 65535
#: Rate of the exponential hashes (registers of small sets stay above zero).
RATE = 20.0
#: A pair is dropped before confirmation when the registers make the threshold e^-40 times as likely as the best estimate.
HOPELESS = 40.0
#: Members of a band in one block of the search inside bands, on average at most.
BAND_BLOCK = 256


@dataclass(frozen=True)
class Bands:
    """``bands`` keys of ``rows`` registers each."""

    bands: int
    rows: int

    @property
    def registers(self) -> int:
        return self.bands * self.rows

    @staticmethod
    def for_threshold(similarity: float, missed: float = 1e-6, registers: int = 180) -> Bands:
        """The longest rows for which a pair at the threshold is missed with a chance of at most ``missed``."""
        for rows in range(12, 0, -1):
            bands = registers // rows
            if (1 - similarity ** rows) ** bands <= missed:
                return Bands(bands, rows)
        return Bands(int(np.ceil(np.log(missed) / np.log(max(1e-9, 1 - similarity)))), 1)


def _multipliers(m: int) -> tuple[np.ndarray, np.ndarray]:
    seeds = mix(np.arange(1, 2 * m + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return seeds[:m] | np.uint64(1), seeds[m:]


def sketch(hashes: np.ndarray, factors: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Registers of a set of element hashes: least exponential of each register's own hash, on the log scale."""
    least = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 512):
        part = (hashes[at:at + 512, None] ^ offsets[None, :]) * factors[None, :]
        np.minimum(least, part.min(axis=0), out=least)
    u = (least.astype(np.float64) + 0.5) / 2.0 ** 64
    exponential = -np.log1p(-np.minimum(u, 1 - 1e-16)) / RATE
    return np.clip(np.floor(1 - np.log(exponential) / np.log(BASE)), 0, TOP).astype("<u2")


def set_key(items: np.ndarray) -> bytes:
    """128-bit digest of a set."""
    return hashlib.blake2b(items.tobytes(), digest_size=16).digest()


def sketches(docs: DataFrame, k: int, registers: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, set_key, registers) of each row; no key for an empty set."""
    factors, offsets = _multipliers(registers)

    def start():
        words = WordHashes()

        def made(texts):
            sets = [shingles(split_words(t), k, words) for t in texts]
            return [pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([set_key(s) if len(s) else None for s in sets], pa.binary()),
                    pa.array([sketch(s, factors, offsets).tobytes() if len(s) else None for s in sets], pa.binary())]
        return made

    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return from_texts(docs, "text", "n_shingles long, set_key binary, registers binary", start)


def joint_estimate(x: np.ndarray, y: np.ndarray, nx: np.ndarray, ny: np.ndarray,
                   at: float) -> tuple[np.ndarray, np.ndarray]:
    """Most likely Jaccard similarity of each row pair of registers, and how much less likely ``at`` is (log).

    With shares u, v of the set sizes, a register of x exceeds y's with chance
    p(u - vJ), where p(z) = -log_b(1 - z (b - 1) / b), and the other way round.
    """
    u = nx / (nx + ny)
    v = 1 - u
    above, below = (x > y).sum(axis=1), (x < y).sum(axis=1)
    same = x.shape[1] - above - below

    def chance(z):
        return np.maximum(-np.log1p(-np.maximum(z, 0) * (BASE - 1) / BASE) / np.log(BASE), 1e-12)

    def likely(j):
        p, q = chance(u - v * j), chance(v - u * j)
        return above * np.log(p) + below * np.log(q) + same * np.log(np.maximum(1 - p - q, 1e-12))

    top = np.minimum(u / v, v / u)
    low, high = np.zeros_like(top), top.copy()
    for _ in range(40):  # the likelihood has one peak
        a, b = low + (high - low) / 3, high - (high - low) / 3
        up = likely(a) < likely(b)
        low, high = np.where(up, a, low), np.where(up, high, b)
    best = (low + high) / 2
    return best, likely(best) - likely(np.minimum(at, top))


def _likely_pairs(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of classes that their registers don't rule out."""
    side = lambda s: classes.select(F.col("set_key").alias(s), F.col("n").alias(f"n{s}"),
                                    F.col("registers").alias(f"r{s}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")

    def run(batches):
        for p in batches:
            if len(p):
                x, y = (np.frombuffer(b"".join(p[c]), "<u2").reshape(len(p), -1) for c in ("ra", "rb"))
                best, loss = joint_estimate(x, y, p["na"].to_numpy(float), p["nb"].to_numpy(float), percent / 100)
                p = p[(best >= percent / 100) | (loss < HOPELESS)]
            yield p[["a", "b"]]

    return both.select("a", "b", "na", "nb", "ra", "rb").mapInPandas(tidy(run), "a binary, b binary")


def _full_sets(docs: DataFrame, found: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """(set_key, items) of the classes in the one column of ``wanted``, from the text of one document of each.

    Documents without a doc_id can't be fetched by it: their texts are all read, without a join.
    """
    wanted = wanted.toDF("set_key").distinct()
    some = (found.filter("set_key is not null").join(wanted, "set_key", "left_semi")
            .groupBy("set_key").agg(F.min("doc_id").alias("doc_id")).select("doc_id").distinct())

    def start():
        words = WordHashes()

        def made(texts):
            sets = [shingles(split_words(t), k, words) for t in texts]
            return [pa.array([set_key(s) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())]
        return made

    texts = docs.join(some, "doc_id", "left_semi").select("text").union(docs.filter("doc_id is null").select("text"))
    sets = from_texts(texts, "text", "set_key binary, items binary", start)
    return sets.join(wanted, "set_key", "left_semi").dropDuplicates(["set_key"])


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets reach the threshold: 100 * intersection >= percent * union."""
    side = lambda s: sets.select(F.col("set_key").alias(s), F.col("items").alias(f"i{s}"))

    def run(batches):
        for p in batches:
            good = []
            for x, y in zip(p["ia"], p["ib"]):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * both >= percent * (len(x) + len(y) - both))
            yield p.loc[np.array(good, bool), ["a", "b"]]

    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "ia", "ib").mapInPandas(
        tidy(run), "a binary, b binary")


def _linked_within(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """The least member, by place, that links reach among ``sets``; exact, by products of incidence blocks."""
    n = np.array([len(x) for x in sets])
    owner = np.repeat(np.arange(len(sets)), n)
    items = np.concatenate(sets)
    order = np.argsort(items, kind="stable")
    items, owner = items[order], owner[order]
    new = np.r_[True, items[1:] != items[:-1]]
    column = np.cumsum(new) - 1
    often = np.bincount(column) > 1            # the others meet nobody
    column, owner = (np.cumsum(often) - 1)[column[often[column]]], owner[often[column]]
    both = np.zeros((len(sets), len(sets)), np.float32)
    for at in range(0, int(often.sum()), 2048):
        a, z = np.searchsorted(column, [at, at + 2048])
        part = np.zeros((len(sets), 2048), np.float32)
        part[owner[a:z], column[a:z] - at] = 1
        both += part @ part.T
    linked = 100 * both.astype(np.int64) >= percent * (n[:, None] + n - both.astype(np.int64))
    root = np.arange(len(sets))
    while True:
        least = np.where(linked, root[None, :], len(sets)).min(axis=1)
        least = np.minimum(root, least)[np.minimum(root, least)]
        if (least == root).all():
            return root
        root = least


def _links_within(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a forest of them) among the ``members`` (band, a) of each band.

    Bands with the same members count once.  A band is dealt into blocks by a
    hash, and each pair of its blocks is one bounded piece of work, so a big band
    is spread over many tasks and gives a row for each member, not for each pair.
    """
    spark = members.sparkSession
    same = members.groupBy("band").agg(F.count(F.lit(1)).alias("size"), F.bit_xor(F.xxhash64("a")).alias("x"),
                                       F.bit_xor(F.xxhash64(F.lit(1), "a")).alias("y"))
    kept = same.groupBy("size", "x", "y").agg(F.min("band").alias("band")).filter("size > 1").select(
        "band", F.ceil(F.col("size") / BAND_BLOCK).cast("int").alias("blocks"))
    dealt = members.join(kept, "band").withColumn("own", F.pmod(F.hash("a"), F.col("blocks"))).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("band", "a", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"))
    rows = dealt.join(sets.withColumnsRenamed({"set_key": "a"}), "a").select("band", "p", "q", "a", "items")
    group = ["band", "p", "q"]

    def run(batches):
        now, keys, sets = None, [], []

        def ended() -> pd.DataFrame:
            root = _linked_within(sets, percent)
            hit = np.flatnonzero(root != np.arange(len(sets)))
            return pd.DataFrame({"a": [keys[i] for i in hit], "b": [keys[root[i]] for i in hit]})

        for b in batches:
            for band, p, q, key, items in zip(*(b[c] for c in b.columns)):
                if (band, p, q) != now:
                    if len(sets) > 1:
                        yield ended()
                    now, keys, sets = (band, p, q), [], []
                keys.append(key)
                sets.append(np.frombuffer(items, np.uint64))
        if len(sets) > 1:
            yield ended()

    return (rows.repartition(shuffle_partitions(spark), *group).sortWithinPartitions(*group)
            .mapInPandas(tidy(run), "a binary, b binary"))


def _band_keys(bands: Bands) -> Column:
    width = 2 * bands.rows
    return F.array(*[F.xxhash64(F.lit(j), F.substring("registers", j * width + 1, width)) for j in range(bands.bands)])


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, bands: Bands | None = None,
                    doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``.

    A document's set holds its distinct shingles of ``k`` words, or its whole
    word sequence where that is shorter; documents with
    100 * intersection >= ``percent`` * union are linked.  ``component_id`` is the
    smallest doc_id that links reach, ``kept`` marks that document.  Null, empty
    or blank texts have empty sets and link with nothing.  Rows with one doc_id
    and text (repeated rows) are all in one component and kept alike; other
    columns are ignored; no rows give no rows.  Rows without a doc_id link like
    others, and a component of such rows only has none and keeps them all.  A pair at the threshold goes
    unseen with a chance of 1e-6 at most (``Bands.for_threshold``); nothing that
    isn't confirmed on full sets is linked.
    """
    bands = bands or Bands.for_threshold(percent / 100)
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    found = cut(sketches(docs, k, bands.registers))
    classes = (found.filter("set_key is not null").groupBy("set_key")
               .agg(F.first("n_shingles").alias("n"), F.first("registers").alias("registers")))
    classes = cut(classes)
    banded = cut(classes.select("set_key", "n", F.explode(_band_keys(bands)).alias("band")))

    def near_in_size(pairs: DataFrame) -> DataFrame:
        return pairs.filter(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")).select("a", "b").distinct()

    hubs = banded.groupBy("band").agg(F.min(F.struct("set_key", "n")).alias("hub"), F.count(F.lit(1)).alias("size"))
    hubs = cut(hubs.filter("size > 1").select("band", F.col("hub.set_key").alias("b"), F.col("hub.n").alias("nb")))
    shared = cut(banded.join(hubs, "band").select("band", F.col("set_key").alias("a"), F.col("n").alias("na"), "b", "nb"))
    pairs = cut(_likely_pairs(near_in_size(shared.filter("a <> b")), classes, percent))
    both = pairs.select("a").union(pairs.select("b"))
    links = cut(_confirmed(pairs, _full_sets(docs, found, both, k), percent))

    first = cut(components(links))
    of = first.select(F.col("node").alias("a"), F.col("component").alias("ca"))
    placed = shared.join(of, "a", "left").select("band", "a", "na", "b", F.coalesce("ca", "a").alias("ca"))
    mixed = placed.groupBy("band").agg(F.min("ca").alias("low"), F.max("ca").alias("high")).filter("low <> high")
    rest = cut(placed.join(mixed.select("band"), "band", "left_semi").filter("a <> b").select("band", "a"))
    links = links.union(_links_within(rest, _full_sets(docs, found, rest.select("a"), k), percent))

    joined = components(links).withColumnsRenamed({"node": "set_key"})
    ids = found.filter("set_key is not null").groupBy("set_key").agg(F.min("doc_id").alias("low"))
    named = ids.join(joined, "set_key", "left").withColumn("component", F.coalesce("component", "set_key"))
    named = cut(named)
    least = named.groupBy("component").agg(F.min("low").alias("component_id"))
    # one row for each class that is linked or has copies; all other documents stand alone
    named = cut(named.join(least, "component").select("set_key", "component_id"))
    out = found.drop("registers").join(named, "set_key", "left")
    out = out.withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
