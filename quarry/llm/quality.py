"""Quality classifier: random-indexing word vectors, pooled, into a two-layer network.

Word vectors (random indexing): each word has a fixed sparse ternary index vector,
and its word vector is the sum of the index vectors of its neighbours, up to
``WINDOW`` words to either side, over all documents.  Words are hashed to
``BUCKETS`` rows, so the table has one size whatever the corpus, and the sums are
whole numbers, so they don't hang on the order of tasks.

A document is the mean and the spread of its words' unit vectors and the logarithm
of its length.  A network of one hidden and one output layer, in numpy on the
driver, learns from a bounded sample of labelled rows; a temperature fitted on rows
that it has not learned from calibrates its probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import from_texts, shuffle_partitions, small_batches, tidy
from quarry.llm.words import WordHashes, mix

BUCKETS, DIMS, NONZERO, WINDOW = 32_768, 32, 4, 2
#: Rows of the vector table that travel together, and partial sums that meet first.
BLOCK, SALTS = 256, 16
#: Labelled documents that the network learns from at most, those of least hash.
LEARNED_ROWS = 20_000
#: Words whose sums are taken at once in a task.
CHUNK = 65_536


def _index_vectors() -> np.ndarray:
    """A ternary row for each bucket: ``NONZERO`` places of +1 or -1 drawn by hash."""
    out = np.zeros((BUCKETS, DIMS), np.int8)
    rows = np.arange(BUCKETS, dtype=np.uint64)
    for k in range(NONZERO):
        h = mix(rows * np.uint64(NONZERO) + np.uint64(k + 1))
        out[rows.astype(np.int64), (h % np.uint64(DIMS)).astype(np.int64)] = np.where(h >> np.uint64(63), 1, -1)
    return out


def _buckets(text: str | None, hashes: WordHashes) -> np.ndarray:
    words = text.encode("utf-8", "replace").split() if text else []
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    return (h >> np.uint64(32)).astype(np.int64) % BUCKETS


def _pieces(words: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """A document's words in bounded pieces, each with its neighbours beyond; and which of them count here."""
    for at in range(0, len(words), CHUNK):
        low, high = max(0, at - WINDOW), at + CHUNK + WINDOW
        piece = words[low:high]
        place = np.arange(low, low + len(piece))
        yield piece, (place >= at) & (place < at + CHUNK)


def _add_neighbours(total: np.ndarray, pieces: list[tuple[np.ndarray, np.ndarray]], index: np.ndarray) -> None:
    """Add to each word's row the index vectors of its neighbours; pieces don't touch."""
    gap, no = np.full(WINDOW, BUCKETS), np.zeros(WINDOW, bool)  # rows of zeros between pieces
    w = np.concatenate([x for p, _ in pieces for x in (p, gap)])
    counted = np.concatenate([x for _, c in pieces for x in (c, no)])
    rows = index[w].astype(np.int16)
    near = np.zeros_like(rows)
    for s in range(1, WINDOW + 1):
        near[s:] += rows[:-s]
        near[:-s] += rows[s:]
    w, near = w[counted], near[counted]
    order = np.argsort(w, kind="stable")
    w = w[order]
    starts = np.flatnonzero(np.r_[True, w[1:] != w[:-1]])
    total[w[starts]] += np.add.reduceat(near[order], starts, axis=0, dtype=np.int64)


def word_vectors(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Unit word vectors, (BUCKETS + 1) x DIMS, from all texts; the last row, of no word, is zero."""
    spark = docs.sparkSession
    small_batches(spark)

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        index = np.vstack([_index_vectors(), np.zeros((1, DIMS), np.int8)])
        total = np.zeros((BUCKETS, DIMS), np.int64)
        held, n = [], 0
        salt = TaskContext.get().partitionId() % SALTS
        for b in batches:
            for t in b["text"]:
                for piece in _pieces(_buckets(t, hashes)):
                    held.append(piece)
                    n += len(piece[0])
                    if n >= CHUNK:
                        _add_neighbours(total, held, index)
                        held, n = [], 0
        if held:
            _add_neighbours(total, held, index)
        for k in range(0, BUCKETS, BLOCK):
            part = total[k:k + BLOCK]
            if part.any():
                kind = np.int32 if np.abs(part).max() < 2 ** 31 else np.int64
                yield pd.DataFrame({"block": [k // BLOCK], "salt": [salt], "wide": [kind is np.int64],
                                    "sums": [part.astype(kind).tobytes()]})

    def summed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals: dict[int, np.ndarray] = {}
        for b in batches:
            for k, wide, x in zip(b["block"], b["wide"], b["sums"]):
                part = np.frombuffer(x, np.int64 if wide else np.int32)
                totals[k] = totals[k] + part if k in totals else part.astype(np.int64)
        for k, x in totals.items():
            yield pd.DataFrame({"block": [k], "salt": [0], "wide": [True], "sums": [x.tobytes()]})

    schema = "block int, salt int, wide boolean, sums binary"
    parts = docs.select(F.col(text).alias("text")).mapInPandas(tidy(partial), schema)
    n = shuffle_partitions(spark)
    parts = parts.repartition(n, "block", "salt").mapInPandas(tidy(summed), schema)
    parts = parts.repartition(min(n, BUCKETS // BLOCK), "block").mapInPandas(tidy(summed), schema)
    total = np.zeros((BUCKETS + 1, DIMS))
    for r in parts.select("block", "sums").toLocalIterator():  # BUCKETS x DIMS numbers, whatever the corpus
        total[r.block * BLOCK:(r.block + 1) * BLOCK] = np.frombuffer(r.sums, np.int64).reshape(-1, DIMS)
    size = np.linalg.norm(total, axis=1, keepdims=True)
    return (total / np.where(size > 0, size, 1)).astype(np.float32)


def pooled(words: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Mean and spread of a document's word vectors, and the logarithm of its length; zeros for no words."""
    out = np.zeros(2 * DIMS + 1, np.float32)
    n = len(words)
    if n:
        # whole texts, in bounded steps
        s, q = np.zeros(DIMS), np.zeros(DIMS)
        for at in range(0, n, CHUNK):
            v = vectors[words[at:at + CHUNK]]
            s += v.sum(axis=0, dtype=np.float64)
            q += np.square(v).sum(axis=0, dtype=np.float64)
        mean = s / n
        out[:DIMS], out[DIMS:-1] = mean, np.sqrt(np.maximum(q / n - mean * mean, 0))
        out[-1] = np.log1p(n)
    return out


@dataclass
class Network:
    """Two layers over standardised inputs; ``temperature`` divides the output before the logistic."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def raw(self, x: np.ndarray) -> np.ndarray:
        h = np.maximum(((x - self.mean) / self.scale) @ self.w1 + self.b1, 0)
        return h @ self.w2 + self.b2

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x) / self.temperature, -40, 40)))


def train(x: np.ndarray, y: np.ndarray, hidden: int = 32, rounds: int = 60, batch: int = 128, rate: float = 3e-3,
          decay: float = 1e-4, seed: int = 11) -> Network | None:
    """Fit on nine tenths of the rows, the temperature on the rest; none if a label is missing."""
    if len(np.unique(y)) < 2:
        return None
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(x))
    kept = max(1, len(x) // 10)
    tune, fit = order[:kept], order[kept:]
    if len(np.unique(y[fit])) < 2:
        fit = order
    mean, scale = x[fit].mean(axis=0), x[fit].std(axis=0)
    z, t = (x - mean) / np.where(scale > 1e-9, scale, 1), y.astype(float)
    d = x.shape[1]
    p = [rng.normal(0, np.sqrt(2 / d), (d, hidden)), np.zeros(hidden), rng.normal(0, np.sqrt(1 / hidden), hidden), np.zeros(1)]
    m, v = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p]
    step = 0
    for _ in range(rounds):
        rows = rng.permutation(fit)
        for at in range(0, len(rows), batch):
            i = rows[at:at + batch]
            a = z[i] @ p[0] + p[1]
            h = np.maximum(a, 0)
            g = (1 / (1 + np.exp(-np.clip(h @ p[2] + p[3][0], -40, 40))) - t[i]) / len(i)
            back = np.outer(g, p[2]) * (a > 0)
            grads = [z[i].T @ back + decay * p[0], back.sum(axis=0), h.T @ g + decay * p[2], np.array([g.sum()])]
            step += 1
            for k, gk in enumerate(grads):
                m[k] = 0.9 * m[k] + 0.1 * gk
                v[k] = 0.999 * v[k] + 0.001 * gk * gk
                p[k] = p[k] - rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
    net = Network(mean, np.where(scale > 1e-9, scale, 1), p[0], p[1], p[2], float(p[3][0]))
    raw, ty = net.raw(x[tune]), t[tune]
    loss = lambda c: np.mean(np.logaddexp(0, raw / c) - ty * raw / c)
    net.temperature = float(min(np.geomspace(0.25, 8, 81), key=loss))
    return net


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that are never learned from: crc32 of the doc_id as text, modulo 3, is 1; false for a null doc_id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def score(docs: DataFrame, labels: DataFrame, learned_rows: int = LEARNED_ROWS, doc_id: str = "doc_id",
          text: str = "text", label: str = "quality", keep_text: bool = False) -> DataFrame:
    """``docs`` (without the text, unless ``keep_text``) with ``held_out``, ``score`` (0 to 1, higher: label 1 likelier) and ``predicted`` (score >= 0.5).

    Learns from the labels of rows that aren't held out: at most ``learned_rows``
    of them, those whose doc_id has the least hash.  A label given twice counts
    once (the larger); null labels are ignored; where only one label or none is
    left, every score is 0.5.  A null, empty or blank text has pooled zeros and
    a score like any other.  Repeated rows score alike; columns of ``docs`` with
    the three names are replaced.
    """
    spark = docs.sparkSession
    docs = docs.drop("held_out", "score", "predicted")
    vectors = spark.sparkContext.broadcast(word_vectors(docs, text))

    def features():
        hashes = WordHashes()
        return lambda texts: [pa.array([pooled(_buckets(t, hashes), vectors.value).tobytes() for t in texts], pa.binary())]

    known = (labels.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("int").alias("label"))
             .filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
             .groupBy("doc_id").agg(F.max("label").alias("label"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(learned_rows))
    seen = (docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
            .join(F.broadcast(known), "doc_id"))  # learned_rows rows at most
    # a doc_id that many rows repeat gives one of them
    rows = (from_texts(seen, "text", "x binary", features).groupBy("doc_id")
            .agg(F.min(F.struct("x", "label")).alias("r")).select("doc_id", "r.x", "r.label").toPandas())
    rows = rows.sort_values("doc_id")
    net = None
    if len(rows):
        x = np.frombuffer(b"".join(rows["x"]), np.float32).reshape(len(rows), -1).astype(float)
        net = train(x, rows["label"].to_numpy())

    def scored():
        hashes = WordHashes()

        def made(texts):
            if net is None:
                return [pa.array([0.5] * len(texts), pa.float64())]
            x = [pooled(_buckets(t, hashes), vectors.value) for t in texts]
            return [pa.array(net(np.array(x, float).reshape(len(texts), 2 * DIMS + 1)))]
        return made

    given = docs.withColumn("_text", F.col(text))
    out = from_texts(given if keep_text else given.drop(text), "_text", "score double", scored)
    return out.withColumn("held_out", held_out(doc_id)).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
