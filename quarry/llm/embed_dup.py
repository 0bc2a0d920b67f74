"""Near-duplicate embeddings by product quantisation with inverted lists.

Method: unit vectors fall into coarse lists (nearest centroid); what is left of the
centroid is coded in subspaces, each by its nearest codeword.  A query visits the
lists that can hold a neighbour, estimates distances there by table look-ups from
its exact vector to the codes (asymmetric), and reranks the survivors by exact
cosine in double precision.

Two bounds make the search lossless whatever the sample gave:

* Probes.  For a vector x with nearest centroid c, a vector y within radius r of x can
  be in the list of e only if |x-e|^2 - |x-c|^2 <= 2 |c-e| r.
* Codes.  With y' the coded form of y and s = |y - y'| (kept with y), |x - y| <= r only
  if |x - y'| <= r + s.

Equal vectors under one label are one class before the search.  Lists are cut into
blocks by a hash and each pair of a query block and a list block is one group, so a
hot list is spread; a group gives counts and a spanning forest, never its pairs.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import cut
from quarry.llm.components import components

#: Rows that the index is fitted on at most: those of least hash.
FITTED_ROWS = 20_000
#: Rows of a query block or a list block on average, and queries looked up at once.
BLOCK, STEP = 2048, 128
#: Slack of the bounds for single-precision sums.
SLACK = 1e-3


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (np.square(centres).sum(axis=1) - 2 * x @ centres.T).argmin(axis=1)


def k_means(x: np.ndarray, k: int, rounds: int = 10, seed: int = 3) -> np.ndarray:
    """Up to ``k`` centres of the rows of ``x``."""
    rng = np.random.default_rng(seed)
    centres = x[rng.permutation(len(x))[:k]].copy()
    for _ in range(rounds):
        at = _nearest(x, centres)
        n = np.bincount(at, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, at, x)
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return centres


@dataclass
class Index:
    """Coarse centroids and, for each subspace, its codewords of residuals."""

    centroids: np.ndarray
    parts: list[slice]
    words: list[np.ndarray]

    @staticmethod
    def fit(x: np.ndarray, lists: int, subspaces: int, codewords: int) -> Index:
        centroids = k_means(x, lists)
        rest = x - centroids[_nearest(x, centroids)]
        cuts = np.linspace(0, x.shape[1], min(subspaces, x.shape[1]) + 1).astype(int)
        parts = [slice(a, b) for a, b in zip(cuts, cuts[1:])]
        return Index(centroids, parts, [k_means(rest[:, p], codewords) for p in parts])

    def add(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """List, codes and coding error of each row."""
        at = _nearest(x, self.centroids)
        rest = x - self.centroids[at]
        codes = np.stack([_nearest(rest[:, p], w) for p, w in zip(self.parts, self.words)], axis=1)
        coded = np.concatenate([w[codes[:, m]] for m, w in enumerate(self.words)], axis=1)
        return at, codes.astype(np.uint8), np.linalg.norm(rest - coded, axis=1)

    def probes(self, x: np.ndarray, radius: float) -> list[list[int]]:
        """The lists that can hold a vector within ``radius`` of each row."""
        d = np.square(x[:, None, :] - self.centroids).sum(axis=2) if len(x) * self.centroids.size < 1 << 24 else (
            np.square(x).sum(axis=1)[:, None] + np.square(self.centroids).sum(axis=1) - 2 * x @ self.centroids.T)
        at = d.argmin(axis=1)
        between = np.linalg.norm(self.centroids[:, None] - self.centroids, axis=2)
        near = d - d[np.arange(len(x)), at][:, None] <= 2 * between[at] * radius + SLACK
        return [np.flatnonzero(row).tolist() for row in near]

    def estimate(self, x: np.ndarray, at: int, codes: np.ndarray) -> np.ndarray:
        """Distance of each row of ``x`` to each coded row of list ``at``, by look-ups."""
        rest = x - self.centroids[at]
        out = np.zeros((len(x), len(codes)), np.float32)
        for m, (p, w) in enumerate(zip(self.parts, self.words)):
            look = (np.square(rest[:, p]).sum(axis=1)[:, None] + np.square(w).sum(axis=1) - 2 * rest[:, p] @ w.T)
            out += look.astype(np.float32)[:, codes[:, m]]
        return np.sqrt(np.maximum(out, 0))


def _matrix(column, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.float64).reshape(-1, dims)


def usable(vector: str) -> Column:
    """No null, no null or non-finite component, not all zero."""
    v = F.col(vector)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(v.isNotNull() & ~bad & F.exists(v, lambda x: x != 0), F.lit(False))


def _search(index: Index, queries: pd.DataFrame, listed: pd.DataFrame, cosine: float) -> pd.DataFrame:
    """(cid, links, root): for each query how many vectors of this block it links with, and forest edges."""
    dims = index.centroids.shape[1]
    x, y = _matrix(queries["unit"], dims), _matrix(listed["unit"], dims)
    codes = np.frombuffer(b"".join(listed["codes"]), np.uint8).reshape(len(y), -1)
    reach = np.sqrt(2 - 2 * cosine) + listed["error"].to_numpy() + SLACK
    qid, lid, copies = (c.to_numpy() for c in (queries["cid"], listed["cid"], listed["copies"]))
    links, pairs = np.zeros(len(x), np.int64), []
    at = int(listed["list"].iloc[0])
    for s in range(0, len(x), STEP):
        i, j = np.nonzero(index.estimate(x[s:s + STEP], at, codes) <= reach)
        i += s
        other = qid[i] != lid[j]
        i, j = i[other], j[other]
        exact = np.concatenate([np.einsum("ij,ij->i", x[i[k:k + 65536]], y[j[k:k + 65536]])
                                for k in range(0, len(i), 65536)] or [np.empty(0)])
        i, j = i[exact >= cosine], j[exact >= cosine]
        np.add.at(links, i, copies[j])
        pairs.append((i.astype(np.int32), j.astype(np.int32)))
    i, j = (np.concatenate(c) for c in zip(*pairs)) if pairs else (np.empty(0, int),) * 2
    ql, ll = qid.copy(), lid.copy()
    while len(i):  # least label along the links of this block
        before = ql.sum(dtype=object) + ll.sum(dtype=object)
        np.minimum.at(ll, j, ql[i])
        np.minimum.at(ql, i, ll[j])
        if ql.sum(dtype=object) + ll.sum(dtype=object) == before:
            break
    found = pd.DataFrame({"cid": qid, "links": links, "root": ql})
    more = pd.DataFrame({"cid": lid, "links": 0, "root": ll})
    out = pd.concat([found[links > 0], more[lid != ll]])
    return out


def near_vectors(vectors: DataFrame, cosine: float = 0.98, lists: int = 64, subspaces: int = 8, codewords: int = 64,
                 fitted_rows: int = FITTED_ROWS, vec_id: str = "vec_id", vector: str = "embedding",
                 label: str = "label") -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors``.

    Vectors of one label (null: none) and one length are linked where their
    cosine is at least ``cosine``.  ``n_links`` counts the other rows that a row
    is linked with, equal vectors included; ``component_id`` is the smallest
    vec_id that links reach.  Vectors that are null, empty, zero or hold null or
    non-finite components link with nothing.  Other columns are ignored; rows
    that repeat a vec_id count as vectors of their own; no rows give no rows.
    """
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"),
                          F.col(label).alias("label"))
    good = usable("vector") & F.col("label").isNotNull()
    rows = rows.withColumn("k1", F.when(good, F.xxhash64(F.lit(1), "label", "vector"))).withColumn(
        "k2", F.when(good, F.xxhash64(F.lit(2), "label", "vector")))
    classes = cut(rows.filter("k1 is not null").groupBy("k1", "k2").agg(
        F.first("label").alias("label"), F.first("vector").alias("vector"), F.min("vec_id").alias("low"),
        F.count(F.lit(1)).alias("copies"))).withColumn("cid", F.monotonically_increasing_id())
    classes = cut(classes.withColumn("dims", F.size("vector")))
    alone = rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    found = None
    for dims in sorted(r.dims for r in classes.select("dims").distinct().collect()):  # the lengths of vectors: few
        part = _links(classes.filter(F.col("dims") == dims), dims, cosine, lists, subspaces, codewords, fitted_rows)
        found = part if found is None else found.union(part)
    if found is None:
        return alone.withColumn("kept", F.lit(True))
    found = cut(found)
    joined = components(found.filter("cid <> root").select(F.col("cid").alias("a"), F.col("root").alias("b")))
    joined = joined.withColumnsRenamed({"node": "cid"})
    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    named = (classes.select("k1", "k2", "cid", "low", "copies").join(links, "cid", "left").join(joined, "cid", "left")
             .withColumn("component", F.coalesce("component", "cid")))
    named = cut(named)
    least = named.groupBy("component").agg(F.min("low").alias("component_id"))
    named = cut(named.join(least, "component").select(
        "k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"))
    out = rows.select("vec_id", "k1", "k2").join(named, ["k1", "k2"], "left")
    out = out.withColumn("component_id", F.coalesce("component_id", "vec_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "component_id",
                      F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))


def _links(classes: DataFrame, dims: int, cosine: float, lists: int, subspaces: int, codewords: int,
           fitted_rows: int) -> DataFrame:
    """(cid, links, root) of classes of one length; several rows for a cid."""
    spark = classes.sparkSession
    sample = classes.orderBy(F.xxhash64("vector"), "cid").limit(fitted_rows).select("vector").toPandas()["vector"]
    x = np.array([np.asarray(v, float) for v in sample]).reshape(-1, dims)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    shared = spark.sparkContext.broadcast(Index.fit(x / np.linalg.norm(x, axis=1, keepdims=True), lists, subspaces,
                                                    codewords))
    radius = float(np.sqrt(2 - 2 * cosine))

    def added(batches):
        index = shared.value
        for b in batches:
            if not b.num_rows:
                continue
            v = b.column("vector").flatten().to_numpy().reshape(-1, dims)
            v = v / np.abs(v).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
            v = v / np.linalg.norm(v, axis=1, keepdims=True)
            at, codes, error = index.add(v)
            made = [pa.array(at, pa.int32()), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(error),
                    pa.array([u.tobytes() for u in v], pa.binary()), pa.array(index.probes(v, radius), pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays([b.column("label"), b.column("cid"), b.column("copies"), *made],
                                             ["label", "cid", "copies", "list", "codes", "error", "unit", "probes"])

    kind = classes.schema["label"].dataType.simpleString()
    listed = cut(classes.select("label", "cid", "copies", "vector").mapInArrow(
        added, f"label {kind}, cid long, copies long, list int, codes binary, error double, unit binary, probes array<int>"))
    probing = listed.select("label", "cid", "unit", F.explode("probes").alias("list"))

    def blocks(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("label", "list").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias(name))

    n = blocks(listed, "nl").join(blocks(probing, "nq"), ["label", "list"])
    index_side = (listed.drop("probes").join(n, ["label", "list"])
                  .withColumn("lb", F.pmod(F.xxhash64("cid"), F.col("nl")))
                  .withColumn("qb", F.explode(F.sequence(F.lit(0).cast("long"), F.col("nq") - 1))))
    query_side = (probing.join(n, ["label", "list"]).withColumn("qb", F.pmod(F.xxhash64("cid"), F.col("nq")))
                  .withColumn("lb", F.explode(F.sequence(F.lit(0).cast("long"), F.col("nl") - 1))))
    group = ["label", "list", "lb", "qb"]

    def search(queries: pd.DataFrame, there: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(there):
            return pd.DataFrame({"cid": [], "links": [], "root": []}).astype("int64")
        return _search(shared.value, queries, there.rename(columns=lambda c: c[:-1]), cosine)

    # both sides come from one table: other names keep their columns apart
    index_side = index_side.select(*[F.col(c).alias(f"{c}_") for c in index_side.columns if c not in ("nl", "nq")])
    return query_side.drop("nl", "nq").groupBy(*group).cogroup(
        index_side.groupBy(*[f"{c}_" for c in group])).applyInPandas(search, "cid long, links long, root long")
