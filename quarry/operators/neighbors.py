"""Embeddings and neighbours: PCA (E6), k-nearest-neighbour graph (E7) by inverted
lists or exactly, deterministic scatter sample (E8)."""

from __future__ import annotations

import math
from typing import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.hashing import row_hash
from quarry.session import cut_lineage

DEFAULT_COMPONENTS = 2


def _vector_cols(df: DataFrame, cols) -> tuple[DataFrame, list[str]]:
    """Accept numeric columns or one array column; return a frame with numeric columns."""
    if isinstance(cols, str):
        n = len(df.select(cols).first()[0])
        names = [f"{cols}_{i}" for i in range(n)]
        return df.select("*", *[F.col(cols)[i].cast("double").alias(nm) for i, nm in enumerate(names)]), names
    return df, list(cols)


def pca(df: DataFrame, cols, k: int = DEFAULT_COMPONENTS, id_cols: Sequence[str] = ()):
    """Projection on the top-k principal axes of the mean-centred data, with
    explained variance ratios. Components are sign-normalised (largest absolute
    loading positive). Returns (projection, variance_table)."""
    from pyspark.ml.feature import PCA, VectorAssembler
    d, names = _vector_cols(df, cols)
    means = d.agg(*[F.avg(c).alias(c) for c in names]).first()
    cen = d.select(*id_cols, *[(F.col(c) - F.lit(means[c])).alias(c) for c in names])
    va = VectorAssembler(inputCols=names, outputCol="_v")
    vec = va.transform(cen)
    model = PCA(k=k, inputCol="_v", outputCol="_p").fit(vec)
    pc = model.pc.toArray()                                 # d x k
    signs = np.sign(pc[np.abs(pc).argmax(axis=0), np.arange(pc.shape[1])])
    signs[signs == 0] = 1.0
    from pyspark.ml.functions import vector_to_array
    proj = model.transform(vec).select(*id_cols, vector_to_array("_p").alias("_p"))
    proj = proj.select(*id_cols, *[(F.col("_p")[i] * float(signs[i])).alias(f"pc{i + 1}") for i in range(k)])
    ev = model.explainedVariance.toArray()
    var = df.sparkSession.createDataFrame([(i + 1, float(v)) for i, v in enumerate(ev)],
                                          "component int, explained_variance_ratio double")
    return proj, var


def _nearest_pairs(qi, qv, ci, cv, k: int):
    """(query row, candidate row, distance) of the k nearest of each query, by distance, then id.

    A matrix product selects, with slack for its rounding and all ties; the selected
    distances are then taken exactly."""
    qq, cc = (qv * qv).sum(axis=1), (cv * cv).sum(axis=1)
    d2 = qq[:, None] + cc[None, :] - 2.0 * (qv @ cv.T)
    d2[qi[:, None] == ci[None, :]] = np.inf
    kk = min(k, len(ci))
    slack = 1e-9 * (qq[:, None] + cc.max(initial=0.0) + 1e-300)
    i, j = np.nonzero((d2 <= np.partition(d2, kk - 1, axis=1)[:, [kk - 1]] + slack) & np.isfinite(d2))
    dist = np.sqrt(np.square(qv[i] - cv[j]).sum(axis=1))
    order = np.lexsort((ci[j], dist, i))
    i, j, dist = i[order], j[order], dist[order]
    first = np.flatnonzero(np.r_[True, i[1:] != i[:-1]]) if len(i) else np.empty(0, int)
    place = np.arange(len(i)) - np.repeat(first, np.diff(np.r_[first, len(i)]))
    return i[place < k], j[place < k], dist[place < k]


def _searched(q: pd.DataFrame, c: pd.DataFrame, name: str, k: int) -> pd.DataFrame:
    """(name, nbr, dist): the ``k`` nearest of the vectors ``c`` for each of ``q``, a few queries at a time."""
    if not len(q) or not len(c):
        return pd.DataFrame({name: [], "nbr": [], "dist": []})
    qi, ci = q[name].to_numpy(), c[name].to_numpy()
    qv, cv = (np.stack(x["v"].to_numpy()).astype(np.float64) for x in (q, c))
    step = max(1, (1 << 22) // len(ci))
    found = [(qi[at:at + step], *_nearest_pairs(qi[at:at + step], qv[at:at + step], ci, cv, k)) for at in range(0, len(qi), step)]
    return pd.concat([pd.DataFrame({name: own[i], "nbr": ci[j], "dist": d}) for own, i, j, d in found], ignore_index=True)


#: Memory of the lists' centres, which every task holds.
CENTRE_BYTES = 64 << 20
#: Vectors whose true neighbours tell how many lists must be looked into.
TUNED_ON = 200
#: Vectors that one task holds of a list, as queries and as candidates; longer lists are dealt to several tasks.
QUERY_ROWS, LIST_ROWS = 1 << 15, 1 << 16


def knn_graph(df: DataFrame, id_col: str, vec_col: str, k: int = 10, method: str = "lists", probes: int | None = None,
              recall: float = 0.95, block_rows: int = 2048, n_blocks: int | None = None) -> DataFrame:
    """K-nearest-neighbour graph (Euclidean), (id, nbr, rank, dist), equal distances by nbr.

    ``lists`` (default): the square root of n centres, chosen by hash among the different vectors; each vector stands
    in the list of its nearest centre and looks for neighbours in its ``probes`` nearest lists, so a neighbour that
    stands in another one is missed. Without ``probes``, as many as find a share of ``recall`` of the true neighbours
    of TUNED_ON vectors, which are compared with all others. ``exact`` compares all pairs of vectors, block by block.
    Rows whose id or vector, or a number of it, is missing are left out. Equal vectors are one for the search, however
    many they are."""
    if method not in ("lists", "exact"):
        raise ValueError(f"method must be lists or exact, not {method!r}")
    single = df.schema[vec_col].dataType == T.ArrayType(T.FloatType(), df.schema[vec_col].dataType.containsNull)
    v = F.col(vec_col).cast("array<float>" if single else "array<double>")  # half the bytes in every shuffle; distances are in doubles
    base = df.select(F.col(id_col).alias("id"), v.alias("v")).filter(
        F.col("id").isNotNull() & F.col("v").isNotNull() & ~F.exists("v", lambda x: x.isNull() | F.isnan(x)))
    return _knn_lists(base, k, probes, recall) if method == "lists" else _knn_exact(base, k, block_rows, n_blocks)


def _distances(v: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances but for a constant of each row of ``v``."""
    return (c * c).sum(axis=1)[None, :] - 2.0 * (v @ c.T)


def _matrix(vectors: pa.Array) -> np.ndarray:
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), -1).astype(np.float64)


def _needed_probes(placed: DataFrame, centres: np.ndarray, k: int, recall: float) -> int:
    """The least number of nearest lists that hold a share of ``recall`` of the neighbours of TUNED_ON vectors."""
    tried = placed.orderBy(F.xxhash64("rep", F.lit(1)), "rep").limit(TUNED_ON).select("rep", "v").collect()
    if not tried:
        return 1
    queries = np.array([r["v"] for r in tried], dtype=np.float64)
    names = np.array([r["rep"] for r in tried])
    shared = placed.sparkSession.sparkContext.broadcast((queries, names))

    def nearest(batches):
        q, own = shared.value
        for b in batches:
            if not b.num_rows:
                continue
            rep, home = b.column(0).to_numpy(zero_copy_only=False), b.column(2).to_numpy(zero_copy_only=False)
            i, j, dist = _nearest_pairs(own, q, rep, _matrix(b.column(1)), k)
            yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(dist), pa.array(home[j].astype(np.int32))], ["query", "dist", "home"])

    near = placed.select("rep", "v", "home").mapInArrow(nearest, "query int, dist double, home int")
    w = Window.partitionBy("query").orderBy("dist", "home")
    found = near.withColumn("at", F.row_number().over(w)).filter(F.col("at") <= k).collect()  # TUNED_ON x k
    rank = np.argsort(np.argsort(_distances(queries, centres), axis=1, kind="stable"), axis=1)
    needed = np.sort([rank[r["query"], r["home"]] for r in found]) + 1
    return int(needed[min(len(needed) - 1, math.ceil(recall * len(needed)) - 1)]) if len(needed) else 1


def _knn_lists(base: DataFrame, k: int, probes: int | None, recall: float) -> DataFrame:
    spark, kind, vec = base.sparkSession, base.schema["id"].dataType.simpleString(), base.schema["v"].dataType.simpleString()
    # different vectors, each with the k + 1 smallest ids that have it
    order = Window.partitionBy("v").orderBy("id")
    ids = base.withColumn("at", F.row_number().over(order)).filter(F.col("at") <= k + 1)
    reps = cut_lineage(ids.groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("ids"))
                       .withColumn("rep", F.col("ids")[0]))
    n = reps.count()
    width = reps.agg(F.max(F.size("v"))).first()[0] or 1
    n_lists = max(1, min(math.isqrt(max(n - 1, 0)) + 1, CENTRE_BYTES // (8 * width)))
    chosen = reps.orderBy(F.xxhash64("rep"), "rep").limit(n_lists).select("v").collect()  # CENTRE_BYTES at most
    centres = np.array([r["v"] for r in chosen], dtype=np.float64).reshape(len(chosen), width)
    shared = spark.sparkContext.broadcast(centres)

    def at_home(batches):
        for b in batches:
            home = _distances(_matrix(b.column(1)), shared.value).argmin(axis=1) if b.num_rows else np.empty(0, int)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(home.astype(np.int32))], ["rep", "v", "home"])

    def lists_of(batches):
        for b in batches:
            if not b.num_rows:
                continue
            d = _distances(_matrix(b.column(1)), shared.value)
            at = np.argpartition(d, near - 1, axis=1)[:, :near].astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1, dtype=np.int32) * near), pa.array(at.ravel()))
            yield pa.RecordBatch.from_arrays([*b.columns, lists], ["rep", "v", "home", "lists"])

    placed = cut_lineage(reps.select("rep", "v").mapInArrow(at_home, f"rep {kind}, v {vec}, home int"))
    near = max(1, min(len(chosen), probes or _needed_probes(placed, centres, k, recall)))
    placed = placed.mapInArrow(lists_of, f"rep {kind}, v {vec}, home int, lists array<int>")
    # a row for each list: how many tasks its queries and its candidates are dealt to
    asked = placed.select(F.explode("lists").alias("list")).groupBy("list").agg(F.count(F.lit(1)).alias("asked"))
    held = placed.groupBy(F.col("home").alias("list")).agg(F.count(F.lit(1)).alias("held"))
    parts = F.broadcast(asked.join(held, "list").select(
        "list", F.ceil(F.col("asked") / QUERY_ROWS).cast("int").alias("q_parts"), F.ceil(F.col("held") / LIST_ROWS).cast("int").alias("c_parts")))

    def lot(n_parts):
        return F.pmod(F.xxhash64("rep"), F.col(n_parts)).cast("int")

    def every(n_parts):
        return F.explode(F.sequence(F.lit(0), F.col(n_parts) - 1))

    queries = (placed.select("rep", "v", F.explode("lists").alias("list")).join(parts, "list")
               .select("rep", "v", "list", lot("q_parts").alias("q"), every("c_parts").alias("c")))
    candidates = (placed.select("rep", "v", F.col("home").alias("list")).join(parts, "list")
                  .select(F.col("rep").alias("rep"), F.col("v").alias("v"), F.col("list").alias("list"), lot("c_parts").alias("c"),
                          every("q_parts").alias("q")))

    def search(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        return _searched(q, c, "rep", k)

    keys = ["list", "q", "c"]
    pairs = queries.groupBy(*keys).cogroup(candidates.groupBy(*keys)).applyInPandas(search, f"rep {kind}, nbr {kind}, dist double")
    best = Window.partitionBy("rep").orderBy("dist", "nbr")  # probes x k rows
    near_reps = pairs.withColumn("at", F.row_number().over(best)).filter(F.col("at") <= k)
    # the k + 1 nearest ids of each different vector: those that have it, then those of its neighbours
    others = near_reps.join(reps.select(F.col("rep").alias("nbr"), "ids"), "nbr").select("rep", "dist", F.explode("ids").alias("nbr"))
    own = reps.select("rep", F.lit(0.0).alias("dist"), F.explode("ids").alias("nbr"))
    listed = Window.partitionBy("rep").orderBy("dist", "nbr")
    lists = (own.unionByName(others).withColumn("at", F.row_number().over(listed)).filter(F.col("at") <= k + 1)
             .groupBy("rep").agg(F.array_sort(F.collect_list(F.struct("dist", "nbr"))).alias("near")))
    of_vector = reps.select("v", "rep").join(lists, "rep").drop("rep")
    mine = F.slice(F.filter("near", lambda x: x["nbr"] != F.col("id")), 1, k)
    return (base.join(of_vector, "v").select("id", F.posexplode(mine).alias("at", "x"))
            .select("id", F.col("x.nbr").alias("nbr"), F.col("x.dist").alias("dist"), (F.col("at") + 1).alias("rank")))


def _knn_exact(base: DataFrame, k: int, block_rows: int, n_blocks: int | None) -> DataFrame:
    """Every vector against all others: queries and candidates are dealt into blocks by a hash of
    the id, each (query block, candidate block) is compared in NumPy by one task and keeps a partial
    top-k per query; a row_number per id merges the partial lists. The work is the exact n^2
    distances. A task holds two blocks of bounded size; as each row goes to every block of the other
    side, the blocks are as few as keep all cores at work until that size is reached.
    """
    n = base.count()
    cores, kind = base.sparkSession.sparkContext.defaultParallelism, base.schema["id"].dataType.simpleString()
    c_blocks = n_blocks or max(1, -(-n // LIST_ROWS))
    q_blocks = n_blocks or max(1, -(-n // QUERY_ROWS), min(-(-n // block_rows), -(-4 * cores // c_blocks)))

    def dealt(own, n_own, other, n_other):
        return (base.withColumn(own, F.pmod(F.xxhash64("id"), F.lit(n_own)).cast("int"))
                .withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(n_other - 1)))).groupBy("q", "c"))

    def compared(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        return _searched(q, c, "id", k)

    near = dealt("q", q_blocks, "c", c_blocks).cogroup(dealt("c", c_blocks, "q", q_blocks)).applyInPandas(
        compared, f"id {kind}, nbr {kind}, dist double")
    w = Window.partitionBy("id").orderBy("dist", "nbr")   # one partition per id: blocks x k rows
    return near.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def scatter_sample(df: DataFrame, cols: Sequence[str], n: int, key, seed: int = 0,
                   hash_method: str = "xxhash64") -> DataFrame:
    """Deterministic sample of n rows for a scatter plot: bounded top-n by
    hash of the key (no full sort)."""
    keys = [key] if isinstance(key, str) else list(key)
    return (df.withColumn("_h", row_hash(keys, seed, hash_method)).orderBy("_h", *keys).limit(n)
            .select(*keys, *cols))
