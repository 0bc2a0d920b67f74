"""Random forest classification (T rows), grown level by level.

* Features are binned once, by one rule: midpoints between neighbours among a
  feature's distinct values, evenly chosen from a mergeable sample of them, which
  holds all of them where they are few.
* Bootstrap = Poisson(1) weight per (row, tree) from a hash of the key - no
  row index, nothing on the driver.
* Where the bins allow far fewer different rows than there are, equal binned rows
  become one with the sums of their weights, so that a level costs as much as there
  are different ones.
* Each depth level is ONE Spark job for ALL trees of all forests that are grown
  together (a grid search grows its candidates on all folds at once): an Arrow
  kernel routes every row through every tree with the broadcast node table and
  emits per-batch partial histograms (forest, tree, node, feature, bin) -> class
  weights; Spark's partial aggregation and one shuffle merge them; a window over
  bins (partitioned by tree, node, feature - at most max_bins rows each) and
  ``min_by`` pick the best split. Only the split table (bounded by the models'
  size, and by WAVE_TREES) reaches the driver. Rows are re-routed from the root
  each level, so lineage never grows; the binned table is persisted for reuse.
"""

from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.hashing import TWO_32, row_hash
from quarry.plans.parallel import spread

IMPURITIES = ("gini", "entropy")


# ----------------------------------------------------------------------------- T1

def impurity_expr(c0: Column, c1: Column, metric: str = "gini") -> Column:
    """Gini / entropy (log2) of two class counts as a Column; empty -> 0."""
    n = c0 + c1
    p0 = F.when(n > 0, c0 / n).otherwise(F.lit(0.0))
    p1 = F.when(n > 0, c1 / n).otherwise(F.lit(0.0))
    if metric == "gini":
        return F.when(n > 0, 1.0 - p0 * p0 - p1 * p1).otherwise(F.lit(0.0))
    if metric == "entropy":
        def term(p):
            return F.when(p > 0, -p * F.log2(p)).otherwise(F.lit(0.0))
        return F.when(n > 0, term(p0) + term(p1)).otherwise(F.lit(0.0))
    raise ValueError(f"unknown impurity {metric!r}")


def impurity_counts(counts: Column, metric: str = "gini") -> Column:
    """T1 for any number of classes: ``counts`` is an array<long/double>."""
    tot = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)
    if metric == "gini":
        s = F.aggregate(counts, F.lit(0.0), lambda a, x: a + (x / tot) * (x / tot))
        return F.when(tot > 0, 1.0 - s).otherwise(F.lit(0.0))
    s = F.aggregate(counts, F.lit(0.0), lambda a, x: a + F.when(x > 0, -(x / tot) * F.log2(x / tot)).otherwise(0.0))
    return F.when(tot > 0, s).otherwise(F.lit(0.0))


def _imp_np(c0, c1, metric):
    n = c0 + c1
    with np.errstate(divide="ignore", invalid="ignore"):
        p0 = np.where(n > 0, c0 / n, 0.0)
        p1 = np.where(n > 0, c1 / n, 0.0)
        if metric == "gini":
            return np.where(n > 0, 1.0 - p0 * p0 - p1 * p1, 0.0)
        t0 = np.where(p0 > 0, -p0 * np.log2(np.where(p0 > 0, p0, 1.0)), 0.0)
        t1 = np.where(p1 > 0, -p1 * np.log2(np.where(p1 > 0, p1, 1.0)), 0.0)
        return np.where(n > 0, t0 + t1, 0.0)


# ----------------------------------------------------------------------------- T2 / T4

def _poisson_edges(kmax: int = 12) -> list[float]:
    edges, acc, term = [], 0.0, math.exp(-1.0)
    for k in range(kmax):
        acc += term
        edges.append(acc)
        term /= (k + 1)
    return edges


def poisson_weight(u: Column) -> Column:
    """Poisson(1) draw from a uniform by its inverse CDF (CASE over cumulative probabilities)."""
    edges = _poisson_edges()
    e = F.lit(len(edges))
    for k in reversed(range(len(edges))):
        e = F.when(u < F.lit(edges[k]), F.lit(k)).otherwise(e)
    return e


def bootstrap(df: DataFrame, key: Sequence[str] | str, n_trees: int, seed: int,
              hash_method: str = "xxhash64") -> DataFrame:
    """Long table (key..., tree_id, weight); weight 0 rows are the tree's out-of-bag rows."""
    keys = [key] if isinstance(key, str) else list(key)
    t = df.select(*keys, F.explode(F.sequence(F.lit(0), F.lit(n_trees - 1))).alias("tree_id"))
    u = row_hash([*keys, "tree_id"], seed, hash_method) / F.lit(TWO_32)
    return t.withColumn("weight", poisson_weight(u).cast("int"))


def oob(df: DataFrame, key, n_trees: int, seed: int, hash_method: str = "xxhash64") -> DataFrame:
    """T4: out-of-bag rows per tree."""
    return bootstrap(df, key, n_trees, seed, hash_method).filter(F.col("weight") == 0).drop("weight")


def _weights_array(keys: list[str], n_trees: int, seed: int, hash_method: str) -> Column:
    if hash_method == "md5":
        base = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
        ws = [poisson_weight(F.conv(F.substring(F.md5(F.concat_ws("|", base, F.lit(str(t)), F.lit(str(seed)))), 1, 8),
                                    16, 10).cast("long") / F.lit(TWO_32)) for t in range(n_trees)]
        return F.array(*ws).cast("array<tinyint>")
    hk = F.xxhash64(*[F.col(k) for k in keys], F.lit(seed))
    return F.transform(F.sequence(F.lit(0), F.lit(n_trees - 1)),
                       lambda t: poisson_weight(F.pmod(F.xxhash64(hk, t), F.lit(2 ** 32)) / F.lit(TWO_32))
                       ).cast("array<tinyint>")


# ----------------------------------------------------------------------------- binning

#: Distinct values of a feature, those of the smallest hashes, that its cut points are chosen from.
SAMPLED_VALUES = 4096


def _value_hash(x: np.ndarray) -> np.ndarray:
    """Avalanche of the bits of doubles."""
    h = x.view(np.uint64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return h ^ (h >> np.uint64(31))


def sample_values(df: DataFrame, features: Sequence[str]) -> dict[str, np.ndarray]:
    """The SAMPLED_VALUES distinct values of each feature whose hashes are smallest, sorted: an even sample of the
    distinct values, the same for any partitions, and all of them where they are fewer. Nulls and NaN are left out."""
    cols, n = [F.col(c).cast("double").alias(f"f{i}") for i, c in enumerate(features)], len(features)

    def kernel(batches):
        kept = [np.empty(0)] * n
        for b in batches:
            for i, c in enumerate(b.columns):
                x = c.drop_null().to_numpy(zero_copy_only=False)
                kept[i] = least(np.union1d(kept[i], x[~np.isnan(x)] + 0.0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(len(kept), dtype=np.int32), [len(x) for x in kept])),
             pa.array(np.concatenate(kept)), pa.array(np.concatenate([_value_hash(x) for x in kept]).view(np.int64))],
            ["feature", "value", "h"])

    def least(x):
        return x if len(x) <= SAMPLED_VALUES else np.sort(x[np.argpartition(_value_hash(x), SAMPLED_VALUES)[:SAMPLED_VALUES]])

    # unsigned order of the hashes, as in the kernel
    order = Window.partitionBy("feature").orderBy(F.col("h") < 0, "h")
    found = (df.select(*cols).mapInArrow(kernel, "feature int, value double, h long").distinct()
             .withColumn("place", F.row_number().over(order)).filter(F.col("place") <= SAMPLED_VALUES).select("feature", "value").collect())
    out = {c: [] for c in features}
    for r in found:
        out[features[r["feature"]]].append(r["value"])
    return {c: np.sort(np.array(v, dtype=float)) for c, v in out.items()}


def cut_points(values: np.ndarray, max_bins: int = 64) -> np.ndarray:
    """At most ``max_bins`` midpoints between neighbours of the sorted values, evenly chosen; all where there are no more."""
    gaps = len(values) - 1
    if gaps < 1:
        return np.array([], dtype=float)
    at = np.unique(np.round(np.linspace(0, gaps - 1, min(gaps, max_bins))).astype(int))
    return values[at] / 2.0 + values[at + 1] / 2.0


def fit_bins(df: DataFrame, features: Sequence[str], max_bins: int = 64) -> dict[str, np.ndarray]:
    """Split candidates per feature: cut points among its distinct values (of an even sample of SAMPLED_VALUES)."""
    return {c: cut_points(v, max_bins) for c, v in sample_values(df, list(features)).items()}


def _bin_expr(c: str, th: np.ndarray) -> Column:
    """bin = number of thresholds strictly below x (balanced CASE tree); a missing value
    (NULL or NaN) is below all, so it goes left at every split, in training and prediction."""
    x = F.col(c).cast("double")
    x = F.when(~F.isnan(x), x)
    th = list(map(float, th))

    def build(lo, hi):  # answer in [lo, hi]
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi + 1) // 2
        return F.when(x > F.lit(th[mid - 1]), build(mid, hi)).otherwise(build(lo, mid - 1))
    return build(0, len(th)).cast("short")


# ----------------------------------------------------------------------------- model

@dataclass
class Forest:
    features: list
    thresholds: dict
    impurity: str
    trees: list = field(default_factory=list)   # per tree: dict of numpy arrays
    tree_features: list = field(default_factory=list)

    def node_table(self, spark) -> DataFrame:
        rows = []
        for t, tr in enumerate(self.trees):
            for i in range(len(tr["feat"])):
                f = int(tr["feat"][i])
                rows.append((t, i, int(tr["depth"][i]), self.features[f] if f >= 0 else None,
                             float(tr["thr"][i]) if f >= 0 else None, int(tr["left"][i]), int(tr["right"][i]),
                             float(tr["c0"][i] + tr["c1"][i]), float(tr["c0"][i]), float(tr["c1"][i]),
                             float(tr["imp"][i]), int(tr["c1"][i] > tr["c0"][i]),
                             float(tr["c1"][i] / max(tr["c0"][i] + tr["c1"][i], 1e-300)), f < 0))
        return spark.createDataFrame(rows, "tree_id int, node_id int, depth int, feature string, threshold double, "
                                           "left int, right int, n double, c0 double, c1 double, impurity double, "
                                           "label int, p1 double, is_leaf boolean")


def _new_tree():
    return {k: [] for k in ("feat", "bin", "thr", "left", "right", "c0", "c1", "imp", "depth")}


def _add_node(tr, c0, c1, depth, metric):
    tr["feat"].append(-1), tr["bin"].append(-1), tr["thr"].append(np.nan)
    tr["left"].append(-1), tr["right"].append(-1)
    tr["c0"].append(float(c0)), tr["c1"].append(float(c1)), tr["depth"].append(depth)
    tr["imp"].append(float(_imp_np(np.array([c0]), np.array([c1]), metric)[0]))
    return len(tr["feat"]) - 1


def _route(xb: np.ndarray, feat: np.ndarray, bins: np.ndarray, left: np.ndarray, right: np.ndarray,
           depth: int) -> np.ndarray:
    node = np.zeros(len(xb), dtype=np.int64)
    rows = np.arange(len(xb))
    for _ in range(depth):
        f = feat[node]
        split = f >= 0
        if not split.any():
            break
        v = xb[rows, np.where(split, f, 0)]
        go_right = v > bins[node]
        node = np.where(split, np.where(go_right, right[node], left[node]), node)
    return node


#: Rows for each possible binned row and class from which on equal rows are merged.
MERGED_ROWS = 4
#: Rows and weights that are merged at a time in a task.
MERGED_AT_ONCE, MERGED_WEIGHTS = 1 << 20, 1 << 24
#: Training frames that are read and binned at once.
PREPARED_AT_ONCE = 4
#: Trees that are grown in the same jobs at most, which bounds the node tables on the driver and in each task.
WAVE_TREES = 2000
DEFAULTS = {"n_trees": 50, "max_depth": 15, "min_samples_split": 5, "min_samples_leaf": 2, "impurity": "entropy",
            "max_features": "sqrt", "max_bins": 64, "seed": 42, "bootstrap_rows": True}
HISTOGRAM = "forest int, tree int, node int, feature int, bin int, c0 double, c1 double"


def fit_forest(df: DataFrame, features: Sequence[str], label: str, key: Sequence[str] | str,
               n_trees: int = 50, max_depth: int = 15, min_samples_split: int = 5, min_samples_leaf: int = 2,
               impurity: str = "entropy", max_features: str | int = "sqrt", max_bins: int = 64,
               seed: int = 42, bootstrap_rows: bool = True, hash_method: str = "xxhash64") -> Forest:
    """Grow ``n_trees`` trees level-wise; max_depth jobs in total."""
    params = {"n_trees": n_trees, "max_depth": max_depth, "min_samples_split": min_samples_split, "min_samples_leaf": min_samples_leaf,
              "impurity": impurity, "max_features": max_features, "max_bins": max_bins, "seed": seed, "bootstrap_rows": bootstrap_rows}
    return fit_forests([(df, features)], label, key, [(0, params)], hash_method)[0]


def fit_forests(trainings: Sequence[tuple[DataFrame, Sequence[str]]], label: str, key: Sequence[str] | str,
                wanted: Sequence[tuple[int, dict]], hash_method: str = "xxhash64") -> list[Forest]:
    """Many forests in the jobs of one: ``wanted`` holds (number of the training frame, parameters) of each.

    ``trainings`` are frames with their feature columns, such as the training rows of each fold. Each (frame,
    max_bins) is binned once; all the binned rows are one table, and a level of all forests is one job over it."""
    wanted = [(t, {**DEFAULTS, **p}) for t, p in wanted]
    for _, p in wanted:
        if p["impurity"] not in IMPURITIES:
            raise ValueError(f"unknown impurity {p['impurity']!r}")
    keys = [key] if isinstance(key, str) else list(key)
    draws: dict[tuple, int] = {}  # (bootstrap, seed) -> trees that need its weights
    for _, p in wanted:
        draw = (p["bootstrap_rows"], p["seed"] if p["bootstrap_rows"] else 0)
        draws[draw] = max(draws.get(draw, 0), p["n_trees"])
    places, at = {}, 0
    for draw, n in draws.items():
        places[draw], at = at, at + n
    weights = F.concat(*[_weights_array(keys, n, seed, hash_method) if boot else F.array_repeat(F.lit(1), n).cast("array<tinyint>")
                         for (boot, seed), n in draws.items()])
    rows: dict[int, int] = {}

    def copied(t):
        """One parallel, persisted copy of the needed columns, which feeds binning and weights."""
        df, features = trainings[t]
        raw = spread(df.select(*dict.fromkeys([*features, label, *keys]))).persist(StorageLevel.MEMORY_AND_DISK)
        labels = raw.groupBy(label).agg(F.count(F.lit(1)).alias("n")).limit(3).collect()
        if not {r[label] for r in labels} <= {0, 1}:
            raise ValueError("labels must be exactly 0 and 1")
        rows[t] = sum(r["n"] for r in labels)
        return raw

    # frames, and then (frame, max_bins), are prepared by a few concurrent jobs
    with ThreadPoolExecutor(max_workers=PREPARED_AT_ONCE) as ex:
        used = list(dict.fromkeys(t for t, _ in wanted))
        held = dict(zip(used, ex.map(copied, used)))
        pairs = list(dict.fromkeys((t, p["max_bins"]) for t, p in wanted))
        cuts = list(ex.map(lambda x: fit_bins(held[x[0]], list(trainings[x[0]][1]), x[1]), pairs))
    binned = None
    for number, ((t, _), th) in enumerate(zip(pairs, cuts)):
        own = held[t].select(F.lit(number).alias("part"), F.array(*[_bin_expr(c, th[c]) for c in trainings[t][1]]).alias("xb"),
                             F.col(label).cast("byte").alias("y"), weights.alias("w"))
        shapes = [len(th[c]) + 1 for c in trainings[t][1]]
        if math.prod(shapes) * 2 * MERGED_ROWS <= rows[t]:
            own = _merged(own, shapes)
        binned = own if binned is None else binned.unionByName(own)
    models = []
    for t, p in wanted:
        number = pairs.index((t, p["max_bins"]))
        draw = (p["bootstrap_rows"], p["seed"] if p["bootstrap_rows"] else 0)
        models.append(_Growing(number, cuts[number], list(trainings[t][1]), p, places[draw]))
    # as many partitions as the largest frame has alone
    sizes = [raw._jdf.queryExecution().toRdd().getNumPartitions() for raw in held.values()]
    binned = binned.coalesce(max(1, *sizes)).persist(StorageLevel.MEMORY_AND_DISK)
    first = 0
    while first < len(models):
        last, trees = first, 0
        while last < len(models) and (last == first or trees + models[last].params["n_trees"] <= WAVE_TREES):
            trees += models[last].params["n_trees"]
            last += 1
        _grow(binned, models[first:last], list(held.values()))
        first = last
    binned.unpersist()
    for raw in held.values():
        raw.unpersist()
    return [m.done() for m in models]


def _merged(binned: DataFrame, shapes: Sequence[int]) -> DataFrame:
    """Equal (part, xb, y) as one row with the sums of their weights, within each task and then by a shuffle of what is left."""
    def sums(part, code, weights):
        order = np.lexsort((code, part))
        part, code = part[order], code[order]
        first = np.flatnonzero(np.r_[True, (np.diff(part) != 0) | (np.diff(code) != 0)])
        return part[first], code[first], np.add.reduceat(weights[order], first, axis=0)

    def kernel(read):
        def merge(batches):
            held, n = [], 0
            for b in batches:
                if not b.num_rows:
                    continue
                held.append(read(b))
                n, most = n + b.num_rows, min(MERGED_AT_ONCE, MERGED_WEIGHTS // held[0][2].shape[1])
                if n >= most:
                    held = [sums(*(np.concatenate(x) for x in zip(*held)))]
                    n = len(held[0][0])
                    if 2 * n > most:  # mostly different: hand them on
                        yield out(*held[0])
                        held, n = [], 0
            if held:
                yield out(*sums(*(np.concatenate(x) for x in zip(*held))))
        return merge

    def out(part, code, weights):
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(code) + 1, dtype=np.int32) * weights.shape[1]), pa.array(weights.ravel()))
        return pa.RecordBatch.from_arrays([pa.array(part), pa.array(code), lists], ["part", "code", "w"])

    def binned_rows(b):
        part, y = (b.column(c).to_numpy(zero_copy_only=False) for c in (0, 2))
        at = np.arange(b.num_rows)
        return part, np.ravel_multi_index(_matrix(b.column(1), at).T, shapes) * 2 + y, _matrix(b.column(3), at)

    def merged_rows(b):
        return *(b.column(c).to_numpy(zero_copy_only=False) for c in (0, 1)), _matrix(b.column(2), np.arange(b.num_rows))

    schema = "part int, code long, w array<bigint>"
    own = binned.mapInArrow(kernel(binned_rows), schema).repartition("part", "code").mapInArrow(kernel(merged_rows), schema)
    code, xb = F.floor(F.col("code") / 2), []
    for i, size in enumerate(shapes):
        xb.append(F.pmod(F.floor(code / math.prod(shapes[i + 1:])), F.lit(size)).cast("short"))
    return own.select("part", F.array(*xb).alias("xb"), F.pmod("code", F.lit(2)).cast("byte").alias("y"), "w")


class _Growing:
    """A forest while it grows."""

    def __init__(self, part: int, thresholds: dict, features: list, params: dict, weights_at: int):
        self.part, self.thresholds, self.features, self.params, self.weights_at = part, thresholds, features, params, weights_at
        d, wanted = len(features), params["max_features"]
        k = max(1, int(math.floor(math.sqrt(d)))) if wanted == "sqrt" else (d if wanted in (None, "all") else int(wanted))
        rng = np.random.default_rng(params["seed"])
        self.tree_features = [np.sort(rng.choice(d, size=min(k, d), replace=False)) for _ in range(params["n_trees"])]
        self.trees = [_new_tree() for _ in range(params["n_trees"])]
        self.active: list[tuple[int, int]] = []  # (tree, node)

    def add(self, tree: int, c0: float, c1: float, depth: int) -> int:
        node = _add_node(self.trees[tree], c0, c1, depth, self.params["impurity"])
        if c0 > 0 and c1 > 0 and c0 + c1 >= self.params["min_samples_split"] and depth < self.params["max_depth"]:
            self.active.append((tree, node))
        return node

    def split(self, tree: int, node: int, r, depth: int) -> None:
        tr, f, b = self.trees[tree], int(r["feature"]), int(r["bin"])
        th = self.thresholds[self.features[f]]
        tr["feat"][node], tr["bin"][node] = f, b
        tr["thr"][node] = float(th[b]) if b < len(th) else float("inf")
        tr["left"][node] = self.add(tree, r["l0"], r["l1"], depth + 1)
        tr["right"][node] = self.add(tree, r["r0"], r["r1"], depth + 1)

    def done(self) -> Forest:
        return Forest(self.features, self.thresholds, self.params["impurity"], [_arrays(tr) for tr in self.trees],
                      [list(map(int, f)) for f in self.tree_features])


def _arrays(tree: dict) -> dict:
    return {k: np.asarray(v, dtype=(np.float64 if k in ("thr", "c0", "c1", "imp") else np.int64)) for k, v in tree.items()}


def _grow(binned: DataFrame, models: list[_Growing], inputs: list[DataFrame]) -> None:
    """All levels of the forests: one job each."""
    spark = binned.sparkSession
    # root counts: one aggregation over the weights (this also materialises `binned`)
    roots = {(r["part"], r["t"]): (float(r["c0"]), float(r["c1"])) for r in
             binned.select("part", "y", F.posexplode("w").alias("t", "wt")).groupBy("part", "t").agg(
                 F.sum(F.when(F.col("y") == 0, F.col("wt")).otherwise(0)).alias("c0"),
                 F.sum(F.when(F.col("y") == 1, F.col("wt")).otherwise(0)).alias("c1")).collect()}
    for raw in inputs:
        raw.unpersist()
    for m in models:
        for t in range(m.params["n_trees"]):
            m.add(t, *roots.get((m.part, m.weights_at + t), (0.0, 0.0)), 0)
    metrics = {m.params["impurity"] for m in models}
    gini = F.get(F.array(*[F.lit(m.params["impurity"] == "gini") for m in models]), F.col("forest"))
    leaf = F.get(F.array(*[F.lit(m.params["min_samples_leaf"]) for m in models]), F.col("forest"))
    depth = 0
    while any(m.active for m in models):
        level = []
        for i, m in enumerate(models):
            act: dict[int, list[int]] = {}
            for t, node in m.active:
                act.setdefault(t, []).append(node)
            level.append((i, m.part, m.weights_at, int(m.params["max_bins"]) + 1, len(m.features),
                          [(t, _arrays(m.trees[t]), np.array(nodes), np.asarray(m.tree_features[t])) for t, nodes in act.items()]))
        shared = spark.sparkContext.broadcast([x for x in level if x[-1]])
        hist = (binned.mapInArrow(_level_kernel(shared, depth), HISTOGRAM)
                .groupBy("forest", "tree", "node", "feature", "bin").agg(F.sum("c0").alias("c0"), F.sum("c1").alias("c1")))
        found = _best_splits(hist, metrics.pop() if len(metrics) == 1 else gini, leaf, ("forest", "tree", "node")).collect()
        metrics = {m.params["impurity"] for m in models}
        shared.unpersist()
        best = {(r["forest"], r["tree"], r["node"]): r for r in found}
        for i, m in enumerate(models):
            now, m.active = m.active, []
            for t, node in now:
                if (i, t, node) in best:
                    m.split(t, node, best[i, t, node], depth)
        depth += 1


def _level_kernel(shared, depth: int):
    """Partial histograms of the level's nodes, from Arrow buffers: no Python object for each row."""
    def kernel(batches):
        by_part: dict[int, list] = {}
        for x in shared.value:
            by_part.setdefault(x[1], []).append(x)
        for b in batches:
            part, y = (b.column(c).to_numpy(zero_copy_only=False) for c in (0, 2))
            cells = []
            for p in np.unique(part).tolist():
                rows = np.flatnonzero(part == p)
                if p not in by_part:
                    continue
                xb, wt = (_matrix(b.column(c), rows) for c in (1, 3))
                for forest_no, _, at, n_bins, _, trees in by_part[p]:
                    for t, arrays, nodes, fs in trees:
                        cells += _tree_cells(xb, y[rows], wt[:, at + t], arrays, nodes, fs, n_bins, depth, forest_no, t)
            if cells:
                ids = [np.concatenate(x) for x in zip(*cells)]
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int32()) for x in ids[:5]] + [pa.array(x) for x in ids[5:]],
                                                 ["forest", "tree", "node", "feature", "bin", "c0", "c1"])
    return kernel


def _matrix(lists: pa.ListArray, rows: np.ndarray) -> np.ndarray:
    """The lists of ``rows``, which are equally long, as a matrix."""
    ends = lists.offsets.to_numpy()
    start, values = ends[rows], lists.values.to_numpy(zero_copy_only=False)
    return values[start[:, None] + np.arange(ends[rows[0] + 1] - start[0])[None, :]].astype(np.int64)


def _tree_cells(xb, y, wt, arrays, nodes, fs, nb, depth, forest_no, tree) -> list:
    """Class weights of the non-empty (node, feature, bin) cells of a tree's active nodes."""
    node = _route(xb, arrays["feat"], arrays["bin"], arrays["left"], arrays["right"], depth)
    pos = np.full(len(arrays["feat"]), -1, dtype=np.int64)
    pos[nodes] = np.arange(len(nodes))
    li = pos[node]
    m = (li >= 0) & (wt > 0)
    if not m.any():
        return []
    idx = ((li[m][:, None] * len(fs) + np.arange(len(fs))[None, :]) * nb + xb[m][:, fs]).ravel()
    ww = np.repeat(wt[m].astype(np.float64), len(fs))
    yy = np.repeat(y[m], len(fs))
    dense = len(nodes) * len(fs) * nb
    if dense <= (1 << 22):
        # small cell space: dense bincount, keep the non-empty cells
        c0 = np.bincount(idx, weights=ww * (yy == 0), minlength=dense)
        c1 = np.bincount(idx, weights=ww * (yy == 1), minlength=dense)
        uniq = np.nonzero((c0 > 0) | (c1 > 0))[0]
        c0, c1 = c0[uniq], c1[uniq]
    else:
        uniq, inv = np.unique(idx, return_inverse=True)
        c0 = np.bincount(inv, weights=ww * (yy == 0), minlength=len(uniq))
        c1 = np.bincount(inv, weights=ww * (yy == 1), minlength=len(uniq))
    n = len(uniq)
    return [(np.full(n, forest_no), np.full(n, tree), nodes[uniq // nb // len(fs)], fs[(uniq // nb) % len(fs)], uniq % nb, c0, c1)]


def _best_splits(hist: DataFrame, metric: str | Column, min_leaf: int | Column, keys: Sequence[str] = ("tree", "node")) -> DataFrame:
    """T5: cumulative class counts over bins -> weighted child impurity; both
    children >= min_samples_leaf; strictly positive gain; lowest cost, then
    first feature, then lowest threshold. ``metric`` may be a column: true for gini, else entropy."""
    hist = hist.repartition(*keys)  # the windows and the choice of the split share this shuffle
    w = Window.partitionBy(*keys, "feature").orderBy("bin")
    wa = Window.partitionBy(*keys, "feature")
    h = (hist.withColumn("l0", F.sum("c0").over(w.rowsBetween(Window.unboundedPreceding, 0)))
         .withColumn("l1", F.sum("c1").over(w.rowsBetween(Window.unboundedPreceding, 0)))
         .withColumn("t0", F.sum("c0").over(wa)).withColumn("t1", F.sum("c1").over(wa)))
    h = h.withColumn("r0", F.col("t0") - F.col("l0")).withColumn("r1", F.col("t1") - F.col("l1"))

    def imp(a, b):
        if isinstance(metric, str):
            return impurity_expr(F.col(a), F.col(b), metric)
        return F.when(metric, impurity_expr(F.col(a), F.col(b), "gini")).otherwise(impurity_expr(F.col(a), F.col(b), "entropy"))

    nl, nr, n = F.col("l0") + F.col("l1"), F.col("r0") + F.col("r1"), F.col("t0") + F.col("t1")
    cost = (nl * imp("l0", "l1") + nr * imp("r0", "r1")) / n
    gain = imp("t0", "t1") - cost
    h = h.withColumn("cost", cost).withColumn("gain", gain) \
         .filter((nl >= min_leaf) & (nr >= min_leaf) & (F.col("gain") > 1e-12))
    return h.groupBy(*keys).agg(
        F.min_by(F.struct("feature", "bin", "l0", "l1", "r0", "r1", "gain", "cost"),
                 F.struct("cost", "feature", "bin")).alias("b")).select(*keys, "b.*")


# ----------------------------------------------------------------------------- T7-T10

def _tree_leaves(model: Forest, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """labels and P(1) of every tree for a batch of raw feature rows."""
    labels = np.zeros((len(x), len(model.trees)), dtype=np.int8)
    p1 = np.zeros((len(x), len(model.trees)))
    rows = np.arange(len(x))
    for t, tr in enumerate(model.trees):
        node = np.zeros(len(x), dtype=np.int64)
        for _ in range(int(tr["depth"].max()) if len(tr["depth"]) else 0):
            f = tr["feat"][node]
            split = f >= 0
            if not split.any():
                break
            v = x[rows, np.where(split, f, 0)]
            node = np.where(split, np.where(v > tr["thr"][node], tr["right"][node], tr["left"][node]), node)
        c0, c1 = tr["c0"][node], tr["c1"][node]
        labels[:, t] = (c1 > c0).astype(np.int8)
        p1[:, t] = np.where(c0 + c1 > 0, c1 / np.maximum(c0 + c1, 1e-300), 0.0)
    return labels, p1


def predict_forest(df: DataFrame, model: Forest, vote: str = "soft", threshold: float = 0.5,
                   prefix: str = "") -> DataFrame:
    """Adds ``prediction``, ``confidence`` and ``probability`` (array [1-p, p],
    p = mean tree P(1)). Hard vote: majority of tree labels, tie -> 1; confidence =
    share of trees agreeing. Soft vote: mean P(1) >= threshold."""
    feats = model.features
    bc = df.sparkSession.sparkContext.broadcast(model)
    out_schema = T.StructType(df.schema.fields + [
        T.StructField(prefix + "prediction", T.IntegerType()), T.StructField(prefix + "confidence", T.DoubleType()),
        T.StructField(prefix + "probability", T.ArrayType(T.DoubleType()))])

    def kernel(batches):
        m = bc.value
        for pdf in batches:
            x = pdf[feats].to_numpy(dtype=np.float64)
            labels, p1 = _tree_leaves(m, x)
            p = p1.mean(axis=1) if len(m.trees) else np.zeros(len(x))
            if vote == "hard":
                share1 = labels.mean(axis=1)
                pred = (share1 >= 0.5).astype(np.int32)
                conf = np.where(pred == 1, share1, 1.0 - share1)
            else:
                pred = (p >= threshold).astype(np.int32)
                conf = np.where(pred == 1, p, 1.0 - p)
            pdf[prefix + "prediction"] = pred
            pdf[prefix + "confidence"] = conf
            pdf[prefix + "probability"] = list(np.stack([1.0 - p, p], axis=1))
            yield pdf

    return df.mapInPandas(kernel, out_schema)


def predict_forests(df: DataFrame, features: Sequence[str], label: str, models: Sequence[tuple[int, Forest, dict]]) -> DataFrame:
    """(candidate_id, label, prediction, p1): every row by each of ``models`` (candidate, forest, parameters), in one pass.

    Candidates that share a forest share its walk."""
    shared = df.sparkSession.sparkContext.broadcast(list(models))

    def kernel(batches):
        for pdf in batches:
            x = pdf[[f"f{i}" for i in range(len(features))]].to_numpy(dtype=np.float64)
            done: dict[int, tuple] = {}
            for candidate, forest, params in shared.value:
                if id(forest) not in done:
                    done[id(forest)] = _tree_leaves(forest, x)
                labels, p1 = done[id(forest)]
                p = p1.mean(axis=1) if len(forest.trees) else np.zeros(len(x))
                hard = params.get("vote", "soft") == "hard"
                ones = (labels.mean(axis=1) >= 0.5) if hard else (p >= params.get("threshold", 0.5))
                yield pd.DataFrame({"candidate_id": np.int32(candidate), label: pdf["y"], "prediction": ones.astype(np.int32), "p1": p})

    kind = df.schema[label].dataType.simpleString()
    given = df.select(*[F.col(c).cast("double").alias(f"f{i}") for i, c in enumerate(features)], F.col(label).alias("y"))
    return given.mapInPandas(kernel, f"candidate_id int, `{label}` {kind}, prediction int, p1 double")


def importances(spark, model: Forest) -> DataFrame:
    """Mean impurity decrease, normalised per tree, averaged over trees."""
    tot = np.zeros(len(model.features))
    for tr in model.trees:
        imp = np.zeros(len(model.features))
        for i in range(len(tr["feat"])):
            f = int(tr["feat"][i])
            if f < 0:
                continue
            l, r = int(tr["left"][i]), int(tr["right"][i])
            n, nl, nr = tr["c0"][i] + tr["c1"][i], tr["c0"][l] + tr["c1"][l], tr["c0"][r] + tr["c1"][r]
            imp[f] += n * tr["imp"][i] - nl * tr["imp"][l] - nr * tr["imp"][r]
        if imp.sum() > 0:
            tot += imp / imp.sum()
    tot = tot / max(len(model.trees), 1)
    return spark.createDataFrame([(f, float(v)) for f, v in zip(model.features, tot)], "feature string, importance double")


# ----------------------------------------------------------------------------- T12

def fit_forest_ml(df: DataFrame, features: Sequence[str], label: str, n_trees: int = 100, max_depth: int = 15,
                  min_instances: int = 2, impurity: str = "gini", seed: int = 42):
    """The library baseline, Spark ML's RandomForestClassifier."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler
    va = VectorAssembler(inputCols=list(features), outputCol="_features", handleInvalid="keep")
    rf = RandomForestClassifier(featuresCol="_features", labelCol=label, numTrees=n_trees, maxDepth=min(max_depth, 30),
                                minInstancesPerNode=min_instances, impurity=impurity,
                                featureSubsetStrategy="sqrt", seed=seed)
    return Pipeline(stages=[va, rf]).fit(df.withColumn(label, F.col(label).cast("double")))
