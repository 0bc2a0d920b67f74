"""Shapley explanations (X rows), exact for linear models and forests and sampled for any other model.

A linear model's values are the same in every order of the features: weight x
(value - background mean), which are plain columns.

A forest's values come from its node tables: a leaf is reached by the features
that come from the explained row and those that come from a background row where
both kinds agree with its path, so each leaf adds closed-form weights; rows and
background rows that agree with the same parts of a path are handled once.

Permutation sampling (Strumbelj & Kononenko) with antithetic permutation
pairs, against a small hash-chosen background sample that is broadcast.
Every Arrow batch of explained rows expands row x permutation x background
x (d + 1) feature switches in NumPy blocks and scores them with a shippable
scoring function (a plain NumPy callable built from a model's small state).
Contributions telescope, so sum(shap) + base = prediction exactly.
"""

from __future__ import annotations

import math
from typing import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.hashing import row_hash
from quarry.plans.joins import join_groups
from quarry.plans.parallel import spread
from quarry.plans.quantiles import fresh_name, group_quantiles
from quarry.session import cut_lineage

# Reference sizes for the background sample, waterfall length and decision rows.
BACKGROUND_SAMPLES = 50
WATERFALL_MAX_DISPLAY = 10
DECISION_ROWS = 20


class LinearScorer:
    """f(x) = x . w + b (picklable)."""

    def __init__(self, weights: Sequence[float], intercept: float = 0.0):
        self.w = np.asarray(weights, dtype=np.float64)
        self.b = float(intercept)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return x @ self.w + self.b


class ForestScorer:
    """P(1) of a fitted quarry forest (mean tree probability)."""

    def __init__(self, model):
        self.model = model

    def __call__(self, x: np.ndarray) -> np.ndarray:
        from quarry.operators.forest import _tree_leaves
        _, p1 = _tree_leaves(self.model, x)
        return p1.mean(axis=1) if p1.shape[1] else np.zeros(len(x))


class SVRScorer:
    def __init__(self, model):
        self.model = model

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return self.model.predict_np(x)


def background(df: DataFrame, cols: Sequence[str], n: int = BACKGROUND_SAMPLES, key=None, seed: int = 0,
               hash_method: str = "xxhash64") -> np.ndarray:
    """N rows by hash order of the key (bounded top-n)."""
    keys = [key] if isinstance(key, str) else list(key or [])
    h = row_hash(keys, seed, hash_method) if keys else F.xxhash64(*[F.col(c) for c in cols], F.lit(seed))
    rows = df.withColumn("_h", h).orderBy("_h", *keys).limit(n).select(*cols).collect()
    return np.array([[float(v) for v in r] for r in rows], dtype=np.float64)


def _permutations(d: int, n_perm: int, seed: int) -> list[np.ndarray]:
    rng = np.random.default_rng(seed)
    perms = []
    for _ in range(max(1, n_perm // 2)):
        p = rng.permutation(d)
        perms += [p, p[::-1]]          # antithetic pair
    return perms


def _shap_block(f: Callable, x: np.ndarray, bg: np.ndarray, perms: list[np.ndarray]) -> np.ndarray:
    n, d = x.shape
    B = len(bg)
    phi = np.zeros((n, d))
    for p in perms:
        z = np.broadcast_to(bg[None, :, :], (n, B, d)).copy()
        prev = f(z.reshape(-1, d)).reshape(n, B)
        for j in p:
            z[:, :, j] = x[:, j][:, None]
            cur = f(z.reshape(-1, d)).reshape(n, B)
            phi[:, j] += (cur - prev).mean(axis=1)
            prev = cur
    return phi / len(perms)


def _leaves(tree: dict) -> list[tuple[float, np.ndarray, np.ndarray, np.ndarray]]:
    """(P(1), features on the path, lower and upper bound of each) of the leaves: a row passes where lower < x <= upper."""
    out, stack = [], [(0, {})]
    while stack:
        node, bounds = stack.pop()
        f = int(tree["feat"][node])
        if f < 0:
            n = tree["c0"][node] + tree["c1"][node]
            names = sorted(bounds)
            out.append((float(tree["c1"][node] / n) if n > 0 else 0.0, np.array(names, dtype=int),
                        np.array([bounds[c][0] for c in names]), np.array([bounds[c][1] for c in names])))
            continue
        lo, hi = bounds.get(f, (-np.inf, np.inf))
        t = float(tree["thr"][node])
        stack.append((int(tree["left"][node]), {**bounds, f: (lo, min(hi, t))}))
        stack.append((int(tree["right"][node]), {**bounds, f: (max(lo, t), hi)}))
    return out


def _passes(x: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """For each row the set of a path's features that it passes, as bits. Missing values are below every bound."""
    inside = ~(x > hi) & ((x > lo) | np.isneginf(lo))
    return inside @ (1 << np.arange(len(lo), dtype=np.int64))


def forest_shapley(model, x: np.ndarray, bg: np.ndarray) -> np.ndarray:
    """Exact interventional Shapley values of the mean tree probability, rows x features.

    With ``a`` features of a path passed by the row only and ``b`` by the background row only (and none by neither),
    the leaf adds its value over a * C(a+b, a) to each of the former and takes it over b * C(a+b, b) from the latter."""
    phi = np.zeros(x.shape)
    most = max((int(t["depth"].max()) for t in model.trees if len(t["depth"])), default=0) + 1
    share = np.array([[1.0 / (a * math.comb(a + b, a)) if a else 0.0 for b in range(most + 1)] for a in range(most + 1)])
    for tree in model.trees:
        for value, feats, lo, hi in _leaves(tree):
            if not value or not len(feats):
                continue
            own, place = np.unique(_passes(x[:, feats], lo, hi), return_inverse=True)
            other, times = np.unique(_passes(bg[:, feats], lo, hi), return_counts=True)
            mine, theirs = own[:, None] & ~other[None, :], ~own[:, None] & other[None, :]
            reached = (own[:, None] | other[None, :]) == (1 << len(feats)) - 1
            a, b = np.bitwise_count(mine), np.bitwise_count(theirs)
            gain = np.where(reached, share[np.minimum(a, most), np.minimum(b, most)], 0.0) * times
            loss = np.where(reached, share[np.minimum(b, most), np.minimum(a, most)], 0.0) * times
            for j, f in enumerate(feats.tolist()):
                each = (((mine >> j) & 1) * gain - ((theirs >> j) & 1) * loss).sum(axis=1)
                phi[:, f] += each[place] * (value / len(bg))
    return phi / max(len(model.trees), 1)


def shapley(df: DataFrame, f: Callable, cols: Sequence[str], bg: np.ndarray, id_cols: Sequence[str],
            n_permutations: int = 10, seed: int = 0, block_rows: int = 256, exact: bool = True) -> DataFrame:
    """Long table (id..., feature, value, shap_value, base_value, prediction);
    ``value`` is the explained row's feature value, so the per-feature views
    below need no join back to the data. A linear model's and a forest's values are exact unless
    ``exact`` is false; other models are sampled by ``n_permutations``."""
    cols = list(cols)
    ids = list(id_cols)
    if exact and isinstance(f, LinearScorer):
        return _linear_shapley(df, f, cols, np.asarray(bg, dtype=np.float64), ids)
    closed = exact and isinstance(f, ForestScorer) and list(f.model.features) == cols
    perms = _permutations(len(cols), n_permutations, seed)
    bc = df.sparkSession.sparkContext.broadcast((f, np.asarray(bg, dtype=np.float64), perms))
    id_fields = [df.schema[c] for c in ids]
    schema = T.StructType(id_fields + [T.StructField("feature", T.StringType()),
                                       T.StructField("value", T.DoubleType()),
                                       T.StructField("shap_value", T.DoubleType()),
                                       T.StructField("base_value", T.DoubleType()),
                                       T.StructField("prediction", T.DoubleType())])

    def kern(batches):
        fn, B, pm = bc.value
        base = float(np.mean(fn(B)))
        for pdf in batches:
            if not len(pdf):
                continue
            x = pdf[cols].to_numpy(dtype=np.float64)
            outs = []
            step = len(x) if closed else block_rows
            for s in range(0, len(x), step):
                xb = x[s:s + step]
                phi = forest_shapley(fn.model, xb, B) if closed else _shap_block(fn, xb, B, pm)
                pred = fn(xb)
                blk = pdf.iloc[s:s + step]
                for j, c in enumerate(cols):
                    o = blk[ids].copy()
                    o["feature"] = c
                    o["value"] = xb[:, j]
                    o["shap_value"] = phi[:, j]
                    o["base_value"] = base
                    o["prediction"] = pred
                    outs.append(o)
            yield pd.concat(outs, ignore_index=True)

    return spread(df.select(*ids, *cols)).mapInPandas(kern, schema)


def _linear_shapley(df: DataFrame, f: LinearScorer, cols: list[str], bg: np.ndarray, ids: list[str]) -> DataFrame:
    """X1 for f(x) = x . w + b: each order of the features adds w * (x - background value) for each background row. A row
    with a missing (null or NaN) feature has neither values nor a prediction."""
    base, means, own = float(np.mean(f(bg))), bg.mean(axis=0), fresh_name(ids, "_x")
    row = spread(df.select(*ids, F.array(*[F.nanvl(F.col(c).cast("double"), F.lit(None)) for c in cols]).alias(own)))
    x = [F.col(own)[j] for j in range(len(cols))]
    pred = sum((F.lit(float(w)) * v for w, v in zip(f.w, x)), F.lit(0.0)) + F.lit(f.b)  # null if any feature is
    whole = pred.isNotNull()
    parts = [F.struct(F.lit(c).alias("feature"), v.alias("value"), F.when(whole, F.lit(float(w)) * (v - F.lit(float(m)))).alias("shap_value"))
             for c, v, w, m in zip(cols, x, f.w, means)]
    long = row.select(*ids, F.explode(F.array(*parts)).alias("_s"), F.lit(base).alias("base_value"), pred.alias("prediction"))
    return long.select(*ids, "_s.feature", "_s.value", "_s.shap_value", "base_value", "prediction")


def shap_importance(shap: DataFrame) -> DataFrame:
    """Mean |shap| per feature."""
    return shap.groupBy("feature").agg(F.avg(F.abs("shap_value")).alias("mean_abs_shap"))


def shap_distribution(shap: DataFrame, bins: int = 10) -> DataFrame:
    """Exact shap quantiles per (feature, equal-width value bin) - beeswarm data."""
    mm = shap.groupBy("feature").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    j = shap.join(F.broadcast(mm), "feature")  # one row per feature
    w = (F.col("hi") - F.col("lo")) / bins
    b = F.when(w == 0, F.lit(0)).otherwise(F.least(F.floor((F.col("value") - F.col("lo")) / w), F.lit(bins - 1)))
    binned = cut_lineage(j.select("feature", b.cast("int").alias("bin"), "shap_value"))
    q = group_quantiles(binned, "shap_value", ["feature", "bin"], [0.05, 0.25, 0.5, 0.75, 0.95], "q")
    n = binned.groupBy("feature", "bin").agg(F.count(F.lit(1)).alias("n"))
    return join_groups(n, q, ["feature", "bin"], "left").select(
        "feature", "bin", "n", *[F.col("q")[i].alias(f"p{p}") for i, p in enumerate((5, 25, 50, 75, 95))])


def shap_waterfall(shap: DataFrame, id_cols: Sequence[str], max_display: int = WATERFALL_MAX_DISPLAY) -> DataFrame:
    """Per row, the top (max_display - 1) contributions by |shap| and the
    remaining ones summed as 'rest'."""
    ids = list(id_cols)
    w = Window.partitionBy(*ids).orderBy(F.desc(F.abs("shap_value")), "feature")  # one partition per row: d values
    r = shap.select(*ids, "feature", "shap_value", F.row_number().over(w).alias("position"),
                    F.sum("shap_value").over(w.rowsBetween(0, Window.unboundedFollowing)).alias("_rest"))
    last = F.col("position") == max_display  # the values are computed and shuffled once, for the first ones and the rest
    return r.filter(F.col("position") <= max_display).select(
        *ids, F.when(last, F.lit("rest")).otherwise(F.col("feature")).alias("feature"),
        F.when(last, F.col("_rest")).otherwise(F.col("shap_value")).alias("shap_value"), "position")


def shap_decision(shap: DataFrame, id_cols: Sequence[str]) -> DataFrame:
    """Per row, cumulative sum from the base value over features in order of
    increasing |shap| (the decision path ends at the prediction)."""
    ids = list(id_cols)
    w = (Window.partitionBy(*ids).orderBy(F.abs("shap_value"), "feature")
         .rowsBetween(Window.unboundedPreceding, 0))
    return shap.withColumn("path_value", F.col("base_value") + F.sum("shap_value").over(w)) \
               .select(*ids, "feature", "shap_value", "path_value")


def shap_dependence(shap: DataFrame, id_cols: Sequence[str], k: int = 10) -> DataFrame:
    """Feature value against shap value for the top-k features by mean |shap|."""
    ids = list(id_cols)
    imp = shap_importance(shap).collect()  # one row per feature
    feats = [r["feature"] for r in sorted(imp, key=lambda r: (-r["mean_abs_shap"], r["feature"]))[:k]]
    return shap.filter(F.col("feature").isin(feats)).select(*ids, "feature", "value", "shap_value")


#: Rows whose coalitions are laid out together.
INTERACTION_ROWS = 128


def _interactions(fn: Callable, B: np.ndarray, perms, x: np.ndarray) -> np.ndarray:
    """Sum over rows of |mean index over the orders| for each feature pair."""
    n, d = x.shape
    out = np.zeros((d, d))
    for i in range(d):
        for j in range(i + 1, d):
            index = np.zeros(n)
            for p in perms:
                pos = np.argsort(p)
                z = np.broadcast_to(B[None], (n, len(B), d)).copy()
                for s in p[:min(pos[i], pos[j])]:
                    z[:, :, s] = x[:, s][:, None]
                values = []
                for held in ((), (i,), (i, j), (j,)):
                    for s in (i, j):
                        z[:, :, s] = x[:, s][:, None] if s in held else B[None, :, s]
                    values.append(fn(z.reshape(-1, d)).reshape(n, len(B)).mean(axis=1))
                index += values[2] - values[1] - values[3] + values[0]
            out[i, j] = np.abs(index / len(perms)).sum()
    return out


def _pair_coalitions(d: int, perms) -> list[tuple[int, int, int]]:
    """(first feature, second, features that come before both as bits) for each pair and order."""
    out = []
    for i in range(d):
        for j in range(i + 1, d):
            for p in perms:
                pos = np.argsort(p)
                out.append((i, j, sum(1 << int(s) for s in p[:min(pos[i], pos[j])])))
    return out


def _forest_interactions(leaves: list, n_trees: int, B: np.ndarray, perms, x: np.ndarray) -> np.ndarray:
    """``_interactions`` of a forest from its leaves: a mixed row reaches a leaf where the features taken from the row and
    those taken from the background row each pass their part of the path. Only pairs on a leaf's path interact in it."""
    n, d = x.shape
    index = np.zeros((d, d, n))
    wanted = _pair_coalitions(d, perms)
    for value, feats, lo, hi in leaves:
        place_of = {int(c): k for k, c in enumerate(feats)}
        pairs = [(i, j, before) for i, j, before in wanted if i in place_of and j in place_of]
        if not value or not pairs:
            continue
        full = (1 << len(feats)) - 1
        own, place = np.unique(_passes(x[:, feats], lo, hi), return_inverse=True)
        other, times = np.unique(_passes(B[:, feats], lo, hi), return_counts=True)
        gains: dict[tuple[int, int], np.ndarray] = {}
        for i, j, before in pairs:
            held = sum(1 << k for c, k in place_of.items() if before >> c & 1)
            a, b = 1 << place_of[i], 1 << place_of[j]

            def reached(taken):
                mixed = (own[:, None] & taken) | (other[None, :] & (full & ~taken))
                return (mixed == full) @ times
            gain = reached(held | a | b) - reached(held | a) - reached(held | b) + reached(held)
            gains[i, j] = gains.get((i, j), 0) + gain
        for (i, j), gain in gains.items():
            index[i, j] += (gain * (value / len(B)))[place]
    return np.abs(index / (len(perms) * max(n_trees, 1))).sum(axis=2)


def shap_interactions(df: DataFrame, f: Callable, cols: Sequence[str], bg: np.ndarray, n_permutations: int = 6,
                      seed: int = 0) -> DataFrame:
    """Sampled Shapley interaction index per feature pair,
    E[f(S+i+j) - f(S+i) - f(S+j) + f(S)] with S the features placed before
    the pair in a random order, averaged over the orders for each row; mean |index|
    over rows, divided by its max."""
    cols = list(cols)
    d = len(cols)
    perms = _permutations(d, n_permutations, seed)
    bc = df.sparkSession.sparkContext.broadcast((f, np.asarray(bg, dtype=np.float64), perms))

    def kern(batches):
        fn, B, pm = bc.value
        by_leaf = isinstance(fn, ForestScorer) and list(fn.model.features) == cols
        leaves = [leaf for tree in fn.model.trees for leaf in _leaves(tree)] if by_leaf else []
        for pdf in batches:
            if not len(pdf):
                continue
            x = pdf[cols].to_numpy(dtype=np.float64)
            acc, n = np.zeros((d, d)), len(x)
            if by_leaf:
                acc += _forest_interactions(leaves, len(fn.model.trees), B, pm, x)
            else:
                for x in np.array_split(x, -(-n // INTERACTION_ROWS)):
                    acc += _interactions(fn, B, pm, x)
            rows = [(cols[i], cols[j], acc[i, j], n) for i in range(d) for j in range(i + 1, d)]
            yield pd.DataFrame(rows, columns=["feature_a", "feature_b", "s", "n"])

    part = spread(df.select(*cols)).mapInPandas(kern, "feature_a string, feature_b string, s double, n long")
    agg = part.groupBy("feature_a", "feature_b").agg((F.sum("s") / F.sum("n")).alias("strength"))
    mx = agg.agg(F.max("strength").alias("_m"))
    return join_groups(agg, mx, []).withColumn(
        "strength", F.when(F.col("_m") > 0, F.col("strength") / F.col("_m")).otherwise(F.col("strength"))).drop("_m")
