"""Support vector regression (R rows), re-aimed to distributed primal training.

The reference solves the dual with a pair-wise solver on one machine. Here the
same objective, 1/2 |w|^2 + C * sum(max(0, |y - f(x)| - eps)), is minimised in
a reduced feature space: phi(x) = k(x, L) K_LL^(-1/2) for m landmarks L (the
Nystroem map; phi(x) = x for the linear kernel). Training is iteratively
re-weighted least squares: every iteration is ONE pass over the data in which
each task adds its weighted Gram matrix and right-hand side; the matrices are
cut into rows, which Spark's vector Summarizer adds by key in two steps; the
(m+1)^2 system is solved on the driver. The data never leave the executors.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace
from functools import reduce
from typing import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.hashing import row_hash
from quarry.plans.parallel import spread

# Near-zero guard and auto-epsilon factor.
NEAR_ZERO = 1e-12
EPSILON_SCALE = 0.1
DEFAULT_EPSILON = 0.1
KERNELS = ("linear", "poly", "rbf", "sigmoid")


class SVRError(ValueError):
    pass


# ----------------------------------------------------------------------------- R1-R3

def kernel_matrix(a: np.ndarray, b: np.ndarray, kernel: str, gamma: float, coef0: float = 0.0,
                  degree: int = 3) -> np.ndarray:
    """Linear, poly (gamma<x,y> + c)^d with a clipped base, rbf with clamped
    squared distances, sigmoid tanh(gamma<x,y> + c)."""
    a = np.atleast_2d(a).astype(np.float64)
    b = np.atleast_2d(b).astype(np.float64)
    if kernel == "linear":
        return a @ b.T
    if kernel == "poly":
        max_base = 1e300 ** (1.0 / degree) if degree > 0 else np.inf
        return np.clip(gamma * (a @ b.T) + coef0, -max_base, max_base) ** degree
    if kernel == "rbf":
        sq, ab = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :], a @ b.T
        ab *= 2.0
        sq -= ab
        np.maximum(sq, 0.0, out=sq)
        sq *= -gamma
        return np.exp(sq, out=sq)
    if kernel == "sigmoid":
        return np.tanh(gamma * (a @ b.T) + coef0)
    raise SVRError(f"unknown kernel {kernel!r}")


def resolve_gamma(df: DataFrame, cols: Sequence[str], gamma="scale") -> float:
    """R2: 'scale' = 1/(d * variance of all entries) from one aggregation;
    'auto' = 1/d; near-zero variance -> 1; clipped to [1e-12, 1e12]."""
    d = len(cols)
    if isinstance(gamma, (int, float)):
        return float(gamma)
    g = str(gamma).lower()
    if g == "auto":
        val = 1.0 / d
    elif g == "scale":
        r = df.agg(F.sum(sum(F.col(c).cast("double") for c in cols)).alias("s"),
                   F.sum(sum(F.col(c).cast("double") * F.col(c).cast("double") for c in cols)).alias("ss"),
                   F.count(F.lit(1)).alias("n")).first()
        cnt = r["n"] * d
        var = (r["ss"] / cnt - (r["s"] / cnt) ** 2) if cnt else 0.0
        if var < NEAR_ZERO:
            return 1.0
        val = 1.0 / (d * var)
    else:
        raise SVRError(f"invalid gamma {gamma!r}")
    return float(np.clip(val, NEAR_ZERO, 1.0 / NEAR_ZERO))


def resolve_epsilon(df: DataFrame, y: str, eps="auto") -> float:
    """R3: 'auto' = 0.1 * population std of y (at least 1e-12)."""
    if isinstance(eps, (int, float)):
        return float(eps)
    if str(eps).lower() != "auto":
        raise SVRError(f"invalid epsilon {eps!r}")
    s = df.agg(F.stddev_pop(F.col(y).cast("double"))).first()[0] or 0.0
    return max(EPSILON_SCALE * s, NEAR_ZERO)


# ----------------------------------------------------------------------------- model

@dataclass
class SVRModel:
    cols: list
    kernel: str
    gamma: float
    coef0: float
    degree: int
    C: float
    epsilon: float
    landmarks: np.ndarray | None   # m x d (None for linear)
    proj: np.ndarray | None        # m x r Nystroem projection K_LL^(-1/2)
    w: np.ndarray
    b: float
    objective: list

    def features(self, x: np.ndarray) -> np.ndarray:
        if self.kernel == "linear":
            return x
        return kernel_matrix(x, self.landmarks, self.kernel, self.gamma, self.coef0, self.degree) @ self.proj

    def predict_np(self, x: np.ndarray) -> np.ndarray:
        if len(x) == 0:
            return np.zeros(0)
        return self.features(x) @ self.w + self.b


def _landmarks(df: DataFrame, cols: list[str], m: int, seed: int, key) -> np.ndarray:
    """m rows by hash order: a bounded top-k, never a full sort."""
    h = row_hash(key, seed) if key else F.xxhash64(*[F.col(c) for c in cols], F.lit(seed))
    rows = df.withColumn("_h", h).orderBy("_h").limit(m).select(*cols).collect()
    return np.array([[float(v) for v in r] for r in rows], dtype=np.float64)


def _nystroem(L: np.ndarray, kernel, gamma, coef0, degree) -> np.ndarray:
    K = kernel_matrix(L, L, kernel, gamma, coef0, degree)
    K = (K + K.T) / 2.0
    vals, vecs = np.linalg.eigh(K)
    keep = vals > max(vals.max(), 0) * 1e-10
    return vecs[:, keep] / np.sqrt(vals[keep])[None, :]


#: Tasks whose partial sums are added first, before those sums are: bounds what one adding task reads.
SUMMED_TASKS = 256


#: Rows whose features are computed at once: their matrices stay in a core's cache.
BLOCK_ROWS = 2048


def fit_svr(df: DataFrame, cols: Sequence[str], y: str, kernel: str = "auto", C: float = 1.0, epsilon="auto",
            gamma="scale", coef0: float = 0.0, degree: int = 3, n_landmarks: int = 200, max_iter: int = 15,
            tol: float = 1e-4, seed: int = 42, key=None, delta: float = 1e-3) -> SVRModel:
    """R4. Returns the model with the objective value of every iterate; the best
    iterate is kept, so the recorded objective of the model never increases.

    ``kernel="auto"`` is the linear kernel. Rows with a missing (null or NaN) feature or target are
    left out; a table without any other row raises SVRError.
    """
    return fit_svrs(df, cols, y, [dict(kernel=kernel, C=C, epsilon=epsilon, gamma=gamma, coef0=coef0, degree=degree,
                                       n_landmarks=n_landmarks, max_iter=max_iter, tol=tol, seed=seed)], key, delta)[0]


@dataclass
class _Fit:
    """One of the fits that share their passes."""
    model: SVRModel
    at: int                        # which of the distinct feature maps it uses
    max_iter: int
    tol: float
    beta: np.ndarray | None = None
    best: np.ndarray | None = None
    best_obj: float = math.inf
    prev: float = math.inf

    def take(self, A: np.ndarray, c: np.ndarray, loss: float) -> bool:
        """The next iterate from the sums of a pass; whether another pass is wanted."""
        r = len(c) - 1
        if self.beta is not None:
            obj = 0.5 * float(self.beta[:r] @ self.beta[:r]) + self.model.C * loss
            self.model.objective.append(obj)
            if obj < self.best_obj:
                self.best, self.best_obj = self.beta, obj
            if abs(self.prev - obj) <= self.tol * max(1.0, abs(obj)):
                return False
            self.prev = obj
            if not A.any():
                return False
        reg = np.eye(r + 1)
        reg[r, r] = 1e-10
        self.beta = np.linalg.solve(reg + A, c)
        if self.best is None:
            self.best = self.beta
        return len(self.model.objective) < self.max_iter


def _pass(data: DataFrame, fits: dict[int, _Fit], delta: float) -> dict[int, tuple[np.ndarray, np.ndarray, float]]:
    """The Gram matrix, the right side and the loss of each fit in one pass: each task's matrices are cut into their rows,
    which are added by key, so no task reads a matrix from every other one. Fits with the same feature map share its values."""
    maps: dict[int, list] = {}
    for i, f in fits.items():
        maps.setdefault(f.at, [f.model, []])[1].append((i, f.model.C, f.model.epsilon, f.beta))
    shared = [(replace(m, w=None, objective=[]), own) for m, own in maps.values()]
    bc = data.sparkSession.sparkContext.broadcast(shared)

    def kern(batches):
        from pyspark import TaskContext
        sums = {i: None for _, own in bc.value for i, *_ in own}
        for b in batches:
            whole = np.column_stack([x.to_numpy(zero_copy_only=False) for x in b.columns])
            for at in range(0, len(whole), BLOCK_ROWS):
                x, yy = np.ascontiguousarray(whole[at:at + BLOCK_ROWS, :-1]), whole[at:at + BLOCK_ROWS, -1]
                for mdl, own in bc.value:
                    ph = np.hstack([mdl.features(x), np.ones((len(x), 1))])
                    for i, C, epsilon, beta in own:
                        if sums[i] is None:
                            sums[i] = [np.zeros((ph.shape[1], ph.shape[1])), np.zeros(ph.shape[1]), 0.0]
                        if beta is None:
                            s, t, used = np.full(len(yy), C), yy, ph
                        else:
                            res = yy - ph @ beta
                            out = np.abs(res) - epsilon
                            sums[i][2] += np.maximum(out, 0.0).sum()
                            outside = np.flatnonzero(out > 0)  # the others weigh nothing
                            s = C / np.maximum(out[outside], delta)
                            t = yy[outside] - np.sign(res[outside]) * epsilon
                            used = ph[outside] if len(outside) < len(ph) else ph
                        sums[i][1] += used.T @ (s * t)
                        used = used * np.sqrt(s)[:, None]
                        sums[i][0] += used.T @ used
        rows = [(i, part, v) for i, found in sums.items() if found is not None
                for part, v in enumerate([*found[0], found[1], np.array([found[2]])])]
        lot = TaskContext.get().partitionId() // SUMMED_TASKS
        yield pa.RecordBatch.from_arrays(
            [pa.array([i for i, _, _ in rows], pa.int32()), pa.array([part for _, part, _ in rows], pa.int32()),
             pa.array([lot] * len(rows), pa.int32()), pa.array([v for _, _, v in rows], pa.list_(pa.float64()))],
            ["fit", "part", "lot", "v"])

    total = Summarizer.sum(F.col("v")).alias("v")
    part = data.mapInArrow(kern, "fit int, part int, lot int, v array<double>").select("fit", "part", "lot", array_to_vector("v").alias("v"))
    summed = part.groupBy("fit", "part", "lot").agg(total).groupBy("fit", "part").agg(total)
    found: dict[int, dict] = {i: {} for i in fits}
    for x in summed.select("fit", "part", vector_to_array("v").alias("v")).collect():
        found[x["fit"]][x["part"]] = np.asarray(x["v"])
    bc.unpersist()
    return {i: (np.array([v[p] for p in range(len(v) - 2)]), v[len(v) - 2], float(v[len(v) - 1][0])) for i, v in found.items()}


def fit_svrs(df: DataFrame, cols: Sequence[str], y: str, fits: Sequence[dict], key=None, delta: float = 1e-3,
             kept: bool = False) -> list[SVRModel]:
    """R4 for several sets of parameters of ``fit_svr`` at once: each pass over the rows serves every fit that isn't ready yet,
    and fits with the same kernel and landmarks share its values. ``kept``: the caller has persisted the rows."""
    given = {"kernel": "auto", "C": 1.0, "epsilon": "auto", "gamma": "scale", "coef0": 0.0, "degree": 3, "n_landmarks": 200,
             "max_iter": 15, "tol": 1e-4, "seed": 42}
    fits = [{**given, **f} for f in fits]
    for f in fits:
        if unknown := set(f) - set(given):
            raise TypeError(f"unknown parameters {sorted(unknown)}")
        f["kernel"] = "linear" if f["kernel"] == "auto" else f["kernel"]
        if f["kernel"] not in KERNELS:
            raise SVRError(f"unknown kernel {f['kernel']!r}")
    cols = list(cols)
    own = [f"x{i}" for i in range(len(cols))]
    doubles = [F.col(c).cast("double") for c in dict.fromkeys([*cols, y])]
    df = df.filter(reduce(lambda a, b: a & b, [x.isNotNull() & ~F.isnan(x) for x in doubles]))
    data = df.select(*[F.col(c).cast("double").alias(x) for c, x in zip(cols, own)],
                     F.col(y).cast("double").alias("y"))
    if not kept:
        data = spread(data).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if data.isEmpty():
            raise SVRError("no row has all features and the target")
        once: dict = {}

        def known(name, make, *by):
            if (name, *by) not in once:
                once[name, *by] = make()
            return once[name, *by]

        running, maps = [], {}
        for f in fits:
            kernel, g, L, P = f["kernel"], 0.0, None, None
            if kernel != "linear":
                g = known("gamma", lambda: resolve_gamma(data, own, f["gamma"]), f["gamma"])
                L = known("landmarks", lambda: _landmarks(df, cols, f["n_landmarks"], f["seed"], key), f["n_landmarks"], f["seed"])
            at = (kernel, g, f["coef0"], f["degree"], f["n_landmarks"], f["seed"]) if kernel != "linear" else (kernel,)
            if L is not None:
                P = known("proj", lambda: _nystroem(L, kernel, g, f["coef0"], f["degree"]), at)
            eps = known("epsilon", lambda: resolve_epsilon(data, "y", f["epsilon"]), f["epsilon"])
            model = SVRModel(cols, kernel, g, f["coef0"], f["degree"], float(f["C"]), eps, L, P, None, 0.0, [])
            running.append(_Fit(model, maps.setdefault(at, len(maps)), f["max_iter"], f["tol"]))
        left = dict(enumerate(running))
        while left:
            sums = _pass(data, left, delta)
            left = {i: f for i, f in left.items() if f.take(*sums[i])}
    finally:
        if not kept:
            data.unpersist()
    for f in running:
        r = len(f.best) - 1
        f.model.w, f.model.b = f.best[:r], float(f.best[r])
    return [f.model for f in running]


# ----------------------------------------------------------------------------- R5-R8

def epsilon_insensitive_loss(df: DataFrame, y: str, pred: str, epsilon: float, group_by=None) -> DataFrame:
    """R5 data term: sum(max(|y - f| - eps, 0)) and its mean, per group."""
    g = [group_by] if isinstance(group_by, str) else list(group_by or [])
    e = F.greatest(F.abs(F.col(y).cast("double") - F.col(pred).cast("double")) - F.lit(float(epsilon)), F.lit(0.0))
    ex = [F.sum(e).alias("loss"), F.avg(e).alias("mean_loss"),
          F.sum((e > 0).cast("long")).alias("n_outside")]
    return df.groupBy(*g).agg(*ex) if g else df.agg(*ex)


def svr_objective(df: DataFrame, model: SVRModel, y: str) -> float:
    p = predict_svr(df, model, "_p")
    loss = epsilon_insensitive_loss(p, y, "_p", model.epsilon).first()["loss"] or 0.0
    return 0.5 * float(model.w @ model.w) + model.C * loss


def predict_svr(df: DataFrame, model: SVRModel, out: str = "prediction") -> DataFrame:
    """Block-wise prediction with the broadcast landmarks and weights; null where a feature is missing."""
    missing = [c for c in model.cols if c not in df.columns]
    if missing:
        raise SVRError(f"missing feature columns {missing}")
    bc = df.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType(df.schema.fields + [T.StructField(out, T.DoubleType())])

    def kern(batches):
        m = bc.value
        for pdf in batches:
            x = pdf[m.cols].to_numpy(dtype=np.float64, na_value=np.nan)
            whole = ~np.isnan(x).any(axis=1)
            p = np.full(len(x), np.nan)
            p[whole] = m.predict_np(x[whole])
            pdf[out] = pd.Series(p, dtype="Float64").mask(~whole)
            yield pdf
    return df.mapInPandas(kern, schema)


def predict_svrs(df: DataFrame, label: str, models: Sequence[tuple[int, SVRModel]]) -> DataFrame:
    """(candidate_id, label, prediction): R6 of several numbered models with the same columns in one pass over the rows."""
    bc = df.sparkSession.sparkContext.broadcast([(i, replace(m, objective=[])) for i, m in models])
    cols = list(models[0][1].cols)
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise SVRError(f"missing feature columns {missing}")

    def kern(batches):
        for b in batches:
            if not b.num_rows:
                continue
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in b.columns[1:]])
            whole = ~np.isnan(x).any(axis=1)
            for i, m in bc.value:
                p = np.full(len(x), np.nan)
                for at in range(0, len(x), BLOCK_ROWS):
                    rows = at + np.flatnonzero(whole[at:at + BLOCK_ROWS])
                    p[rows] = m.predict_np(x[rows])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), i, np.int32)), b.column(0), pa.array(p, mask=~whole)],
                                                 ["candidate_id", label, "prediction"])
    given = df.select(F.col(label), *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)])
    return given.mapInArrow(kern, T.StructType([T.StructField("candidate_id", T.IntegerType()), given.schema[0],
                                                T.StructField("prediction", T.DoubleType())]))


def support_rows(df: DataFrame, y: str, pred: str, epsilon: float, tol: float = 1e-3) -> DataFrame:
    """Rows on or outside the tube (non-negligible coefficient)."""
    return df.filter(F.abs(F.col(y) - F.col(pred)) >= F.lit(float(epsilon) - tol))


KERNEL_BINS = 4096


def kernel_stats(df: DataFrame, model: SVRModel) -> DataFrame:
    """Min, max, mean, std, var and exact median of the row x landmark kernel
    values: partial moments per batch, merged by Spark, then histograms that narrow
    the range around the middle until one value is left in it."""
    if model.kernel == "linear" or model.landmarks is None:
        raise SVRError("kernel statistics need landmarks")
    bc = df.sparkSession.sparkContext.broadcast(model)
    rows = df.select(*model.cols).dropna()

    def values(pdf):
        m = bc.value
        return kernel_matrix(pdf[m.cols].to_numpy(dtype=np.float64), m.landmarks, m.kernel, m.gamma, m.coef0,
                             m.degree).ravel()

    def moments(batches):
        for pdf in batches:
            if len(pdf):
                K = values(pdf)
                yield pd.DataFrame({"n": [K.size], "s": [K.sum()], "ss": [(K * K).sum()], "mn": [K.min()], "mx": [K.max()]})

    a = rows.mapInPandas(moments, "n long, s double, ss double, mn double, mx double").agg(
        F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("ss").alias("ss"), F.min("mn").alias("min"),
        F.max("mx").alias("max"))
    r = a.first()

    def middle(low: int, high: int) -> float:
        """The mean of the values of two ranks, equal or neighbours; each pass keeps the bin that holds both, until they
        part (then they are its last value and the next bin's first) or one value is left."""
        lo, hi, below = r["min"], r["max"], 0
        while True:
            def count(batches, lo=lo, hi=hi):
                for pdf in batches:
                    K = values(pdf) if len(pdf) else np.empty(0)
                    K = K[(K >= lo) & (K <= hi)]
                    if len(K):
                        at = np.minimum(((K - lo) / max(hi - lo, 1e-300) * KERNEL_BINS).astype(int), KERNEL_BINS - 1)
                        yield pd.DataFrame({"bin": at, "v": K}).groupby("bin", as_index=False).agg(
                            n=("v", "size"), lo=("v", "min"), hi=("v", "max"))
            bins = rows.mapInPandas(count, "bin int, n long, lo double, hi double").groupBy("bin").agg(
                F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi")).orderBy("bin").collect()
            for at, b in enumerate(bins):   # KERNEL_BINS at most
                if below + b["n"] > low:
                    break
                below += b["n"]
            if below + b["n"] <= high:
                return (b["hi"] + bins[at + 1]["lo"]) / 2
            if b["lo"] == b["hi"] or (b["lo"], b["hi"]) == (lo, hi):
                return b["lo"]
            lo, hi = b["lo"], b["hi"]

    n = r["n"]
    if not n:
        row = (None,) * 6
    else:
        mean = r["s"] / n
        var = r["ss"] / n - mean * mean
        row = (r["min"], r["max"], mean, math.sqrt(max(var, 0.0)), var, float(middle((n - 1) // 2, n // 2)))
    return df.sparkSession.createDataFrame([row], "min double, max double, mean double, std double, var double, median double")


# ----------------------------------------------------------------------------- R10-R13

def prediction_grid(df: DataFrame, model: SVRModel, f1: str, f2: str, resolution: int = 50) -> DataFrame:
    """Grid over two features (their range +- 0.5), other features at their
    mean; prediction and the epsilon-tube bounds. Size resolution^2, not data-sized."""
    st = df.agg(*[F.avg(c).alias(f"m_{c}") for c in model.cols],
                F.min(f1).alias("a1"), F.max(f1).alias("b1"), F.min(f2).alias("a2"), F.max(f2).alias("b2")).first()
    spark = df.sparkSession
    lo1, hi1, lo2, hi2 = st["a1"] - 0.5, st["b1"] + 0.5, st["a2"] - 0.5, st["b2"] + 0.5
    g = (spark.range(resolution).select(F.col("id").alias("i"))
         .select("i", F.explode(F.sequence(F.lit(0), F.lit(resolution - 1))).alias("j")))
    cols = []
    for c in model.cols:
        if c == f1:
            cols.append((F.lit(lo1) + (hi1 - lo1) * F.col("i") / (resolution - 1)).alias(c))
        elif c == f2:
            cols.append((F.lit(lo2) + (hi2 - lo2) * F.col("j") / (resolution - 1)).alias(c))
        else:
            cols.append(F.lit(float(st[f"m_{c}"])).alias(c))
    p = predict_svr(g.select("i", "j", *cols), model)
    return p.withColumn("tube_low", F.col("prediction") - model.epsilon) \
            .withColumn("tube_high", F.col("prediction") + model.epsilon)


def contour_levels(grid: DataFrame, n_contours: int = 10) -> DataFrame:
    """(level_id from 1, level) - the ``n_contours`` values that part the range of the grid's predictions evenly -
    and for each the grid cells that the contour crosses: (level_id, level, i, j), cells by their lower corner.

    A cell is crossed where its four corners aren't all on one side. A flat surface has no contours."""
    step = (F.max("prediction") - F.min("prediction")) / (n_contours + 1)
    levels = (grid.agg(F.min("prediction").alias("low"), step.alias("step")).filter("step > 0")
              .select(F.explode(F.sequence(F.lit(1), F.lit(n_contours))).alias("level_id"), "low", "step")
              .select("level_id", (F.col("low") + F.col("step") * F.col("level_id")).alias("level")))
    # each corner belongs to up to four cells
    shifts = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (0, 1) for b in (0, 1)])
    cells = (grid.select("i", "j", "prediction", F.explode(shifts).alias("s"))
             .groupBy((F.col("i") - F.col("s.a")).alias("i"), (F.col("j") - F.col("s.b")).alias("j"))
             .agg(F.min("prediction").alias("low"), F.max("prediction").alias("high"), F.count(F.lit(1)).alias("corners"))
             .filter("corners = 4"))
    named = levels.agg(F.collect_list(F.struct("level_id", "level")).alias("levels")).withColumn("one", F.lit(1))  # one row
    crossed = F.filter("levels", lambda x: (x["level"] > F.col("low")) & (x["level"] <= F.col("high")))
    return (cells.withColumn("one", F.lit(1)).join(F.broadcast(named), "one")
            .select("i", "j", F.explode(crossed).alias("x")).select("x.level_id", "x.level", "i", "j"))


def stratified_top(df: DataFrame, pred: str, weight: str, bins: int = 5, n: int = 10,
                   key: Sequence[str] = ()) -> DataFrame:
    """Bin rows by prediction into max(bins, 5) equal-width bins, keep the
    top n by |weight|, then ``key``, in each bin (a per-bin top-k)."""
    from pyspark.sql import Window
    nb = max(bins, 5)
    mm = df.agg(F.min(pred).alias("a"), F.max(pred).alias("b")).first()
    if mm["a"] is None:  # no rows, or none with a prediction: all are in one bin without a number
        mm = {"a": 0.0, "b": 0.0}
    w = ((mm["b"] + 1e-9) - mm["a"]) / nb
    b = F.least(F.floor((F.col(pred) - F.lit(mm["a"])) / F.lit(w)), F.lit(nb - 1)).cast("int")
    win = Window.partitionBy("bin").orderBy(F.desc(F.abs(F.col(weight))), *key)
    return df.withColumn("bin", b).withColumn("_r", F.row_number().over(win)).filter(F.col("_r") <= n).drop("_r")


def compare_grids(df: DataFrame, models: dict, f1: str, f2: str, resolution: int = 30) -> DataFrame:
    """R10 for several models in one table with a ``model`` column."""
    out = None
    for name, m in models.items():
        g = prediction_grid(df, m, f1, f2, resolution).withColumn("model", F.lit(name))
        out = g if out is None else out.unionByName(g)
    return out


def fit_baseline_regressor(df: DataFrame, cols: Sequence[str], y: str, kind: str = "huber"):
    """Library baseline (Spark ML has no SVR): Huber linear regression or GBT."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor, LinearRegression
    va = VectorAssembler(inputCols=list(cols), outputCol="_features")
    est = (LinearRegression(featuresCol="_features", labelCol=y, loss="huber") if kind == "huber"
           else GBTRegressor(featuresCol="_features", labelCol=y, maxIter=50, maxDepth=5))
    return Pipeline(stages=[va, est]).fit(df)


def kernel_features(df: DataFrame, cols: Sequence[str], landmarks: np.ndarray, kernel: str = "rbf",
                    gamma: float = 1.0, coef0: float = 0.0, degree: int = 3, out: str = "k") -> DataFrame:
    """R1 as a column: k(x, L) for every row against broadcast landmarks (array<double>)."""
    cols = list(cols)
    bc = df.sparkSession.sparkContext.broadcast(np.asarray(landmarks, dtype=np.float64))
    schema = T.StructType(df.schema.fields + [T.StructField(out, T.ArrayType(T.DoubleType()))])

    def kern(batches):
        L = bc.value
        for pdf in batches:
            x = pdf[cols].to_numpy(dtype=np.float64)
            pdf[out] = list(kernel_matrix(x, L, kernel, gamma, coef0, degree)) if len(pdf) else []
            yield pdf
    return df.mapInPandas(kern, schema)


def hash_landmarks(df: DataFrame, cols: Sequence[str], m: int, key, seed: int, hash_method: str = "xxhash64"):
    """Landmark rows chosen by hash order of the key (bounded top-m)."""
    h = row_hash(key, seed, hash_method)
    keys = [key] if isinstance(key, str) else list(key)
    rows = df.withColumn("_h", h).orderBy("_h", *keys).limit(m).select(*cols).collect()
    return np.array([[float(v) for v in r] for r in rows], dtype=np.float64)
