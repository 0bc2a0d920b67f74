"""Scalers (P5-P10, P16 for numbers).

``fit_scaler`` returns a small state table - one row per column - computed by
ONE aggregation over all columns (two or three for the power transform's
lambda search). ``transform``/``inverse_transform`` are pure projections, so
they also apply to streaming DataFrames.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pyspark import StorageLevel

from quarry.plans.parallel import spread
from quarry.plans.quantiles import column_quantiles

SCALERS = ("standard", "min_max", "max_abs", "robust", "power", "quantile")
DEFAULT_SCALER = "robust"
N_QUANTILES = 1000
#: Where the search for a power stops: data that want more have no useful power.
WIDEST_LAMBDA = 1e3


@dataclass
class ScalerState:
    method: str
    center: dict = field(default_factory=dict)
    scale: dict = field(default_factory=dict)
    lam: dict = field(default_factory=dict)          # power: Yeo-Johnson lambda
    knots: dict = field(default_factory=dict)        # quantile: sorted knots

    def to_table(self, spark) -> DataFrame:
        """One row for each column."""
        rows = [(c, self.method, _number(self.center.get(c)), _number(self.scale.get(c)), _number(self.lam.get(c)),
                 list(map(float, self.knots[c])) if c in self.knots else None)
                for c in sorted(set(self.center) | set(self.knots))]
        return spark.createDataFrame(rows, STATE_SCHEMA)

    @staticmethod
    def from_rows(rows) -> "ScalerState":
        st = ScalerState(rows[0]["method"] if rows else DEFAULT_SCALER)
        for r in rows:
            c = r["column"]
            if r["center"] is not None:
                st.center[c], st.scale[c] = r["center"], r["scale"]
            if r["lam"] is not None:
                st.lam[c] = r["lam"]
            if r["knots"] is not None:
                st.knots[c] = np.asarray(r["knots"], dtype=float)
        return st


STATE_SCHEMA = "column string, method string, center double, scale double, lam double, knots array<double>"


def _number(x) -> float | None:
    return None if x is None else float(x)


def _x(c: str) -> Column:
    return F.col(c).cast("double")


def fit_scaler(df: DataFrame, cols: Sequence[str], method: str = DEFAULT_SCALER) -> ScalerState:
    """P5 standard (population std; constant -> 1), P6 min-max (constant -> 0),
    P7 max-abs, P8 robust ((x - median)/IQR, linear quantiles; IQR 0 -> 1),
    P9 power (Yeo-Johnson, lambda by maximum likelihood, then standardised),
    P10 quantile (uniform output, <= 1000 knots).

    Quantiles are exact (linear interpolation), by narrowing bins of all columns in the same passes."""
    if method not in SCALERS:
        raise ValueError(f"unknown scaler {method!r}; expected one of {SCALERS}")
    cols = list(cols)
    st = ScalerState(method)
    if method == "standard":
        r = df.agg(*[F.avg(_x(c)).alias(f"m{i}") for i, c in enumerate(cols)],
                   *[F.stddev_pop(_x(c)).alias(f"s{i}") for i, c in enumerate(cols)]).first()
        for i, c in enumerate(cols):
            st.center[c] = r[f"m{i}"] or 0.0
            st.scale[c] = r[f"s{i}"] if r[f"s{i}"] else 1.0
    elif method == "min_max":
        r = df.agg(*[F.min(_x(c)).alias(f"a{i}") for i, c in enumerate(cols)],
                   *[F.max(_x(c)).alias(f"b{i}") for i, c in enumerate(cols)]).first()
        for i, c in enumerate(cols):
            lo, hi = r[f"a{i}"], r[f"b{i}"]
            st.center[c] = lo if lo is not None else 0.0
            st.scale[c] = (hi - lo) if (lo is not None and hi != lo) else 1.0
    elif method == "max_abs":
        r = df.agg(*[F.max(F.abs(_x(c))).alias(f"a{i}") for i, c in enumerate(cols)]).first()
        for i, c in enumerate(cols):
            st.center[c] = 0.0
            st.scale[c] = r[f"a{i}"] if r[f"a{i}"] else 1.0
    elif method == "robust":
        r = column_quantiles(df, list(cols), [0.25, 0.5, 0.75])
        for c in cols:
            q = r.get(c)
            if q is None:
                st.center[c], st.scale[c] = 0.0, 1.0
                continue
            st.center[c] = q[1]
            st.scale[c] = (q[2] - q[0]) if q[2] != q[0] else 1.0
    elif method == "power":
        st = _fit_power(df, cols)
    else:
        r = column_quantiles(df, list(cols), [i / (N_QUANTILES - 1) for i in range(N_QUANTILES)])
        for c in cols:
            st.knots[c] = np.asarray(r.get(c, [0.0]), dtype=float)
    return st


# ----------------------------------------------------------------------------- Yeo-Johnson

def yeo_johnson(x: Column, lam: float) -> Column:
    pos = (F.log1p(x) if abs(lam) < 1e-12 else (F.pow(x + 1.0, lam) - 1.0) / lam)
    neg = (-F.log1p(-x) if abs(lam - 2.0) < 1e-12 else -(F.pow(1.0 - x, 2.0 - lam) - 1.0) / (2.0 - lam))
    return F.when(x >= 0, pos).otherwise(neg)


def yeo_johnson_inverse(y: Column, lam: float) -> Column:
    pos = (F.expm1(y) if abs(lam) < 1e-12 else F.pow(y * lam + 1.0, 1.0 / lam) - 1.0)
    neg = (-F.expm1(-y) if abs(lam - 2.0) < 1e-12 else 1.0 - F.pow(-(2.0 - lam) * y + 1.0, 1.0 / (2.0 - lam)))
    return F.when(y >= 0, pos).otherwise(neg)


def _yj_np(x: np.ndarray, lam: float) -> np.ndarray:
    out = np.empty_like(x)
    pos = x >= 0
    if abs(lam) < 1e-12:
        out[pos] = np.log1p(x[pos])
    else:
        out[pos] = (np.power(x[pos] + 1.0, lam) - 1.0) / lam
    if abs(lam - 2.0) < 1e-12:
        out[~pos] = -np.log1p(-x[~pos])
    else:
        out[~pos] = -(np.power(1.0 - x[~pos], 2.0 - lam) - 1.0) / (2.0 - lam)
    return out


def _fit_power(df: DataFrame, cols: list[str], rounds: int = 4, grid: int = 17) -> ScalerState:
    """Maximum likelihood lambda by grid refinement. Each round is ONE pass: every
    Arrow batch evaluates the transform for all (column, lambda) pairs in NumPy
    and emits shifted sums (shift = transform of the column mean, for a stable
    variance); a grouped sum merges them (a table of columns x grid rows). The
    log-likelihood needs only that variance and sum(sign(x) * log1p(|x|))."""
    spark = df.sparkSession
    data = spread(df.select(*[F.col(c).cast("double").alias(c) for c in cols])) \
        .persist(StorageLevel.MEMORY_AND_DISK)   # reused by every search round
    base = data.agg(*[F.count(F.col(c)).alias(f"n{i}") for i, c in enumerate(cols)],
                    *[F.avg(F.col(c)).alias(f"m{i}") for i, c in enumerate(cols)],
                    *[F.var_pop(F.col(c)).alias(f"v{i}") for i, c in enumerate(cols)],
                    *[F.sum(F.signum(F.col(c)) * F.log1p(F.abs(F.col(c)))).alias(f"s{i}")
                      for i, c in enumerate(cols)]).first()
    fit = [i for i, c in enumerate(cols) if (base[f"v{i}"] or 0) > 0]   # constant columns keep lambda 1
    lo = {i: -4.0 for i in fit}
    hi = {i: 4.0 for i in fit}
    best = {c: 1.0 for c in cols}
    narrowed = dict.fromkeys(fit, False)
    left = rounds
    while left:
        left -= all(narrowed.values())   # rounds count once every column's best lies inside its bracket
        if max((abs(b) for b in best.values()), default=0) > WIDEST_LAMBDA:
            break
        if not fit:
            break
        lams = {i: np.linspace(lo[i], hi[i], grid) for i in fit}
        shifts = {i: [float(_yj_np(np.array([base[f"m{i}"]]), float(l))[0]) for l in lams[i]] for i in fit}
        bc = spark.sparkContext.broadcast((lams, shifts))

        def kern(batches, bc=bc):
            lm, sh = bc.value
            for pdf in batches:
                rows = []
                for i in lm:
                    x = pdf[cols[i]].to_numpy(dtype=np.float64)
                    x = x[~np.isnan(x)]
                    if not len(x):
                        continue
                    for j, l in enumerate(lm[i]):
                        d = _yj_np(x, float(l)) - sh[i][j]
                        rows.append((i, j, float(len(x)), float(d.sum()), float((d * d).sum())))
                if rows:
                    yield pd.DataFrame(rows, columns=["i", "j", "n", "s1", "s2"])

        res = (data.mapInPandas(kern, "i int, j int, n double, s1 double, s2 double")
               .groupBy("i", "j").agg(F.sum("n").alias("n"), F.sum("s1").alias("s1"), F.sum("s2").alias("s2"))
               .collect())
        bc.unpersist()
        for i in fit:
            n, sl = base[f"n{i}"], base[f"s{i}"] or 0.0
            cand = []
            for r in res:
                if r["i"] != i or not r["n"]:
                    continue
                v = r["s2"] / r["n"] - (r["s1"] / r["n"]) ** 2
                lam = float(lams[i][r["j"]])
                if v > 0 and np.isfinite(v):
                    cand.append((-n / 2.0 * np.log(v) + (lam - 1.0) * sl, -abs(lam - 1.0), lam))
            if cand:
                best[cols[i]] = max(cand)[2]
            step, width = (hi[i] - lo[i]) / (grid - 1), hi[i] - lo[i]
            if not narrowed[i] and best[cols[i]] in (lo[i], hi[i]):   # on the edge: look further out first
                lo[i], hi[i] = (lo[i] - width, lo[i] + step) if best[cols[i]] == lo[i] else (hi[i] - step, hi[i] + width)
                continue
            narrowed[i] = True
            lo[i], hi[i] = best[cols[i]] - step, best[cols[i]] + step
    data.unpersist()
    st = ScalerState("power", lam=best)
    r = df.agg(*[F.avg(yeo_johnson(_x(c), best[c])).alias(f"m{i}") for i, c in enumerate(cols)],
               *[F.stddev_pop(yeo_johnson(_x(c), best[c])).alias(f"s{i}") for i, c in enumerate(cols)]).first()
    for i, c in enumerate(cols):
        st.center[c] = r[f"m{i}"] or 0.0
        st.scale[c] = r[f"s{i}"] if r[f"s{i}"] else 1.0
    return st


# ----------------------------------------------------------------------------- quantile

def _interp_udf(knots: np.ndarray, inverse: bool):
    refs = np.linspace(0.0, 1.0, len(knots))

    @F.pandas_udf(T.DoubleType())
    def f(s: pd.Series) -> pd.Series:
        x = s.to_numpy(dtype=float)
        if inverse:
            return pd.Series(np.interp(x, refs, knots))
        # average of forward and reversed interpolation handles repeated knots
        fwd = np.interp(x, knots, refs)
        bwd = -np.interp(-x, -knots[::-1], -refs[::-1])
        return pd.Series(np.where(np.isnan(x), np.nan, 0.5 * (fwd + bwd)))
    return f


def transform(df: DataFrame, st: ScalerState, cols: Sequence[str] | None = None) -> DataFrame:
    cols = [c for c in (cols or list(st.center) or list(st.knots)) if c in df.columns]
    out = []
    for c in df.columns:
        if c not in cols:
            out.append(F.col(c))
            continue
        x = _x(c)
        if st.method == "quantile":
            out.append(_interp_udf(st.knots[c], False)(x).alias(c))
        elif st.method == "power":
            out.append(((yeo_johnson(x, st.lam[c]) - st.center[c]) / st.scale[c]).alias(c))
        else:
            out.append(((x - F.lit(st.center[c])) / F.lit(st.scale[c])).alias(c))
    return df.select(*out)


def inverse_transform(df: DataFrame, st: ScalerState, cols: Sequence[str] | None = None) -> DataFrame:
    """P16 for scalers: algebraic inverse, for one, several or all fitted columns."""
    cols = [c for c in (cols or list(st.center) or list(st.knots)) if c in df.columns]
    out = []
    for c in df.columns:
        if c not in cols:
            out.append(F.col(c))
            continue
        y = _x(c)
        if st.method == "quantile":
            out.append(_interp_udf(st.knots[c], True)(y).alias(c))
        elif st.method == "power":
            out.append(yeo_johnson_inverse(y * st.scale[c] + st.center[c], st.lam[c]).alias(c))
        else:
            out.append((y * F.lit(st.scale[c]) + F.lit(st.center[c])).alias(c))
    return df.select(*out)
