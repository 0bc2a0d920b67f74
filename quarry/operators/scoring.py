"""Feature scoring (F rows). Output: long table
``(method, feature, raw, p_value, score)`` with one row per feature.

All moment-based scores (correlation, variance, F tests) come from ONE
aggregation over the data; all bin-count scores (chi2, mutual information,
contingency chi2) come from ONE grouped count over (feature, bin, class). The
rest is arithmetic on tables of features x classes x bins rows; p-values are
driver-side scalars over d features.
"""

from __future__ import annotations

import math
import sys
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pyspark import StorageLevel

from quarry.functions import special
from quarry.operators import mutual_info
from quarry.plans.joins import join_groups

DEFAULT_BINS = 10
DBL_MAX = sys.float_info.max
SCORE_SCHEMA = "method string, feature string, raw double, p_value double, score double"


def _x(c: str) -> Column:
    """The column as numbers; NaN counts as missing."""
    x = F.col(c).cast("double")
    return F.when(~F.isnan(x), x)


def _features(df: DataFrame, target: str, features, label_cols=()) -> list[str]:
    skip = set(label_cols) | {target}
    num = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    if features is None:
        return [c for c in num if c not in skip]
    return [c for c in features if c in num and c not in skip]


def clean_scores(scores: DataFrame) -> DataFrame:
    """NaN/NULL/-inf -> 0, +inf -> max double, then divide by the per-method
    maximum when it is positive (correlation keeps its raw |r| as score)."""
    raw = F.col("raw")
    fixed = (F.when(raw.isNull() | F.isnan(raw) | (raw == float("-inf")), F.lit(0.0))
             .when(raw == float("inf"), F.lit(DBL_MAX)).otherwise(raw))
    s = scores.withColumn("raw", fixed)
    mx = F.max("raw").over(Window.partitionBy("method"))  # one partition per method: d rows each
    score = (F.when(F.col("method") == "correlation", F.col("raw"))
             .when(mx > 0, F.col("raw") / mx).otherwise(F.col("raw")))
    return s.withColumn("score", score).select("method", "feature", "raw", "p_value", "score")


# ----------------------------------------------------------------------------- F1 / F2

def discretize(df: DataFrame, cols: Sequence[str], n_bins: int = DEFAULT_BINS, suffix: str = "") -> DataFrame:
    """equal-width ordinal bins 0..n-1 per column (shift-invariant; constant -> 0)."""
    mm = df.agg(*[F.min(_x(c)).alias(f"a{i}") for i, c in enumerate(cols)],
                *[F.max(_x(c)).alias(f"b{i}") for i, c in enumerate(cols)]).first()
    out = []
    for c in df.columns:
        if c in cols:
            i = list(cols).index(c)
            lo, hi = mm[f"a{i}"], mm[f"b{i}"]
            if lo is None or hi == lo:
                e = F.when(_x(c).isNotNull(), F.lit(0))
            else:
                w = (hi - lo) / n_bins
                e = F.when(_x(c).isNotNull(), F.least(F.floor((_x(c) - F.lit(lo)) / F.lit(w)), F.lit(n_bins - 1)))
            out.append(e.cast("int").alias(c + suffix))
            if suffix:
                out.append(F.col(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def _bins_expr(lo, hi, c: str, n_bins: int) -> Column:
    given = _x(c).isNotNull()
    if lo is None or hi == lo:
        return F.when(given, F.lit(0))
    w = (hi - lo) / n_bins
    return F.when(given, F.least(F.floor((_x(c) - F.lit(lo)) / F.lit(w)), F.lit(n_bins - 1)).cast("int"))


def _sd_with(a: str, b: str) -> Column:
    """Population deviation of ``a`` over the rows that also have ``b``."""
    return F.stddev_pop(F.when(_x(b).isNotNull(), _x(a)))


def _corr(cov: Column, sx: Column, sy: Column) -> Column:
    return F.try_divide(cov, sx * sy)


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair -> (x, y, corr); NULL for constant
    columns (no division error). One aggregation of covariances."""
    cols = list(cols)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    row = df.agg(*[e for i, (a, b) in enumerate(pairs) for e in (
        F.covar_pop(_x(a), _x(b)).alias(f"c{i}"), _sd_with(a, b).alias(f"s{i}"), _sd_with(b, a).alias(f"t{i}"))])
    cells = []
    for i, (a, b) in enumerate(pairs):
        v = _corr(F.col(f"c{i}"), F.col(f"s{i}"), F.col(f"t{i}"))
        cells.append(F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), v.alias("corr")))
        if a != b:
            cells.append(F.struct(F.lit(b).alias("x"), F.lit(a).alias("y"), v.alias("corr")))
    return row.select(F.explode(F.array(*cells)).alias("c")).select("c.*")


# ----------------------------------------------------------------------------- moments

def _moments(df: DataFrame, target: str, feats: list[str]):
    y = _x(target)
    # rows that have both the feature and the target
    row = df.agg(*[F.count(F.when(_x(c).isNotNull(), y)).alias(f"n{i}") for i, c in enumerate(feats)],
                 *[F.covar_pop(_x(c), y).alias(f"c{i}") for i, c in enumerate(feats)],
                 *[_sd_with(c, target).alias(f"s{i}") for i, c in enumerate(feats)],
                 *[_sd_with(target, c).alias(f"t{i}") for i, c in enumerate(feats)],
                 *[F.var_pop(_x(c)).alias(f"v{i}") for i, c in enumerate(feats)]).first()
    return row


def _table(spark, rows) -> DataFrame:
    return spark.createDataFrame(rows, SCORE_SCHEMA)


def _r(row, i):
    sx, sy, c = row[f"s{i}"], row[f"t{i}"], row[f"c{i}"]
    if not sx or not sy or c is None:
        return float("nan")
    return c / (sx * sy)


def score_correlation(df: DataFrame, target: str, features=None, label_cols=(), _row=None) -> DataFrame:
    """|Pearson r| with the target; undefined -> 0."""
    feats = _features(df, target, features, label_cols)
    row = _row or _moments(df, target, feats)
    rows = [("correlation", c, abs(_r(row, i)), None, None) for i, c in enumerate(feats)]
    return clean_scores(_table(df.sparkSession, rows))


def score_variance(df: DataFrame, target: str, features=None, label_cols=(), _row=None) -> DataFrame:
    """population variance, scaled by the maximum."""
    feats = _features(df, target, features, label_cols)
    row = _row or _moments(df, target, feats)
    rows = [("variance", c, row[f"v{i}"], None, None) for i, c in enumerate(feats)]
    return clean_scores(_table(df.sparkSession, rows))


def variance_threshold(df: DataFrame, target: str, threshold: float = 0.2, features=None,
                       label_cols=()) -> DataFrame:
    """keep features whose population variance is strictly above the threshold."""
    feats = _features(df, target, features, label_cols)
    row = df.agg(*[F.var_pop(_x(c)).alias(f"v{i}") for i, c in enumerate(feats)]).first()
    rows = [(c, float(row[f"v{i}"]) if row[f"v{i}"] is not None else 0.0) for i, c in enumerate(feats)]
    t = df.sparkSession.createDataFrame(rows, "feature string, variance double")
    return t.withColumn("selected", F.col("variance") > F.lit(float(threshold)))


def score_f_regression(df: DataFrame, target: str, features=None, label_cols=(), _row=None) -> DataFrame:
    """F8: F = r^2 / (1 - r^2) * (n - 2), p from F(1, n - 2)."""
    feats = _features(df, target, features, label_cols)
    row = _row or _moments(df, target, feats)
    rows = []
    for i, c in enumerate(feats):
        n, r = row[f"n{i}"], _r(row, i)
        if math.isnan(r):
            f, p = float("nan"), float("nan")
        elif r * r >= 1.0:
            f, p = float("inf"), 0.0
        else:
            f = r * r / (1 - r * r) * (n - 2)
            p = special.f_sf(f, 1, n - 2)
        rows.append(("f_score", c, f, p, None))
    return clean_scores(_table(df.sparkSession, rows))


def score_f_classif(df: DataFrame, target: str, features=None, label_cols=()) -> DataFrame:
    """one-way ANOVA F per feature from per-class counts, means and sums of squares.

    A row counts for the features that it has (null and NaN are missing); rows without a class
    are left out. The classes stay in Spark, however many they are."""
    feats = _features(df, target, features, label_cols)
    per = df.filter(F.col(target).isNotNull()).groupBy(target).agg(
        *[F.count(_x(c)).alias(f"n{i}") for i, c in enumerate(feats)], *[F.avg(_x(c)).alias(f"m{i}") for i, c in enumerate(feats)],
        *[F.var_pop(_x(c)).alias(f"v{i}") for i, c in enumerate(feats)])
    body = ", ".join(f"{i}, n{i}, m{i}, v{i}" for i in range(len(feats)))
    long = per.select(F.expr(f"stack({len(feats)}, {body}) AS (i, n, m, v)")).filter("n > 0")
    own = Window.partitionBy("i")  # one partition per feature: classes rows
    grand = F.sum(F.col("n") * F.col("m")).over(own) / F.sum("n").over(own)
    found = {r["i"]: r for r in long.withColumn("grand", grand).groupBy("i").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("k"), F.sum(F.col("n") * F.pow(F.col("m") - F.col("grand"), 2)).alias("ssb"),
        F.sum(F.col("n") * F.col("v")).alias("ssw")).collect()}
    rows = []
    for i, c in enumerate(feats):
        r = found.get(i)
        n, k, ssb, ssw = (r["n"], r["k"], r["ssb"], r["ssw"]) if r else (0, 0, 0.0, 0.0)
        if k < 2 or n - k <= 0:
            f, p = float("nan"), float("nan")
        elif ssw == 0:
            f, p = (float("inf"), 0.0) if ssb > 0 else (float("nan"), float("nan"))
        else:
            f = (ssb / (k - 1)) / (ssw / (n - k))
            p = special.f_sf(f, k - 1, n - k)
        rows.append(("f_score", c, f, p, None))
    return clean_scores(_table(df.sparkSession, rows))


# ----------------------------------------------------------------------------- bin counts

def _binned_counts(df: DataFrame, target: str, feats: list[str], n_bins: int, bin_target: bool) -> DataFrame:
    """ONE grouped count over (feature, bin, class) for every feature."""
    mm = df.agg(*[F.min(_x(c)).alias(f"a{i}") for i, c in enumerate(feats)],
                *[F.max(_x(c)).alias(f"b{i}") for i, c in enumerate(feats)],
                *([F.min(_x(target)).alias("ya"), F.max(_x(target)).alias("yb")] if bin_target else [])).first()
    cls = _bins_expr(mm["ya"], mm["yb"], target, n_bins) if bin_target else F.col(target)  # a class of any type
    bins = [_bins_expr(mm[f"a{i}"], mm[f"b{i}"], c, n_bins) for i, c in enumerate(feats)]
    body = ", ".join(f"'{c}', b{i}" for i, c in enumerate(feats))
    long = (df.select(cls.alias("cls"), *[b.alias(f"b{i}") for i, b in enumerate(bins)])
            .select("cls", F.expr(f"stack({len(feats)}, {body}) AS (feature, bin)")))
    return long.filter(F.col("bin").isNotNull() & F.col("cls").isNotNull()) \
               .groupBy("feature", "bin", "cls").agg(F.count(F.lit(1)).alias("cnt"))


def score_chi2(df: DataFrame, target: str, features=None, label_cols=(), n_bins: int = DEFAULT_BINS) -> DataFrame:
    """chi2 in the sum-of-values form: observed = sum of bin codes per class,
    expected = class share x total sum of bin codes; dof = classes - 1."""
    feats = _features(df, target, features, label_cols)
    cnt = _binned_counts(df, target, feats, n_bins, False)
    obs = cnt.groupBy("feature", "cls").agg(F.sum(F.col("bin") * F.col("cnt")).alias("o"),
                                           F.sum("cnt").alias("nc"))
    w = Window.partitionBy("feature")
    e = (obs.withColumn("tot", F.sum("o").over(w)).withColumn("n", F.sum("nc").over(w))
         .withColumn("k", F.count(F.lit(1)).over(w))
         .withColumn("exp", F.col("nc") / F.col("n") * F.col("tot")))
    chi = e.groupBy("feature").agg(
        F.sum(F.try_divide((F.col("o") - F.col("exp")) ** 2, F.col("exp"))).alias("raw"),
        F.max("k").alias("k"))
    rows = [("chi2", r["feature"], r["raw"], special.chi2_sf(r["raw"], r["k"] - 1) if r["raw"] is not None and r["k"] > 1
             else None, None) for r in chi.collect()]
    return clean_scores(_table(df.sparkSession, rows))


def chi2_contingency(df: DataFrame, target: str, features=None, label_cols=(), n_bins: int = DEFAULT_BINS) -> DataFrame:
    """Contingency-table chi2 independence test of binned feature vs class.
    chi2 = sum O^2 / E - n over observed cells; dof = (bins - 1)(classes - 1)."""
    feats = _features(df, target, features, label_cols)
    cnt = _binned_counts(df, target, feats, n_bins, False)
    rb = cnt.groupBy("feature", "bin").agg(F.sum("cnt").alias("rb"))
    cc = cnt.groupBy("feature", "cls").agg(F.sum("cnt").alias("cc"))
    j = cnt.join(rb, ["feature", "bin"]).join(cc, ["feature", "cls"])
    n = F.sum("cnt").over(Window.partitionBy("feature"))
    j = j.withColumn("n", n)
    cnt, rb, cc = (F.col(c).cast("double") for c in ("cnt", "rb", "cc"))  # the products exceed 64-bit integers
    agg = j.groupBy("feature").agg(
        (F.sum(cnt * cnt * F.col("n") / (rb * cc)) - F.max("n")).alias("raw"),
        F.count_distinct("bin").alias("nb"), F.count_distinct("cls").alias("nk"))
    rows = []
    for r in agg.collect():
        dof = (r["nb"] - 1) * (r["nk"] - 1)
        rows.append(("chi2_contingency", r["feature"], r["raw"],
                     special.chi2_sf(r["raw"], dof) if dof > 0 else None, None))
    return clean_scores(_table(df.sparkSession, rows))


def _mi(cnt: DataFrame) -> DataFrame:
    w = Window.partitionBy("feature")
    pb = F.sum("cnt").over(Window.partitionBy("feature", "bin"))
    pc = F.sum("cnt").over(Window.partitionBy("feature", "cls"))
    n = F.sum("cnt").over(w)
    t = cnt.withColumn("pb", pb).withColumn("pc", pc).withColumn("n", n)
    c, pb, pc = (F.col(x).cast("double") for x in ("cnt", "pb", "pc"))  # the products may exceed 64-bit integers
    return t.groupBy("feature").agg(
        F.sum(c / F.col("n") * F.ln(c * F.col("n") / (pb * pc))).alias("raw"))


def score_mi_classif(df: DataFrame, target: str, features=None, label_cols=(), n_bins: int = DEFAULT_BINS,
                     estimator: str = "bins", k: int = mutual_info.NEIGHBORS) -> DataFrame:
    """mutual information (nats) of the feature and the class: plug-in over equal-width
    bins, or by the distances to the ``k`` nearest values of the class (``neighbors``)."""
    if estimator not in ("bins", "neighbors"):
        raise ValueError(f"estimator must be bins or neighbors, not {estimator!r}")
    feats = _features(df, target, features, label_cols)
    if estimator == "neighbors":
        rows = [("mutual_info", r["feature"], r["raw"], None, None) for r in mutual_info.knn_mutual_info(df, target, feats, k).collect()]
        return clean_scores(_table(df.sparkSession, rows))
    rows = [("mutual_info", r["feature"], r["raw"], None, None)
            for r in _mi(_binned_counts(df, target, feats, n_bins, False)).collect()]
    return clean_scores(_table(df.sparkSession, rows))


def score_mi_regression(df: DataFrame, target: str, features=None, label_cols=(), n_bins: int = DEFAULT_BINS) -> DataFrame:
    """plug-in mutual information with the target binned as well."""
    feats = _features(df, target, features, label_cols)
    rows = [("mutual_info", r["feature"], r["raw"], None, None)
            for r in _mi(_binned_counts(df, target, feats, n_bins, True)).collect()]
    return clean_scores(_table(df.sparkSession, rows))


def score_custom(df: DataFrame, target: str, fn: Callable[[DataFrame, list, str], DataFrame], name: str,
                 features=None, label_cols=()) -> DataFrame:
    """plug-in scorer returning a DataFrame (feature, raw[, p_value])."""
    feats = _features(df, target, features, label_cols)
    s = fn(df, feats, target)
    if "p_value" not in s.columns:
        s = s.withColumn("p_value", F.lit(None).cast("double"))
    s = s.select(F.lit(name).alias("method"), "feature", F.col("raw").cast("double"),
                 F.col("p_value").cast("double"), F.lit(None).cast("double").alias("score"))
    return clean_scores(s)


# ----------------------------------------------------------------------------- F12 / F13

UNIVARIATE_MODES = {"percentile": 20, "k_best": 10, "fpr": 0.05, "fdr": 0.05, "fwe": 0.05}


def select_univariate(scores: DataFrame, mode: str = "percentile", param=None) -> DataFrame:
    """percentile / k_best on score, fpr / fdr (Benjamini-Hochberg) / fwe
    (Bonferroni) on p-values; unknown mode -> percentile. Adds ``selected``."""
    if mode not in UNIVARIATE_MODES:
        mode = "percentile"
    param = UNIVARIATE_MODES[mode] if param is None else param
    w = Window.partitionBy("method")
    d = F.count(F.lit(1)).over(w)
    rk = F.row_number().over(w.orderBy(F.desc("score"), "feature"))
    s = scores.withColumn("_d", d).withColumn("_rk", rk)
    if mode == "percentile":
        sel = F.col("_rk") <= F.floor(F.col("_d") * F.lit(float(param)) / 100.0)
    elif mode == "k_best":
        sel = F.col("_rk") <= F.lit(int(param))
    elif mode == "fpr":
        sel = F.col("p_value") < F.lit(float(param))
    elif mode == "fwe":
        sel = F.col("p_value") < F.lit(float(param)) / F.col("_d")
    else:
        prk = F.row_number().over(w.orderBy(F.asc_nulls_last("p_value"), "feature"))
        s = s.withColumn("_prk", prk)
        ok = F.col("p_value") <= F.lit(float(param)) * F.col("_prk") / F.col("_d")
        s = s.withColumn("_cut", F.max(F.when(ok, F.col("p_value"))).over(w))
        sel = F.col("p_value") <= F.col("_cut")
    return s.withColumn("selected", F.coalesce(sel, F.lit(False))).drop("_d", "_rk", "_prk", "_cut")


def select_from_model(importances: DataFrame) -> DataFrame:
    """keep features with importance >= mean importance. Input (feature, importance)."""
    m = importances.agg(F.avg("importance").alias("_m"))
    return join_groups(importances, m, []).withColumn("selected", F.col("importance") >= F.col("_m")).drop("_m")


# ----------------------------------------------------------------------------- shared scan

METHODS = {
    "classification": ("f_score", "mutual_info", "correlation", "variance", "chi2"),
    "regression": ("f_score", "mutual_info", "correlation", "variance"),
}
DEFAULT_METHODS = ("f_score", "mutual_info", "correlation", "variance")


def feature_scores(df: DataFrame, target: str, task: str, methods: Sequence[str] = DEFAULT_METHODS,
                   features=None, label_cols=(), n_bins: int = DEFAULT_BINS) -> DataFrame:
    """All requested scores as one long table. Moment-based scores share one
    aggregation; each bin-count score is one grouped count."""
    feats = _features(df, target, features, label_cols)
    methods = [m for m in methods if m in METHODS[task]]
    # several passes follow: keep one narrow, parallel copy of the feature frame
    # (every scorer below is eager, so it is released before returning)
    df = df.select(*feats, target).persist(StorageLevel.MEMORY_AND_DISK)
    need_mom = any(m in ("correlation", "variance") or (m == "f_score" and task == "regression") for m in methods)
    row = _moments(df, target, feats) if need_mom else None
    parts = []
    for m in methods:
        if m == "correlation":
            parts.append(score_correlation(df, target, feats, _row=row))
        elif m == "variance":
            parts.append(score_variance(df, target, feats, _row=row))
        elif m == "f_score":
            parts.append(score_f_regression(df, target, feats, _row=row) if task == "regression"
                         else score_f_classif(df, target, feats))
        elif m == "mutual_info":
            parts.append(score_mi_regression(df, target, feats, n_bins=n_bins) if task == "regression"
                         else score_mi_classif(df, target, feats, n_bins=n_bins))
        elif m == "chi2":
            parts.append(score_chi2(df, target, feats, n_bins=n_bins))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    out = df.sparkSession.createDataFrame(out.collect(), out.schema)   # methods x features rows
    df.unpersist()
    return out
