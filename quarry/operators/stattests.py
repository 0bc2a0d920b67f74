"""Statistical tests on grouped tables ``(group..., value)``.

The reference runs these on five fold scores; here they run per group of any
table. Moments, quantiles and counts are Spark aggregates; only the final
distribution lookups (t quantile, p-values) are per-group scalar helpers,
applied with Arrow-batched pandas UDFs on the (one row per group) result.
"""

from __future__ import annotations

import math
from typing import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions import special
from quarry.plans.joins import join_groups
from quarry.plans.quantiles import fresh_name, group_quantiles
from quarry.plans.ranks import row_number_global, running_sums

# Thresholds of the effect-size labels and the near-zero guards.
EFFECT_SMALL, EFFECT_MEDIUM, EFFECT_LARGE = 0.2, 0.5, 0.8
NEAR_ZERO = 1e-10
MIN_SAMPLES_FOR_WILCOXON = 5
SHAPIRO_MAX_N = 5000


def _g(by) -> list[str]:
    if by is None:
        return []
    return [by] if isinstance(by, str) else list(by)


def _agg(df: DataFrame, g: list[str], *exprs) -> DataFrame:
    return df.groupBy(*g).agg(*exprs) if g else df.agg(*exprs)


# ----------------------------------------------------------------------------- G1 / G2

def describe_groups(df: DataFrame, value: str, by=None) -> DataFrame:
    """G1: n, mean, sample std (0 when n = 1), standard error, median, min, max,
    Q1, Q3, IQR, coefficient of variation in % (0 when |mean| <= 1e-10)."""
    g = _g(by)
    x = F.col(value).cast("double")
    s = _agg(df.filter(F.col(value).isNotNull()), g,
             F.count(F.lit(1)).alias("n"), F.avg(x).alias("mean"),
             F.coalesce(F.stddev_samp(x), F.lit(0.0)).alias("std"),
             F.min(x).alias("min"), F.max(x).alias("max"))
    q = fresh_name([*g, *s.columns], "quartiles")
    s = join_groups(s, group_quantiles(df, value, g, [0.25, 0.5, 0.75], q), g, how="left")
    std = F.when(F.col("n") > 1, F.col("std")).otherwise(F.lit(0.0))
    return s.select(
        *g, F.col("n").cast("long").alias("n"), "mean", std.alias("std"),
        (std / F.sqrt(F.col("n"))).alias("std_error"),
        F.col(q)[1].alias("median"), "min", "max",
        F.col(q)[0].alias("q1"), F.col(q)[2].alias("q3"),
        (F.col(q)[2] - F.col(q)[0]).alias("iqr"),
        F.when(F.abs(F.col("mean")) > NEAR_ZERO, std / F.abs(F.col("mean")) * 100.0)
        .otherwise(F.lit(0.0)).alias("coefficient_of_variation"))


@F.pandas_udf(T.DoubleType())
def _t_critical(n: pd.Series, level: pd.Series) -> pd.Series:
    out = np.full(len(n), np.nan)
    cache: dict = {}
    for i, (k, lv) in enumerate(zip(n.to_numpy(), level.to_numpy())):
        if k is None or k < 2:
            continue
        key = (int(k), float(lv))
        if key not in cache:
            cache[key] = special.t_ppf(1.0 - (1.0 - lv) / 2.0, k - 1)
        out[i] = cache[key]
    return pd.Series(out)


def confidence_interval(df: DataFrame, value: str, by=None, level: float = 0.95) -> DataFrame:
    """Student-t interval of the mean; n < 2 gives a zero-width interval."""
    g = _g(by)
    x = F.col(value).cast("double")
    s = _agg(df.filter(F.col(value).isNotNull()), g, F.count(F.lit(1)).alias("n"),
             F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"))
    tc = _t_critical(F.col("n"), F.lit(float(level)))
    margin = F.when(F.col("n") >= 2, tc * F.col("std") / F.sqrt(F.col("n"))).otherwise(F.lit(0.0))
    s = s.withColumn("margin_of_error", margin)
    return s.select(*g, F.col("n").cast("long").alias("n"), F.col("mean").alias("point_estimate"),
                    (F.col("mean") - F.col("margin_of_error")).alias("lower"),
                    (F.col("mean") + F.col("margin_of_error")).alias("upper"),
                    "margin_of_error", F.lit(float(level)).alias("confidence_level"))


# ----------------------------------------------------------------------------- G3 Shapiro-Wilk

# Polynomial coefficients of Royston's (1992, 1995) approximation
# of the Shapiro-Wilk weights and of the null distribution of W.
_SW_C1 = (0.0, 0.221157, -0.147981, -2.071190, 4.434685, -2.706056)
_SW_C2 = (0.0, 0.042981, -0.293762, -1.752461, 5.682633, -3.582633)
_SW_G = (-2.273, 0.459)
_SW_C3 = (0.5440, -0.39978, 0.025054, -6.714e-4)
_SW_C4 = (1.3822, -0.77857, 0.062767, -0.0020322)
_SW_C5 = (-1.5861, -0.31082, -0.083751, 0.0038915)
_SW_C6 = (-0.4803, -0.082676, 0.0030302)


def _poly(c, x):
    return sum(ci * x ** i for i, ci in enumerate(c))


@F.pandas_udf(T.DoubleType())
def _normal_score(i: pd.Series, n: pd.Series) -> pd.Series:
    """Expected normal order statistic of rank i + 1 of n (Blom)."""
    return pd.Series(special.norm_ppf_array((i.to_numpy() + 0.625) / (n.to_numpy() + 0.25)))


def _shapiro_p(w: float, n: int) -> float:
    """p of W for 3 <= n <= 5000."""
    if n == 3:
        return max(6.0 / math.pi * (math.asin(math.sqrt(w)) - math.asin(math.sqrt(0.75))), 0.0)
    if w >= 1.0:
        return 1.0
    if n <= 11:
        gamma = _poly(_SW_G, n)
        if gamma - math.log(1.0 - w) <= 0:
            return 1e-19
        z = (-math.log(gamma - math.log(1.0 - w)) - _poly(_SW_C3, n)) / math.exp(_poly(_SW_C4, n))
    else:
        ln = math.log(n)
        z = (math.log(1.0 - w) - _poly(_SW_C5, ln)) / math.exp(_poly(_SW_C6, ln))
    return special.norm_sf(z)


@F.pandas_udf(T.StructType([T.StructField("statistic", T.DoubleType()), T.StructField("p_value", T.DoubleType())]))
def _shapiro_result(n: pd.Series, ss: pd.Series, m2: pd.Series, mx: pd.Series, top: pd.Series, outer: pd.Series,
                    inner: pd.Series, top1: pd.Series) -> pd.DataFrame:
    """W and p of each group. ``m2``, ``mx``: sums of squared normal scores and of scores times values;
    ``top``, ``top1``: the largest scores; ``outer``, ``inner``: largest less smallest value, second from both ends."""
    rows = []
    for k, s, q, c, m, o, i, m1 in zip(n, ss, m2, mx, top, outer, inner, top1):
        if k < 3:
            rows.append((None, None))
            continue
        if not s > 0:
            rows.append((1.0, 1.0))
            continue
        if k == 3:
            total = math.sqrt(0.5) * o
        else:
            u = 1.0 / math.sqrt(k)
            an = m / math.sqrt(q) + _poly(_SW_C1, u)
            if k > 5:
                an1 = m1 / math.sqrt(q) + _poly(_SW_C2, u)
                phi = (q - 2 * m * m - 2 * m1 * m1) / (1 - 2 * an * an - 2 * an1 * an1)
                total = (c - m * o - m1 * i) / math.sqrt(phi) + an * o + an1 * i
            else:
                phi = (q - 2 * m * m) / (1 - 2 * an * an)
                total = (c - m * o) / math.sqrt(phi) + an * o
        w = min(total * total / s, 1.0)
        rows.append((w, _shapiro_p(w, int(k)) if k <= SHAPIRO_MAX_N else None))
    return pd.DataFrame(rows, columns=["statistic", "p_value"])


def shapiro(df: DataFrame, value: str, by=None, n_buckets: int | None = None) -> DataFrame:
    """G3 per group, over all rows: (group..., n, statistic, p_value).

    Ranks come from one range shuffle, the weights from (rank, n), and W from one
    aggregation, so a group of any size is spread over many tasks. The p-value's
    approximation holds up to n = 5000; above it is null, as both are below n = 3.
    """
    g = _g(by)
    x = df.select(*g, F.col(value).cast("double").alias("_v")).filter(F.col("_v").isNotNull())
    sizes = _agg(x, g, F.count(F.lit(1)).alias("n"), F.avg("_v").alias("_mean"))
    r = join_groups(row_number_global(x, ["_v"], g, "_i", n_buckets), sizes, g)
    r = r.withColumn("_m", _normal_score(F.col("_i"), F.col("n"))).withColumn("_d", F.col("_v") - F.col("_mean"))
    at = lambda e, c: F.max(F.when(e, F.col(c)))
    n, i = F.col("n"), F.col("_i")
    s = _agg(r, g, F.max("n").alias("n"), F.sum(F.col("_d") * F.col("_d")).alias("ss"),
             F.sum(F.col("_m") * F.col("_m")).alias("m2"), F.sum(F.col("_m") * F.col("_d")).alias("mx"),
             at(i == n - 1, "_m").alias("top"), (at(i == n - 1, "_d") - at(i == 0, "_d")).alias("outer"),
             (at(i == n - 2, "_d") - at(i == 1, "_d")).alias("inner"), at(i == n - 2, "_m").alias("top1"))
    s = s.filter(F.col("n").isNotNull())
    out = s.select(*g, F.col("n").cast("long").alias("n"),
                   _shapiro_result("n", "ss", "m2", "mx", "top", "outer", "inner", "top1").alias("_r"))
    return out.select(*g, "n", "_r.statistic", "_r.p_value")


def analyze_groups(df: DataFrame, value: str, by=None, level: float = 0.95, alpha: float = 0.05) -> DataFrame:
    """Descriptive statistics + confidence interval + normality per group."""
    g = _g(by)
    d = describe_groups(df, value, g)
    ci = confidence_interval(df, value, g, level).select(*g, "lower", "upper", "margin_of_error")
    sw = shapiro(df, value, g).select(*g, F.col("statistic").alias("shapiro_w"),
                                      F.col("p_value").alias("shapiro_p"))
    out = join_groups(join_groups(d, ci, g), sw, g, how="left")
    return out.withColumn("is_normal", F.col("shapiro_p") > F.lit(alpha))


# ----------------------------------------------------------------------------- paired tests

def _paired(df: DataFrame, a: str, b: str, g: list[str]) -> DataFrame:
    return df.select(*g, (F.col(a).cast("double") - F.col(b).cast("double")).alias("_d"),
                     F.col(a).cast("double").alias("_a"), F.col(b).cast("double").alias("_b")) \
             .filter(F.col("_d").isNotNull())


@F.pandas_udf(T.DoubleType())
def _t_two_sided_p(t: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series([special.t_sf_two_sided(float(a), float(b)) if pd.notna(a) and pd.notna(b) and b > 0
                      else np.nan for a, b in zip(t, dof)])


def effect_label(d: Column) -> Column:
    ad = F.abs(d)
    return (F.when(ad < EFFECT_SMALL, "negligible").when(ad < EFFECT_MEDIUM, "small")
            .when(ad < EFFECT_LARGE, "medium").otherwise("large"))


def paired_ttest(df: DataFrame, a: str, b: str, by=None, with_p: bool = True) -> DataFrame:
    """Paired t statistic (and two-sided p-value) per group."""
    g = _g(by)
    s = _agg(_paired(df, a, b, g), g, F.count(F.lit(1)).alias("n"), F.avg("_d").alias("mean_difference"),
             F.stddev_samp("_d").alias("std_difference"))
    t = F.col("mean_difference") / (F.col("std_difference") / F.sqrt(F.col("n")))
    s = s.withColumn("statistic", F.when(F.col("n") < 2, F.lit(None).cast("double"))
                     .when(F.col("std_difference") > 0, t)
                     .when(F.col("mean_difference") > 0, F.lit(float("inf")))
                     .when(F.col("mean_difference") < 0, F.lit(float("-inf"))))
    s = s.withColumn("n", F.col("n").cast("long"))
    if with_p:
        s = s.withColumn("p_value", _t_two_sided_p(F.col("statistic"), (F.col("n") - 1).cast("double")))
    return s


def cohens_dz(df: DataFrame, a: str, b: str, by=None) -> DataFrame:
    """mean(d) / sd(d) with the zero-spread rule, and its label."""
    g = _g(by)
    s = _agg(_paired(df, a, b, g), g, F.count(F.lit(1)).alias("n"), F.avg("_d").alias("_m"),
             F.stddev_samp("_d").alias("_s"))
    dz = (F.when(F.coalesce(F.col("_s"), F.lit(0.0)) < NEAR_ZERO,
                 F.when(F.abs(F.col("_m")) < NEAR_ZERO, F.lit(0.0))
                 .when(F.col("_m") > 0, F.lit(float("inf"))).otherwise(F.lit(float("-inf"))))
          .otherwise(F.col("_m") / F.col("_s")))
    return s.select(*g, F.col("n").cast("long").alias("n"), dz.alias("effect_size"),
                    effect_label(dz).alias("effect_size_interpretation"))


def _wilcoxon_exact_p(n: int, w: float) -> float:
    """Two-sided exact p of the signed-rank statistic (no ties, no zeros)."""
    top = n * (n + 1) // 2
    c = np.zeros(top + 1)
    c[0] = 1.0
    for k in range(1, n + 1):
        nxt = c.copy()
        nxt[k:] += c[:top + 1 - k]
        c = nxt
    total = 2.0 ** n
    wi = int(math.floor(w))
    p_low = c[:wi + 1].sum() / total
    return float(min(1.0, 2.0 * p_low))


@F.pandas_udf(T.DoubleType())
def _wilcoxon_p(n: pd.Series, w: pd.Series, tie_term: pd.Series, has_ties: pd.Series) -> pd.Series:
    out = []
    for k, ww, tt, ties in zip(n, w, tie_term, has_ties):
        if pd.isna(k) or k < 1 or pd.isna(ww):
            out.append(np.nan)
            continue
        k = int(k)
        if k <= 50 and not ties:
            out.append(_wilcoxon_exact_p(k, float(ww)))
            continue
        mean = k * (k + 1) / 4.0
        var = k * (k + 1) * (2 * k + 1) / 24.0 - float(tt) / 48.0
        if var <= 0:
            out.append(np.nan)
            continue
        z = (float(ww) - mean) / math.sqrt(var)
        out.append(min(1.0, 2.0 * special.norm_cdf(-abs(z))))
    return pd.Series(out, dtype="float64")


def wilcoxon(df: DataFrame, a: str, b: str, by=None, with_p: bool = True, n_buckets=None) -> DataFrame:
    """Signed-rank test; zeros dropped, average ranks for ties, W = min(W+, W-).

    Ranks come from counts per distinct |d| and bucketed running sums (no
    global window); groups with fewer than 5 pairs or all-zero differences get
    a null statistic.
    """
    g = _g(by)
    p = _paired(df, a, b, g)
    nz = p.filter(F.col("_d") != 0).withColumn("_ad", F.abs(F.col("_d")))
    c = nz.groupBy(*g, "_ad").agg(F.count(F.lit(1)).alias("cnt"),
                                  F.sum((F.col("_d") > 0).cast("long")).alias("npos"))
    r = running_sums(c, ["_ad"], ["cnt"], partition_cols=g, inclusive=False, n_buckets=n_buckets)
    avg_rank = F.col("cum_cnt") + (F.col("cnt") + 1) / 2.0
    s = _agg(r, g,
             F.sum(avg_rank * F.col("npos")).alias("w_plus"),
             F.sum(avg_rank * (F.col("cnt") - F.col("npos"))).alias("w_minus"),
             F.sum(F.col("cnt")).alias("n_nonzero"),
             F.sum(F.pow(F.col("cnt").cast("double"), 3) - F.col("cnt")).alias("tie_term"),
             F.max(F.col("cnt")).alias("_maxcnt"))
    tot = _agg(p, g, F.count(F.lit(1)).alias("n"))
    s = join_groups(tot, s, g, how="left")
    ok = (F.col("n") >= MIN_SAMPLES_FOR_WILCOXON) & (F.coalesce(F.col("n_nonzero"), F.lit(0)) > 0)
    s = s.withColumn("statistic", F.when(ok, F.least(F.col("w_plus"), F.col("w_minus"))))
    s = s.withColumn("n", F.col("n").cast("long")).withColumn("n_nonzero", F.col("n_nonzero").cast("long"))
    if with_p:
        s = s.withColumn("p_value", F.when(ok, _wilcoxon_p(F.col("n_nonzero"), F.col("statistic"),
                                                            F.col("tie_term").cast("double"),
                                                            F.col("_maxcnt") > 1)))
    return s.drop("_maxcnt", "tie_term")


def compare_variants(df: DataFrame, key: str, variant: str, value: str, a_name, b_name, by=None,
                     alpha: float = 0.05, with_p: bool = True, unpaired: str = "raise") -> DataFrame:
    """Pair the two variants on ``key``, then means, difference, paired t, Cohen's dz
    and Wilcoxon per group. Groups with n < 2 pairs give null tests. A key that has one
    of the variants only ends the job, unless ``unpaired`` is "drop"."""
    g = _g(by)
    pv = (df.filter(F.col(variant).isin(a_name, b_name))
          .groupBy(*g, key).agg(F.first(F.when(F.col(variant) == a_name, F.col(value)), ignorenulls=True).alias("_a"),
                                F.first(F.when(F.col(variant) == b_name, F.col(value)), ignorenulls=True).alias("_b"),
                                F.sum((F.col(variant) == a_name).cast("int")).alias("_na"),
                                F.sum((F.col(variant) == b_name).cast("int")).alias("_nb")))
    # a filter cannot be pruned away, so the duplicate check always runs
    dup = (F.col("_na") > 1) | (F.col("_nb") > 1)
    pv = pv.filter(F.when(dup, F.raise_error(F.lit("a key holds more than one value per variant")).cast("boolean"))
                   .otherwise(F.lit(True)))
    if unpaired == "raise":
        alone = (F.col("_na") == 0) | (F.col("_nb") == 0)
        pv = pv.filter(F.when(alone, F.raise_error(F.lit("a key lacks one of the variants")).cast("boolean"))
                       .otherwise(F.lit(True)))
    pv = pv.filter(F.col("_a").isNotNull() & F.col("_b").isNotNull())
    means = _agg(pv, g, F.count(F.lit(1)).alias("n"), F.avg("_a").alias("mean_a"), F.avg("_b").alias("mean_b"))
    means = means.withColumn("mean_difference", F.col("mean_a") - F.col("mean_b"))
    t = paired_ttest(pv, "_a", "_b", g, with_p=with_p).select(
        *g, F.col("statistic").alias("t_statistic"), *([F.col("p_value").alias("t_p_value")] if with_p else []))
    dz = cohens_dz(pv, "_a", "_b", g).select(*g, "effect_size", "effect_size_interpretation")
    w = wilcoxon(pv, "_a", "_b", g, with_p=with_p).select(
        *g, F.col("statistic").alias("wilcoxon_statistic"), *([F.col("p_value").alias("wilcoxon_p_value")] if with_p else []))
    out = join_groups(join_groups(join_groups(means, t, g), dz, g), w, g)
    out = out.withColumn("n", F.col("n").cast("long"))
    if with_p:
        out = out.withColumn("t_significant", F.col("t_p_value") < F.lit(alpha))
    return out


# ----------------------------------------------------------------------------- G9

def jarque_bera(df: DataFrame, value: str, by=None) -> DataFrame:
    """Jarque-Bera from population skewness and excess kurtosis; p = exp(-JB/2)."""
    g = _g(by)
    x = F.col(value).cast("double")
    s = _agg(df.filter(F.col(value).isNotNull()), g, F.count(F.lit(1)).alias("n"),
             F.skewness(x).alias("skewness"), F.kurtosis(x).alias("kurtosis"))
    jb = F.col("n") / 6.0 * (F.col("skewness") ** 2 + F.col("kurtosis") ** 2 / 4.0)
    return s.select(*g, F.col("n").cast("long").alias("n"), "skewness", "kurtosis",
                    jb.alias("statistic"), F.exp(-jb / 2.0).alias("p_value"))
