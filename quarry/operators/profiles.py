"""Column profiles: the data behind exploratory plots, as tables."""

from __future__ import annotations

from typing import Sequence

import numpy as np
import pandas as pd

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.plans.joins import join_groups
from quarry.plans.quantiles import group_quantiles
from quarry.plans.ranks import row_number_global

DEFAULT_BINS = 10


def _stack(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Unpivot numeric columns to (column, value) with one projection (no shuffle)."""
    body = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in cols)
    return df.select(*keep, F.expr(f"stack({len(cols)}, {body}) AS (column, value)"))


def describe_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count, mean, sample variance/std, min, max, quartiles per column; NaN counts as NULL.

    One aggregation over all columns, unpivoted on the one-row aggregate; the
    quartiles come from bin counts of the stacked columns, narrowed to the values.
    """
    exprs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        x = F.when(~F.isnan(x), x)
        exprs.append(F.struct(F.lit(c).alias("column"), F.count(x).alias("count"), F.avg(x).alias("mean"),
                              F.var_samp(x).alias("variance"), F.stddev_samp(x).alias("std"),
                              F.min(x).alias("min"), F.max(x).alias("max")).alias(f"s{i}"))
    one = df.agg(*exprs)
    rows = one.select(F.explode(F.array(*[F.col(f"s{i}") for i in range(len(cols))])).alias("s")).select("s.*")
    q = group_quantiles(_stack(df, cols), "value", ["column"], [0.25, 0.5, 0.75], "_q")
    return rows.join(q, "column", "left").select(
        "column", "count", "mean", "variance", "std", "min", F.col("_q")[0].alias("q1"), F.col("_q")[1].alias("median"),
        F.col("_q")[2].alias("q3"), "max")


def box_stats(df: DataFrame, cols: Sequence[str], whisker: float = 1.5) -> DataFrame:
    """Q1, median, Q3, fences at whisker*IQR, outlier count per column (two passes)."""
    q = describe_columns(df, cols).select(
        "column", "q1", "median", "q3", (F.col("q3") - F.col("q1")).alias("iqr"))
    q = q.withColumn("lower_fence", F.col("q1") - whisker * F.col("iqr")) \
         .withColumn("upper_fence", F.col("q3") + whisker * F.col("iqr"))
    long = _stack(df, cols).filter(F.col("value").isNotNull() & ~F.isnan("value"))
    fences = F.broadcast(q.select("column", "lower_fence", "upper_fence"))  # one row per column
    out = (long.join(fences, on="column")
           .groupBy("column")
           .agg(F.sum(((F.col("value") < F.col("lower_fence")) | (F.col("value") > F.col("upper_fence")))
                      .cast("long")).alias("n_outliers")))
    return q.join(out, on="column", how="left").withColumn(
        "n_outliers", F.coalesce(F.col("n_outliers"), F.lit(0)).cast("long"))


def histogram(df: DataFrame, cols: Sequence[str], bins: int = DEFAULT_BINS) -> DataFrame:
    """Equal-width histogram per column, bin count reduced to the distinct
    count; min == max gives one bin. Output (column, bin, lo, hi, n)."""
    long = _stack(df, cols).filter(F.col("value").isNotNull() & ~F.isnan("value"))
    # exact distinct count is only needed when it is below `bins`
    rng = long.groupBy("column").agg(F.min("value").alias("lo_all"), F.max("value").alias("hi_all"),
                                     F.approx_count_distinct("value", 0.05).alias("_ad"))
    small = rng.filter(F.col("_ad") <= 2 * bins).select("column")
    exact = (long.join(F.broadcast(small), on="column", how="left_semi")
             .groupBy("column").agg(F.count_distinct("value").alias("_nd")))
    rng = rng.join(F.broadcast(exact), on="column", how="left")
    nb = F.when(F.col("_nd").isNotNull(), F.least(F.lit(bins), F.col("_nd"))).otherwise(F.lit(bins))
    rng = rng.withColumn("nbins", F.greatest(nb, F.lit(1)).cast("int")) \
             .withColumn("width", (F.col("hi_all") - F.col("lo_all")) / F.col("nbins"))
    j = long.join(F.broadcast(rng.select("column", "lo_all", "width", "nbins")), on="column")
    b = F.when(F.col("width") == 0, F.lit(0)).otherwise(
        F.least(F.floor((F.col("value") - F.col("lo_all")) / F.col("width")), F.col("nbins") - 1)).cast("int")
    counts = j.groupBy("column", b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    edges = rng.select("column", "lo_all", "width", "nbins",
                       F.explode(F.sequence(F.lit(0), F.col("nbins") - 1)).alias("bin"))
    return (edges.join(counts, on=["column", "bin"], how="left")
            .select("column", "bin",
                    (F.col("lo_all") + F.col("bin") * F.col("width")).alias("lo"),
                    F.when(F.col("bin") == F.col("nbins") - 1, F.col("lo_all") + F.col("nbins") * F.col("width"))
                    .otherwise(F.col("lo_all") + (F.col("bin") + 1) * F.col("width")).alias("hi"),
                    F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n")))


def density(df: DataFrame, cols: Sequence[str], grid: int = 200, fine_bins: int = 2048) -> DataFrame:
    """Density histogram + Gaussian KDE (Scott bandwidth) on a grid.

    The KDE is evaluated from a fine histogram (mergeable counts), so the cost
    is grid x fine_bins per column, independent of the row count.
    """
    long = _stack(df, cols).filter(F.col("value").isNotNull() & ~F.isnan("value"))
    st = long.groupBy("column").agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("lo"),
                                    F.max("value").alias("hi"), F.stddev_samp("value").alias("sd"))
    st = st.withColumn("bw", F.coalesce(F.col("sd"), F.lit(0.0)) * F.pow(F.col("n").cast("double"), -0.2)) \
           .withColumn("w", (F.col("hi") - F.col("lo")) / fine_bins)
    j = long.join(F.broadcast(st.select("column", "lo", "w")), on="column")
    fb = F.when(F.col("w") == 0, F.lit(0)).otherwise(
        F.least(F.floor((F.col("value") - F.col("lo")) / F.col("w")), F.lit(fine_bins - 1))).cast("int")
    hist = j.groupBy("column", fb.alias("fb")).agg(F.count(F.lit(1)).alias("c"), F.avg("value").alias("xc"))
    hist = hist.join(F.broadcast(st.select("column", "n", "bw", "lo", "hi")), on="column")

    def kde(pdf: pd.DataFrame) -> pd.DataFrame:
        # one group = one column's fine histogram: at most `fine_bins` rows
        lo, hi, bw, n = (float(pdf["lo"].iloc[0]), float(pdf["hi"].iloc[0]),
                         float(pdf["bw"].iloc[0]), float(pdf["n"].iloc[0]))
        x = lo + (hi - lo) * np.arange(grid) / (grid - 1)
        if bw > 0:
            z = (x[:, None] - pdf["xc"].to_numpy()[None, :]) / bw
            dens = (np.exp(-0.5 * z * z) * pdf["c"].to_numpy()[None, :]).sum(axis=1) / (n * bw * np.sqrt(2 * np.pi))
        else:
            dens = np.full(grid, np.nan)
        return pd.DataFrame({"column": pdf["column"].iloc[0], "gi": np.arange(grid, dtype="int32"),
                             "x": x, "density": dens})

    return hist.groupBy("column").applyInPandas(kde, "column string, gi int, x double, density double")


def series(df: DataFrame, cols: Sequence[str], order_by: Sequence[str], buckets: int = 100,
           n_buckets: int | None = None) -> DataFrame:
    """E5: values against row order, reduced to min/avg/max per order bucket
    (bucket = floor(row_position * buckets / n))."""
    n = df.count()
    rn = row_number_global(df.select(*order_by, *[c for c in cols if c not in order_by]), order_by,
                           out="_pos", n_buckets=n_buckets)
    rn = rn.withColumn("bucket", F.floor(F.col("_pos") * buckets / F.lit(max(n, 1))).cast("int"))
    long = _stack(rn, cols, keep=["bucket", "_pos"])
    return long.groupBy("column", "bucket").agg(
        F.min("_pos").alias("first_row"), F.max("_pos").alias("last_row"),
        F.min("value").alias("min"), F.avg("value").alias("avg"), F.max("value").alias("max"))
