"""Null handling and value mapping."""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.plans.joins import join_null_safe
from quarry.plans.ranks import deal, number

# Fixed value: default category for missing text.
NAN_CATEGORY = "Unknown"


def interpolate(df: DataFrame, cols: Sequence[str], order_by: Sequence, partition_by: Sequence[str] = (),
                n_buckets: int | None = None) -> DataFrame:
    """Linear interpolation of numeric NULLs by row position (equal spacing);
    leading NULLs take the first valid value, trailing NULLs the last.

    Rows are dealt into range buckets of (partition, order key). Windows run only
    inside a bucket; the last valid (position, value) before a bucket and the
    first valid one after it come from a table of one row per (partition,
    bucket), joined back. So a hot partition is spread over many tasks and
    nothing is global.
    """
    parts = list(partition_by)
    cols = list(cols)
    pos = number(deal(df, order_by, parts, n_buckets), parts, "_pos")
    w_in = Window.partitionBy(*parts, "_bucket").orderBy("_pos")
    # per bucket: first and last valid (pos, value) of every column
    summ = pos.groupBy(*parts, "_bucket").agg(*[
        F.min(F.when(F.col(c).isNotNull(), F.struct(F.col("_pos").alias("p"), F.col(c).cast("double").alias("v"))))
        .alias(f"_f{i}") for i, c in enumerate(cols)], *[
        F.max(F.when(F.col(c).isNotNull(), F.struct(F.col("_pos").alias("p"), F.col(c).cast("double").alias("v"))))
        .alias(f"_l{i}") for i, c in enumerate(cols)])
    wb = Window.partitionBy(*parts).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    wr = Window.partitionBy(*parts).orderBy(F.desc("_bucket")).rowsBetween(Window.unboundedPreceding, -1)
    carry = summ.select(*parts, "_bucket", *[
        F.last(F.col(f"_l{i}"), ignorenulls=True).over(wb).alias(f"_ci{i}") for i in range(len(cols))], *[
        F.last(F.col(f"_f{i}"), ignorenulls=True).over(wr).alias(f"_co{i}") for i in range(len(cols))])
    out = join_null_safe(pos, carry, [*parts, "_bucket"])
    # both directions are running frames (unbounded preceding -> current row), which
    # Spark evaluates incrementally; "next valid" is "last valid" in reversed order
    w_prev = w_in.rowsBetween(Window.unboundedPreceding, 0)
    w_next = Window.partitionBy(*parts, "_bucket").orderBy(F.desc("_pos")).rowsBetween(Window.unboundedPreceding, 0)
    for i, c in enumerate(cols):
        pv = F.struct(F.col("_pos").alias("p"), F.col(c).cast("double").alias("v"))
        prev = F.coalesce(F.last(F.when(F.col(c).isNotNull(), pv), ignorenulls=True).over(w_prev), F.col(f"_ci{i}"))
        nxt = F.coalesce(F.last(F.when(F.col(c).isNotNull(), pv), ignorenulls=True).over(w_next), F.col(f"_co{i}"))
        out = out.withColumn(f"_p{i}", prev).withColumn(f"_n{i}", nxt)
        lin = (F.col(f"_p{i}.v") + (F.col(f"_n{i}.v") - F.col(f"_p{i}.v")) *
               (F.col("_pos") - F.col(f"_p{i}.p")) / (F.col(f"_n{i}.p") - F.col(f"_p{i}.p")))
        filled = (F.when(F.col(c).isNotNull(), F.col(c).cast("double"))
                  .when(F.col(f"_p{i}").isNotNull() & F.col(f"_n{i}").isNotNull(), lin)
                  .when(F.col(f"_p{i}").isNotNull(), F.col(f"_p{i}.v"))
                  .otherwise(F.col(f"_n{i}.v")))
        out = out.withColumn(c, filled)
    drop = ["_bucket", "_pos"] + [f"_ci{i}" for i in range(len(cols))] + [f"_co{i}" for i in range(len(cols))] + \
           [f"_p{i}" for i in range(len(cols))] + [f"_n{i}" for i in range(len(cols))]
    return out.drop(*drop)


def fill_category(df: DataFrame, cols: Sequence[str], value: str = NAN_CATEGORY) -> DataFrame:
    """Text NULLs become a constant category."""
    return df.na.fill(value, subset=list(cols))


def fit_mode(df: DataFrame, cols: Sequence[str]) -> dict:
    """P3 fit: most common value per column (smallest on ties). Each column is a
    distributed count per value (partial aggregation before the shuffle) and a
    ``min_by`` over (-count, value): no per-group value map, so a column with
    billions of distinct values is fine. All-NULL columns get no entry."""
    out = {}
    for c in cols:
        cnt = df.filter(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("_n"))
        row = cnt.agg(F.min_by(F.col(c), F.struct(-F.col("_n"), F.col(c))).alias("m")).first()
        if row["m"] is not None:
            out[c] = row["m"]
    return out


def fill_mode(df: DataFrame, cols: Sequence[str], modes: Mapping | None = None) -> DataFrame:
    """Fill NULLs with the stored (or freshly computed) mode."""
    modes = fit_mode(df, cols) if modes is None else modes
    return df.select(*[F.coalesce(F.col(c), F.lit(modes[c]).cast(df.schema[c].dataType)).alias(c)
                       if c in modes else F.col(c) for c in df.columns])


def map_values(df: DataFrame, mapping: Mapping[str, Mapping]) -> DataFrame:
    """Numeric -> category by a value map matched on the text form of the
    value; unmapped values become their text form."""
    out = []
    for c in df.columns:
        if c in mapping and mapping[c]:
            kv = []
            for k, v in mapping[c].items():
                kv += [F.lit(str(k)), F.lit(str(v))]
            m = F.create_map(*kv)
            s = F.col(c).cast("string")
            out.append(F.when(F.col(c).isNull(), F.lit(None).cast("string"))
                       .otherwise(F.coalesce(F.try_element_at(m, s), s)).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)
