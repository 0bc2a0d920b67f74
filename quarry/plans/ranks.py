"""Global order without a global window, the same way at every size.

A window without ``partitionBy`` moves every row into one task. Here one range
shuffle over (partition columns, order columns) puts neighbours together however
large a partition value's share is; each row's place in its Spark partition plus a
small table of counts per (Spark partition, partition value) gives its position.
The shuffled rows are checkpointed, so that counting and numbering see the same
partitions also after an executor is lost.

Nulls in the partition columns form a group of their own. In the order columns
nulls come first ascending and last descending.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.plans.joins import join_null_safe
from quarry.session import cut_lineage


def _spec(order_cols: Sequence) -> list[tuple[str, bool]]:
    return [(o[0], bool(o[1])) if isinstance(o, tuple) else (o, True) for o in order_cols]


def order_exprs(spec: list[tuple[str, bool]], reverse: bool = False) -> list[Column]:
    return [F.col(n).asc_nulls_first() if a != reverse else F.col(n).desc_nulls_last() for n, a in spec]


def deal(df: DataFrame, order_cols: Sequence, partition_cols: Sequence[str] = (),
         n_buckets: int | None = None) -> DataFrame:
    """Rows in range buckets ``_bucket`` of (partition_cols, order_cols), with their place
    ``_at`` in the bucket; buckets follow each other in that order."""
    keys = [*[F.col(p) for p in partition_cols], *order_exprs(_spec(order_cols))]
    n = n_buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    out = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys).withColumn("_m", F.monotonically_increasing_id())
    out = out.withColumn("_bucket", F.shiftright("_m", 33).cast("int")).withColumn(
        "_at", F.col("_m").bitwiseAND(F.lit(2 ** 33 - 1))).drop("_m")
    return cut_lineage(out)


def _before(partition_cols: Sequence[str]):
    w = Window.partitionBy(*partition_cols) if partition_cols else Window.partitionBy()
    return w.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)


def number(dealt: DataFrame, partition_cols: Sequence[str] = (), out: str = "rn") -> DataFrame:
    """0-based positions of dealt rows within ``partition_cols``; keeps ``_bucket``."""
    parts = list(partition_cols)
    counts = dealt.groupBy(*parts, "_bucket").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(*parts, "_bucket", (F.coalesce(F.sum("_n").over(_before(parts)), F.lit(0)) - F.col("_first"))
                            .alias("_o"))
    return (join_null_safe(dealt, offsets, [*parts, "_bucket"])
            .withColumn(out, (F.col("_o") + F.col("_at")).cast("long")).drop("_o", "_at"))


def row_number_global(df: DataFrame, order_cols: Sequence, partition_cols: Sequence[str] = (),
                      out: str = "rn", n_buckets: int | None = None) -> DataFrame:
    """0-based row number in ``order_cols`` order (within ``partition_cols``)."""
    return number(deal(df, order_cols, partition_cols, n_buckets), partition_cols, out).drop("_bucket")


def running_sums(df: DataFrame, order_cols: Sequence, value_cols: Sequence[str],
                 partition_cols: Sequence[str] = (), prefix: str = "cum_",
                 n_buckets: int | None = None, inclusive: bool = True) -> DataFrame:
    """Cumulative sums of ``value_cols`` in order (per partition).

    Rows must be unique on (partition_cols, order_cols) for the running sum
    to be well defined; callers aggregate to distinct keys first.
    """
    parts = list(partition_cols)
    dealt = deal(df, order_cols, parts, n_buckets)
    totals = dealt.groupBy(*parts, "_bucket").agg(*[F.sum(v).alias(v) for v in value_cols])
    offsets = totals.select(*parts, "_bucket", *[F.coalesce(F.sum(v).over(_before(parts)), F.lit(0)).alias(f"_o_{v}")
                                                 for v in value_cols])
    w = (Window.partitionBy(*parts, "_bucket").orderBy("_at")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow if inclusive else -1))
    inner = dealt.select("*", *[F.coalesce(F.sum(v).over(w), F.lit(0)).alias(f"_c_{v}") for v in value_cols])
    res = join_null_safe(inner, offsets, [*parts, "_bucket"])
    for v in value_cols:
        res = res.withColumn(f"{prefix}{v}", F.col(f"_o_{v}") + F.col(f"_c_{v}"))
    return res.drop("_bucket", "_at", *[f"_c_{v}" for v in value_cols], *[f"_o_{v}" for v in value_cols])
