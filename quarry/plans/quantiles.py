"""Exact quantiles by narrowing, without moving rows.

Spark's exact ``percentile`` keeps a value -> count map in one aggregation
buffer, which a continuous column with billions of rows doesn't fit; numbering
the rows by a range shuffle writes all of them again. Here a pass counts the rows
of each group by bin (of a value's exponent and leading digits), so only bin
counts are shuffled; the bins that hold a wanted position are known from their
running sums. A bin with one value is answered; one with few rows is sorted; a
larger one is narrowed by a further pass over its rows, in equal parts of its own
range of values.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.plans.joins import join_null_safe
from quarry.session import cut_lineage

#: A bin of at most so many rows is sorted, a larger one narrowed.
SORTED_ROWS = 1 << 16
#: Parts of an octave in the first pass, and parts of a bin in the later ones.
FIRST_PARTS, NEXT_PARTS = 256, 4096
#: Bins sent to every task at most; more are joined by a shuffle.
BROADCAST_BINS = 200_000


def fresh_name(columns: Sequence[str], name: str) -> str:
    """``name``, with underscores added until no column bears it."""
    while name in columns:
        name += "_"
    return name


def _first_bin(x: Column) -> Column:
    """A number that doesn't fall as x rises: the octave of |x| and the part of the octave.

    log2 may round up at an octave's end; the part is then -1, which is the end of the octave before.
    """
    a = F.abs(x)
    octave = F.greatest(F.least(F.floor(F.log2(a)), F.lit(1023)), F.lit(-1074)).cast("double")
    part = F.floor((a / F.pow(F.lit(2.0), octave) - 1.0) * FIRST_PARTS)
    place = ((octave + 1100.0) * FIRST_PARTS).cast("long") + part
    inf = F.lit(float("inf"))
    return F.when(x == 0, F.lit(0).cast("long")).otherwise(
        F.when(a == inf, F.lit(1 << 40)).otherwise(place) * F.when(x > 0, F.lit(1)).otherwise(F.lit(-1)))


def _wanted(probs: Sequence[float], total: Column, first: Column, n: Column) -> Column:
    """Of the probabilities that lie at or beside the ``n`` places from ``first``: the place in the list, and the two
    positions that it lies between."""
    listed = F.array(*[F.lit(float(p)) for p in probs])  # a constant

    def at(i):
        return F.get(listed, i) * (total - 1)

    near = F.filter(F.sequence(F.lit(0), F.lit(len(probs) - 1)), lambda i: (F.ceil(at(i)) >= first) & (F.floor(at(i)) < first + n))
    return F.flatten(F.transform(near, lambda i: F.array(*[F.struct(
        i.alias("i"), (at(i) - F.floor(at(i))).alias("frac"), end(at(i)).alias("position")) for end in (F.floor, F.ceil)])))


def _with_bins(rows: DataFrame, bins: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    return join_null_safe(rows, F.broadcast(bins) if n <= BROADCAST_BINS else bins, keys)


def _here(first: Column, n: Column) -> Column:
    return F.filter("wanted", lambda e: (e["position"] >= first) & (e["position"] < first + n))


def _sorted_ends(rows: DataFrame, bins: DataFrame, keys: list[str], n: int) -> DataFrame:
    """The values at the wanted positions of small bins: their distinct values with running counts."""
    own = _with_bins(rows, bins.select(*keys), keys, n).groupBy(*keys, "x").agg(F.count(F.lit(1)).alias("c"))
    before = F.sum("c").over(Window.partitionBy(*keys).orderBy("x")) - F.col("c")
    placed = _with_bins(own.withColumn("before", before), bins.select(*keys, "first", "wanted"), keys, n)
    return placed.withColumn("wanted", _here(F.col("first") + F.col("before"), F.col("c")))


def _answers(x: DataFrame, by: list[str], probs: Sequence[float]) -> DataFrame:
    """(by..., i, frac, x): the values at both positions of each probability."""
    keys, rows = [*by, "b0"], x.withColumn("b0", _first_bin(F.col("x")))
    counted = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"))
    group = Window.partitionBy(*[F.col(c) for c in by])
    bins = (counted.withColumn("first", F.sum("n").over(group.orderBy("b0")) - F.col("n"))
            .withColumn("total", F.sum("n").over(group))
            .withColumn("wanted", _wanted(probs, F.col("total"), F.col("first"), F.col("n"))).drop("total"))
    found = []
    while True:
        state = cut_lineage(bins.withColumn("wanted", _here(F.col("first"), F.col("n"))).filter(F.size("wanted") > 0))
        one, small = F.col("lo") == F.col("hi"), F.col("n") <= SORTED_ROWS
        left = state.agg(F.count_if(~one & small), F.count_if(~one & ~small)).first()
        found.append(state.filter(one).select(*by, F.col("lo").alias("x"), "wanted"))
        if left[0]:
            found.append(_sorted_ends(rows, state.filter(~one & small), keys, left[0]).select(*by, "x", "wanted"))
        if not left[1]:
            break
        wide, part = state.filter(~one & ~small), f"b{len(keys) - len(by)}"
        rows = _with_bins(rows, wide.select(*keys, "lo", "hi"), keys, left[1]).withColumn(
            part, F.floor((F.col("x") - F.col("lo")) / (F.col("hi") - F.col("lo")) * NEXT_PARTS)).drop("lo", "hi")
        counted = rows.groupBy(*keys, part).agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"))
        before = F.sum("n").over(Window.partitionBy(*keys).orderBy(part)) - F.col("n")
        bins = _with_bins(counted.withColumn("before", before), wide.select(*keys, "first", "wanted"), keys, left[1])
        bins = bins.withColumn("first", F.col("first") + F.col("before")).drop("before")
        keys = [*keys, part]
    ends = found[0]
    for f in found[1:]:
        ends = ends.unionByName(f)
    return ends.select(*by, "x", F.explode("wanted").alias("e")).select(*by, "x", "e.i", "e.frac")


def group_quantiles(df: DataFrame, value: str, by: Sequence[str], probs: Sequence[float],
                    out: str = "quantiles") -> DataFrame:
    """(by..., out array<double>): linear-interpolation quantiles (SQL ``percentile``) of each
    group's values; nulls and NaN are left out, a group of only those has no row. A null in ``by``
    is a group; the names of ``by`` may be any."""
    given = [F.col(f"`{c}`") for c in by]
    own = [f"k{i}" for i in range(len(given))]
    x = F.col(f"`{value}`").cast("double") + F.lit(0.0)  # no negative zero
    x = df.select(*[c.alias(k) for c, k in zip(given, own)], x.alias("x")).filter(F.col("x").isNotNull() & ~F.isnan("x"))
    ends = _answers(x, own, probs)
    low, high = F.min("x"), F.max("x")
    one = ends.groupBy(*own, "i").agg(F.when(low == high, low).otherwise(low + (high - low) * F.max("frac")).alias("q"))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("i", "q"))), lambda s: s["q"]).alias("q")
    if not own:
        return one.agg(listed).filter(F.size("q") > 0).select(F.col("q").alias(out))
    return one.groupBy(*own).agg(listed).select(*[F.col(k).alias(c) for c, k in zip(by, own)], F.col("q").alias(out))


def sorted_quantiles(df: DataFrame, col: str, probs: Sequence[float]) -> list[float]:
    """Quantiles of one column as a list; nulls for no values."""
    row = group_quantiles(df, col, [], probs, "q").first()
    return list(row["q"]) if row else [None] * len(probs)


def column_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> dict[str, list[float]]:
    """Quantiles of each column, all columns in the same passes; columns without values have no entry."""
    body = ", ".join(f"{i}, CAST(`{c}` AS DOUBLE)" for i, c in enumerate(cols))
    long = df.select(F.expr(f"stack({len(cols)}, {body}) AS (column, value)"))
    return {cols[r["column"]]: list(r["q"]) for r in group_quantiles(long, "value", ["column"], probs, "q").collect()}
