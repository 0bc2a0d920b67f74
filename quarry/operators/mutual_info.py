"""Nearest-neighbour mutual information of a number and a class (F9, the reference's estimator; after Ross 2014).

A row's radius is the distance to its k-th neighbour among the values of its class; the information
follows from how many values of all classes lie within it. In one dimension neighbours stand beside
each other in order, so nothing is compared in pairs: values are dealt into ranges of (feature,
class, value), each range knows the k values before and after it, and counts within a radius are
differences of running counts.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.plans.ranks import deal, running_sums
from quarry.session import cut_lineage

NEIGHBORS = 3


def digamma(n: Column) -> Column:
    """psi of whole numbers from 1, to about 1e-13: six steps up, then the asymptotic series."""
    n = n.cast("double")
    up = n + 6.0
    series = F.ln(up) - 1.0 / (2.0 * up) - 1.0 / (12.0 * up ** 2) + 1.0 / (120.0 * up ** 4) - 1.0 / (252.0 * up ** 6) + 1.0 / (240.0 * up ** 8)
    return series - reduce(lambda a, b: a + b, [1.0 / (n + float(i)) for i in range(6)])


def _radii(values: DataFrame, k: int) -> DataFrame:
    """``values`` (feature, cls, n_cls, x) with ``radius``: the distance to the min(k, n_cls - 1)-th neighbour of the class."""
    dealt = deal(values, ["x"], ["feature", "cls"])
    own = ["feature", "cls", "_bucket"]
    place = F.row_number().over(Window.partitionBy(*own).orderBy("_at"))
    rows = dealt.withColumn("p", place).withColumn("n", F.count(F.lit(1)).over(Window.partitionBy(*own)))
    # the first and last k values of each range; the k ranges on either side hold k neighbours at least, if there are so many
    ends = rows.filter((F.col("p") <= k) | (F.col("p") > F.col("n") - k)).groupBy(*own).agg(
        F.array_sort(F.collect_list(F.when(F.col("p") <= k, F.col("x")))).alias("head"),
        F.array_sort(F.collect_list(F.when(F.col("p") > F.col("n") - k, F.col("x")))).alias("tail"))
    ranges = Window.partitionBy("feature", "cls").orderBy("_bucket")
    left = F.flatten(F.collect_list("tail").over(ranges.rowsBetween(-k, -1)))
    right = F.flatten(F.collect_list("head").over(ranges.rowsBetween(1, k)))
    halo = ends.select(*own, left.alias("left"), right.alias("right"))
    rows = rows.join(halo, own)
    order = Window.partitionBy(*own).orderBy("_at")

    def before(j):
        return F.when(F.col("p") > j, F.lag("x", j).over(order)).otherwise(F.try_element_at("left", (F.col("p") - j - 1).cast("int")))

    def after(j):
        rest = F.col("n") - F.col("p")
        return F.when(rest >= j, F.lead("x", j).over(order)).otherwise(F.try_element_at("right", (j - rest).cast("int")))

    sides = {}
    for j in range(1, k + 1):
        rows = rows.withColumn(f"b{j}", F.col("x") - before(j)).withColumn(f"a{j}", after(j) - F.col("x"))
    inf = F.lit(float("inf"))
    for j in range(k + 1):
        sides[j] = (F.lit(0.0) if j == 0 else F.coalesce(F.col(f"b{j}"), inf), F.lit(0.0) if j == 0 else F.coalesce(F.col(f"a{j}"), inf))
    found = {m: F.least(*[F.greatest(sides[s][0], sides[m - s][1]) for s in range(m + 1)]) for m in range(1, k + 1)}
    wanted = F.least(F.lit(k), F.col("n_cls") - 1)
    radius = reduce(lambda e, m: F.when(wanted == m, found[m]).otherwise(e), range(1, k + 1), F.lit(0.0))
    return rows.select("feature", "cls", "n_cls", "x", radius.alias("radius"))


def _within(rows: DataFrame) -> DataFrame:
    """(feature, x, radius, m): how many values of the feature lie within each different (value, radius)."""
    asked = rows.select("feature", "x", "radius").distinct()
    # strictly within the radius; where it is 0, the equal values. Ties of a query with a value: 0 comes before, 2 after
    low = F.when(F.col("radius") > 0, F.col("x") - F.col("radius")).otherwise(F.col("x"))
    high = F.when(F.col("radius") > 0, F.col("x") + F.col("radius")).otherwise(F.col("x"))
    low_tie = F.when(F.col("radius") > 0, 2).otherwise(0)    # counts values <= low, or < x
    high_tie = F.when(F.col("radius") > 0, 0).otherwise(2)   # counts values < high, or <= x
    asked = cut_lineage(asked.select("feature", "x", "radius", low.alias("low"), low_tie.alias("low_tie"), high.alias("high"), high_tie.alias("high_tie")))
    marks = [asked.select("feature", F.col(e).alias("pos"), F.col(f"{e}_tie").alias("tie"), F.lit(0).cast("long").alias("w")) for e in ("low", "high")]
    points = rows.select("feature", F.col("x").alias("pos"), F.lit(1).alias("tie"), F.lit(1).cast("long").alias("w"))
    line = points.unionByName(marks[0]).unionByName(marks[1]).groupBy("feature", "pos", "tie").agg(F.sum("w").alias("w"))
    counts = running_sums(line, ["pos", "tie"], ["w"], ["feature"]).select("feature", "pos", "tie", F.col("cum_w").alias("upto"))
    counts = cut_lineage(counts.filter("tie <> 1"))
    out = asked
    for e in ("low", "high"):
        own = counts.select("feature", F.col("pos").alias(e), F.col("tie").alias(f"{e}_tie"), F.col("upto").alias(f"{e}_count"))
        out = out.join(own, ["feature", e, f"{e}_tie"])
    return out.select("feature", "x", "radius", (F.col("high_count") - F.col("low_count")).alias("m"))


def knn_mutual_info(df: DataFrame, target: str, features: Sequence[str], k: int = NEIGHBORS) -> DataFrame:
    """(feature, raw): mutual information in nats of each feature and the class, never below 0.

    Rows without the class or the feature (null or NaN), and rows that are alone in their class, are left out;
    a feature without any other row has no information (null). No noise is added: equal values are neighbours at 0."""
    xs = [F.col(f"`{c}`").cast("double") for c in features]
    each = F.array(*[F.struct(F.lit(c).alias("feature"), (x + F.lit(0.0)).alias("x")) for c, x in zip(features, xs)])
    long = (df.select(F.col(f"`{target}`").alias("cls"), F.explode(each).alias("e")).select("cls", "e.*")
            .filter(F.col("cls").isNotNull() & F.col("x").isNotNull() & ~F.isnan("x")))
    long = cut_lineage(long)
    sizes = long.groupBy("feature", "cls").agg(F.count(F.lit(1)).alias("n_cls")).filter("n_cls > 1")
    rows = cut_lineage(_radii(long.join(sizes, ["feature", "cls"]), k))
    of_class = F.least(F.lit(k), F.col("n_cls") - 1)
    own = rows.groupBy("feature", "x", "radius", "n_cls").agg(F.count(F.lit(1)).alias("c"))
    told = own.join(_within(rows), ["feature", "x", "radius"])
    terms = told.groupBy("feature").agg(
        F.sum("c").alias("n"), F.sum(F.col("c") * (digamma(of_class) - digamma(F.col("n_cls")) - digamma(F.col("m")))).alias("s"))
    found = terms.select("feature", F.greatest(F.lit(0.0), digamma(F.col("n")) + F.col("s") / F.col("n")).alias("raw"))
    names = df.sparkSession.createDataFrame([(c,) for c in features], "feature string")
    return names.join(found, "feature", "left")
