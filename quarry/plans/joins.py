"""Joins of per-group result tables."""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which null keys match each other; the keys are the left side's."""
    names = {k: f"_right_{i}" for i, k in enumerate(keys)}
    other = right.withColumnsRenamed(names)
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(n)) for k, n in names.items()])
    return left.join(other, same, how).drop(*names.values())


def join_groups(left: DataFrame, right: DataFrame, group_cols: Sequence[str], how: str = "inner") -> DataFrame:
    """Join two tables keyed by the same group columns; a null group is a group.

    With no group columns both sides are single-row aggregates: they are
    joined on a constant key so the plan stays an equi-join (a broadcast hash
    join of one row) rather than a nested-loop product.
    """
    g = list(group_cols)
    if g:
        return join_null_safe(left, right, g, how)
    return (left.withColumn("_one", F.lit(1))
            .join(F.broadcast(right.withColumn("_one", F.lit(1))), on="_one", how=how).drop("_one"))
