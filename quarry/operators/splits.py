"""Folds and splits (M1-M3), stable across runs and partitionings."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.hashing import TWO_32, row_hash
from quarry.plans.ranks import row_number_global


def kfold(df: DataFrame, k: int, key: Sequence[str] | str, seed: int, shuffle: bool = True,
          exact: bool = True, hash_method: str = "xxhash64", out: str = "fold",
          n_buckets: int | None = None) -> DataFrame:
    """M1: rows (in hash order when shuffled, else key order) cut into k contiguous
    near-equal folds, the first n mod k folds one larger (the sizes of ntile).
    Positions come from the bucketed global row number; ``exact=False`` uses
    ``pmod(hash, k)`` (one projection, sizes equal only in expectation)."""
    if k < 2:
        raise ValueError("k must be at least 2")
    keys = [key] if isinstance(key, str) else list(key)
    h = row_hash(keys, seed, hash_method)
    if not exact:
        return df.withColumn(out, F.pmod(h, F.lit(k)).cast("int"))
    d = df.withColumn("_h", h)
    n = d.count()
    order = (["_h"] if shuffle else []) + keys
    r = row_number_global(d, order, out="_rn", n_buckets=n_buckets)
    q, rem = divmod(n, k)
    big = rem * (q + 1)
    fold = F.when(F.col("_rn") < big, F.floor(F.col("_rn") / (q + 1))) \
            .otherwise(F.lit(rem) + F.floor((F.col("_rn") - big) / max(q, 1)))
    return r.withColumn(out, fold.cast("int")).drop("_h", "_rn")


def stratified_kfold(df: DataFrame, label: str, k: int, key: Sequence[str] | str, seed: int,
                     hash_method: str = "xxhash64", out: str = "fold",
                     n_buckets: int | None = None) -> DataFrame:
    """M2: inside each class, rows in hash order are dealt round-robin from fold 0
    (every class restarts at fold 0, as defined). Needs at least two classes."""
    if k < 2:
        raise ValueError("k must be at least 2")
    n_cls = df.select(label).distinct().limit(2).count()
    if n_cls < 2:
        raise ValueError("stratified folds need at least two classes")
    keys = [key] if isinstance(key, str) else list(key)
    d = df.withColumn("_h", row_hash(keys, seed, hash_method))
    r = row_number_global(d, ["_h", *keys], partition_cols=[label], out="_rn", n_buckets=n_buckets)
    return r.withColumn(out, F.pmod(F.col("_rn"), F.lit(k)).cast("int")).drop("_h", "_rn")


def train_test(df: DataFrame, key: Sequence[str] | str, test_fraction: float = 0.2, seed: int = 42,
               hash_method: str = "xxhash64", out: str = "is_test") -> DataFrame:
    """M3: hash threshold on the key - a projection, stable across runs and
    partitionings (unlike randomSplit)."""
    keys = [key] if isinstance(key, str) else list(key)
    u = row_hash(keys, seed, hash_method) / F.lit(TWO_32)
    return df.withColumn(out, u < F.lit(float(test_fraction)))
