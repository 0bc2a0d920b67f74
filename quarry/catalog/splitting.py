"""Folds and splits (M1-M3)."""

from __future__ import annotations

from quarry.catalog import register
from quarry.catalog.fixtures import fx
from quarry.functions.hashing import md5_sql
from quarry.operators import splits

_H = md5_sql("c_custkey", 42)


@register("kfold", f"SELECT c_custkey, (NTILE(5) OVER (ORDER BY {_H}, c_custkey) - 1)::INTEGER AS fold FROM customer")
def q_kfold(spark, sf):
    df = fx(spark, sf, "customer").select("c_custkey")
    return splits.kfold(df, 5, "c_custkey", 42, hash_method="md5", n_buckets=6)


@register("kfold_unshuffled", "SELECT c_custkey, (NTILE(4) OVER (ORDER BY c_custkey) - 1)::INTEGER AS fold FROM customer")
def q_kfold_plain(spark, sf):
    df = fx(spark, sf, "customer").select("c_custkey")
    return splits.kfold(df, 4, "c_custkey", 42, shuffle=False, hash_method="md5", n_buckets=3)


@register("stratified_kfold", f"""SELECT c_custkey, c_mktsegment,
  ((ROW_NUMBER() OVER (PARTITION BY c_mktsegment ORDER BY {_H}, c_custkey) - 1) % 5)::INTEGER AS fold FROM customer""")
def q_skfold(spark, sf):
    df = fx(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return splits.stratified_kfold(df, "c_mktsegment", 5, "c_custkey", 42, hash_method="md5", n_buckets=4)


@register("train_test_split", f"SELECT c_custkey, {_H} / 4294967296.0 < 0.2 AS is_test FROM customer")
def q_train_test(spark, sf):
    return splits.train_test(fx(spark, sf, "customer").select("c_custkey"), "c_custkey", 0.2, 42, hash_method="md5")
