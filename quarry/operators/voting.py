"""Feature voting and selection (V rows) on the long score table.

The score table has one row per (method, feature): its size is methods x
features, so every window here is partitioned by method (or by feature) over
a table that does not grow with the data.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators import scoring
from quarry.plans.joins import join_groups

STRATEGIES = ("union", "intersection", "majority", "weighted")
DEFAULT_THRESHOLD = 0.2
DEFAULT_STRATEGY = "majority"


def _rank(scores: DataFrame) -> DataFrame:
    w = Window.partitionBy("method").orderBy(F.desc("score"), F.asc("feature"))
    return scores.withColumn("rank", F.row_number().over(w))


def select_threshold(scores: DataFrame, threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """V1: selected = score >= threshold (per method)."""
    return _rank(scores).withColumn("selected", F.col("score") >= F.lit(float(threshold))) \
                        .withColumn("threshold", F.lit(float(threshold)))


def select_top_k(scores: DataFrame, k: int) -> DataFrame:
    """V2: top-k per method by score (ties broken by feature name)."""
    return _rank(scores).withColumn("selected", F.col("rank") <= F.lit(int(k))) \
                        .withColumn("threshold", F.lit(0.0))


def select_top_percentile(scores: DataFrame, p: float) -> DataFrame:
    """V3: k = max(1, int(d * p)) per method."""
    d = F.count(F.lit(1)).over(Window.partitionBy("method"))
    r = _rank(scores).withColumn("_k", F.greatest(F.lit(1), F.floor(d * F.lit(float(p)))))
    return r.withColumn("selected", F.col("rank") <= F.col("_k")).drop("_k").withColumn("threshold", F.lit(0.0))


def vote(selected: DataFrame) -> DataFrame:
    """V4: votes per feature and mean rank; a feature missing from a method gets
    the worst rank (largest feature count of any method)."""
    # worst rank and method count in one aggregate over the (methods x features) table
    stats = selected.groupBy("method").agg(F.count(F.lit(1)).alias("d")) \
                    .agg(F.max("d").alias("worst"), F.count(F.lit(1)).alias("n_methods"))
    per = selected.groupBy("feature").agg(F.sum(F.col("selected").cast("int")).alias("votes"),
                                          F.sum("rank").alias("_rs"), F.count(F.lit(1)).alias("_nm"))
    out = join_groups(per, stats, [])
    avg_rank = (F.col("_rs") + (F.col("n_methods") - F.col("_nm")) * F.col("worst")) / F.col("n_methods")
    return out.select("feature", F.col("votes").cast("long").alias("votes"), avg_rank.alias("avg_rank"),
                      "n_methods")


def combine(selected: DataFrame, strategy: str = DEFAULT_STRATEGY, weights: Mapping[str, float] | None = None,
            min_votes: int | None = None) -> DataFrame:
    """V5-V9: UNION (votes > 0), INTERSECTION (votes = methods), MAJORITY
    (votes >= floor(m/2) + 1), WEIGHTED (sum weight x score / max >= mean
    threshold); optional min_votes; ordered by mean rank, then feature."""
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown strategy {strategy!r}")
    v = vote(selected)
    if strategy == "union":
        final = F.col("votes") > 0
    elif strategy == "intersection":
        final = F.col("votes") == F.col("n_methods")
    elif strategy == "majority":
        final = F.col("votes") >= F.floor(F.col("n_methods") / 2) + 1
    else:
        wt = F.lit(1.0)
        for m, wv in (weights or {}).items():
            wt = F.when(F.col("method") == m, F.lit(float(wv))).otherwise(wt)
        ws = selected.groupBy("feature").agg(F.sum(wt * F.col("score")).alias("weighted_score"))
        thr = selected.groupBy("method").agg(F.max("threshold").alias("t")).agg(F.avg("t").alias("_thr"))
        mx = ws.agg(F.max("weighted_score").alias("_mx"))
        ws = join_groups(join_groups(ws, mx, []), thr, [])
        ws = ws.withColumn("weighted_score", F.when(F.col("_mx") > 0, F.col("weighted_score") / F.col("_mx"))
                           .otherwise(F.col("weighted_score")))
        v = v.join(ws.select("feature", "weighted_score", "_thr"), on="feature", how="left")
        final = F.col("weighted_score") >= F.col("_thr")
    v = v.withColumn("final_selected", F.coalesce(final, F.lit(False)))
    if min_votes is not None:
        v = v.withColumn("final_selected", F.col("final_selected") & (F.col("votes") >= F.lit(int(min_votes))))
    return v.drop("_thr")


def ranked_selection(combined: DataFrame) -> DataFrame:
    """V9 order: selected features by mean rank (feature name breaks ties)."""
    w = Window.partitionBy("final_selected").orderBy("avg_rank", "feature")  # two partitions of <= d rows
    return combined.filter("final_selected").withColumn("position", F.row_number().over(w)) \
                   .select("position", "feature", "votes", "avg_rank")


def selection_summary(selected: DataFrame, combined: DataFrame, methods: Sequence[str]) -> DataFrame:
    """One row per feature with <method>_score, <method>_selected, votes,
    avg_rank and final_selected (pivot with an explicit method list)."""
    wide = (selected.groupBy("feature").pivot("method", list(methods))
            .agg(F.first("score").alias("score"), F.first("selected").alias("selected")))
    return wide.join(combined.select("feature", "votes", "avg_rank", "final_selected"), on="feature")


def score_summary(scores: DataFrame, methods: Sequence[str]) -> DataFrame:
    """Wide scores plus their mean, sorted by mean score descending."""
    wide = scores.groupBy("feature").pivot("method", list(methods)).agg(F.first("score"))
    mean = sum((F.coalesce(F.col(m), F.lit(0.0)) for m in methods), F.lit(0.0)) / len(methods)
    return wide.withColumn("mean_score", mean)


def select_best_features(df: DataFrame, target: str, task: str, label_cols: Sequence[str] = (),
                         methods: Sequence[str] = scoring.DEFAULT_METHODS, threshold: float = DEFAULT_THRESHOLD,
                         strategy: str = DEFAULT_STRATEGY, features=None, weights=None,
                         min_votes: int | None = None) -> DataFrame:
    """Methods x threshold x strategy -> ranked list of selected features."""
    scores = scoring.feature_scores(df, target, task, methods, features, label_cols)
    sel = select_threshold(scores, threshold)
    return ranked_selection(combine(sel, strategy, weights, min_votes))
