"""Cross-validation and grid search (M6-M8).

Each candidate x fold fits its preprocessor on the training folds only. Forest
candidates are grown together: one binned table holds the training rows of every
fold, and a level of all (candidate, fold, tree, node) is one job over it; each
fold is then read once for the votes of all candidates, and one grouped pass
(``groupBy(candidate_id, fold)``) scores everything. Candidates that differ only
in how trees vote share a forest. Support vector candidates share the passes over
a fold's rows; folds run as concurrent Spark jobs. Candidates of other models run as
concurrent Spark jobs from a driver thread pool, their folds scored in one pass each.
"""

from __future__ import annotations

import itertools
import json
from concurrent.futures import ThreadPoolExecutor
from typing import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators import forest, metrics, models, pipeline, stattests, svr
from quarry.plans.joins import join_groups
from quarry.plans.parallel import spread
from quarry.session import cut_lineage

HIGHER_IS_BETTER = {"accuracy", "precision", "recall", "f1", "fbeta", "roc_auc", "average_precision", "r2",
                    "explained_variance"}


def expand_grid(grid: dict | Sequence[dict]) -> list[dict]:
    """Cartesian product of a dict of lists (or a list of such dicts)."""
    grids = [grid] if isinstance(grid, dict) else list(grid)
    out = []
    for g in grids:
        keys = sorted(g)
        for vals in itertools.product(*[g[k] if isinstance(g[k], (list, tuple)) else [g[k]] for k in keys]):
            out.append(dict(zip(keys, vals)))
    return out


def prepared(df: DataFrame, features: Sequence[str], prep: dict):
    """``df`` through a preprocessor fitted on its feature columns, the features that come out
    (an encoder may make several of one) and the preprocessor. Other columns stay, for an order or a key."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    numeric = [c for c in features if isinstance(kinds[c], T.NumericType)]
    categorical = [c for c in features if isinstance(kinds[c], T.StringType)]
    st = pipeline.fit_preprocessor(df, numeric=numeric, categorical=categorical,
                                   exclude=[c for c in df.columns if c not in features], **prep)
    out = pipeline.apply_preprocessor(df, st)
    return out, [c for c in out.columns if c in features or c not in df.columns], st


#: Folds that are prepared at once.
FOLD_THREADS = 4


def _folds(df: DataFrame, fold_col: str, features: Sequence[str], prep: dict | None) -> list:
    """(fold, training rows, test rows, features) of each fold, through a preprocessor fitted on the training rows."""
    def one(k):
        train, test, used = df.filter(F.col(fold_col) != k), df.filter(F.col(fold_col) == k), list(features)
        if prep is not None:
            train, used, st = prepared(train, features, prep)
            test = pipeline.apply_preprocessor(test, st)
        return k, train, test, used

    folds = sorted(r[0] for r in df.select(fold_col).distinct().collect() if r[0] is not None)
    with ThreadPoolExecutor(max_workers=FOLD_THREADS) as ex:
        return list(ex.map(one, folds))


def _forest_scores(df: DataFrame, fold_col: str, features: Sequence[str], label: str, key, cands: Sequence[dict],
                   prep: dict | None) -> DataFrame:
    """(candidate_id, fold, metric, value) of forest candidates, grown together on all folds."""
    folds = _folds(df, fold_col, features, prep)
    fits = [{k: v for k, v in c.items() if k in models.FOREST_FIT_KEYS} for c in cands]
    distinct = list({json.dumps(f, sort_keys=True): f for f in fits}.values())
    wanted = [(t, f) for t in range(len(folds)) for f in distinct]
    grown = iter(forest.fit_forests([(train, used) for _, train, _, used in folds], label, key, wanted))
    preds = None
    for k, _, test, used in folds:
        own = {json.dumps(f, sort_keys=True): next(grown) for f in distinct}
        p = forest.predict_forests(test, used, label, [(i, own[json.dumps(f, sort_keys=True)], c)
                                                       for i, (f, c) in enumerate(zip(fits, cands))])
        p = p.withColumn("fold", F.lit(k))
        preds = p if preds is None else preds.unionByName(p)
    return metrics.score_table(preds, "classification", label, "prediction", "p1", group_by=["candidate_id", "fold"])


def _svr_scores(df: DataFrame, fold_col: str, features: Sequence[str], label: str, key, cands: Sequence[dict],
                task: str, prep: dict | None, parallelism: int) -> DataFrame:
    """(candidate_id, fold, metric, value) of support vector candidates: those of a fold are fitted and predicted together."""
    fits = [{k: v for k, v in c.items() if k in models.SVR_FIT_KEYS} for c in cands]
    kept = prep is None  # then all folds read the same rows
    if kept:
        keys = [key] if isinstance(key, str) else list(key or ())
        df = spread(df.select(*dict.fromkeys([fold_col, *features, label, *keys]))).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        folds = _folds(df, fold_col, features, prep)
        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as ex:
            fitted = list(ex.map(lambda f: svr.fit_svrs(f[1], f[3], label, fits, key, kept=kept), folds))
        preds = None
        for (k, _, test, _), own in zip(folds, fitted):
            p = svr.predict_svrs(test, label, list(enumerate(own))).withColumn("fold", F.lit(k))
            preds = p if preds is None else preds.unionByName(p)
        return metrics.score_table(preds, task, label, "prediction", None, group_by=["candidate_id", "fold"])
    finally:
        if kept:
            df.unpersist()


def cross_validate(df: DataFrame, fold_col: str, kind: str, features: Sequence[str], label: str, key,
                   params: dict, task: str, prep: dict | None = None) -> DataFrame:
    """M6: per fold - preprocessor fitted on the other folds, model fitted,
    test fold predicted - then every metric of every fold in one pass.
    Output (fold, metric, value). Rows without a fold are left out."""
    if kind == "random_forest":
        return _forest_scores(df, fold_col, features, label, key, [params], prep).drop("candidate_id")
    if kind == "svr":
        return _svr_scores(df, fold_col, features, label, key, [params], task, prep, 1).drop("candidate_id")
    preds = None
    for k, train, test, used in _folds(df, fold_col, features, prep):
        fitted = models.fit_model(train, kind, used, label, key, params)
        p = models.predict_model(test, fitted).select(F.lit(k).alias("fold"), label, "prediction", "p1")
        preds = p if preds is None else preds.unionByName(p)
    has_p = task == "classification" and kind.startswith("random_forest")
    return metrics.score_table(preds, task, label, "prediction", "p1" if has_p else None, group_by="fold")


def _params_map(params: dict):
    return F.create_map(*[x for k_, v in sorted(params.items()) for x in (F.lit(k_), F.lit(str(v)))]) if params else \
        F.create_map().cast("map<string,string>")


def grid_search(df: DataFrame, fold_col: str, kind: str, features: Sequence[str], label: str, key, grid,
                task: str, refit_metric: str = "f1", prep: dict | None = None, parallelism: int = 4,
                refit: bool = True):
    """M7: returns (cv_table, best_params, refitted model or None). cv_table is
    (candidate_id, params, fold, metric, value); the best candidate has the best
    mean refit metric (first one wins ties)."""
    cands = expand_grid(grid)

    def run(i):
        t = cross_validate(df, fold_col, kind, features, label, key, cands[i], task, prep)
        return cut_lineage(t.select(F.lit(i).alias("candidate_id"), _params_map(cands[i]).alias("params"), "fold", "metric", "value"))

    if kind in ("random_forest", "svr"):
        scores = (_forest_scores(df, fold_col, features, label, key, cands, prep) if kind == "random_forest" else
                  _svr_scores(df, fold_col, features, label, key, cands, task, prep, parallelism))
        named = F.get(F.array(*map(_params_map, cands)), F.col("candidate_id"))
        tables = [cut_lineage(scores.select("candidate_id", named.alias("params"), "fold", "metric", "value"))]
    else:
        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as ex:
            tables = list(ex.map(run, range(len(cands))))
    cv = tables[0]
    for t in tables[1:]:
        cv = cv.unionByName(t)
    means = (cv.filter(F.col("metric") == refit_metric).groupBy("candidate_id")
             .agg(F.avg("value").alias("m")).collect())
    if not means:
        raise ValueError(f"no scores for refit metric {refit_metric!r}")
    sign = -1.0 if refit_metric in HIGHER_IS_BETTER else 1.0
    import math
    best = min(means, key=lambda r: (sign * r["m"] if r["m"] is not None and not math.isnan(r["m"]) else math.inf,
                                     r["candidate_id"]))
    best_params = cands[best["candidate_id"]]
    model = None
    if refit:
        used, st = list(features), None
        if prep is not None:
            df, used, st = prepared(df, features, prep)
        model = models.fit_model(df, kind, used, label, key, best_params)
        model.prep = st
    return cv, best_params, model


def cv_results(cv: DataFrame, level: float = 0.95) -> DataFrame:
    """M8: per (candidate, metric): mean, std, standard error, median, quartiles,
    CV % and the t confidence interval over folds."""
    g = ["candidate_id", "metric"]
    cv = cut_lineage(cv.select(*g, "value"))  # several passes read it: candidates x folds x metrics rows
    d = stattests.describe_groups(cv, "value", g)
    ci = stattests.confidence_interval(cv, "value", g, level).select(*g, "lower", "upper", "margin_of_error")
    return join_groups(d, ci, g)


def best_candidate(cv: DataFrame, refit_metric: str) -> DataFrame:
    """M8: the candidate with the best mean refit metric (lowest id on ties)."""
    m = cv.filter(F.col("metric") == refit_metric).groupBy("candidate_id", "params").agg(F.avg("value").alias("mean"))
    order = F.struct((-F.col("mean")) if refit_metric in HIGHER_IS_BETTER else F.col("mean"), F.col("candidate_id"))
    return m.agg(F.min_by(F.struct("candidate_id", "params", "mean"), order).alias("b")).select("b.*")
