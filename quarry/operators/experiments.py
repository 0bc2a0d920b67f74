"""Experiment runner (Y2-Y4): preprocessor + model as one bundle, with
optional cross-validated grid search, prediction, scoring and persistence."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import metrics, models, pipeline, search, splits
from quarry.sources import writers


class NotFittedError(RuntimeError):
    pass


@dataclass
class Bundle:
    prep: pipeline.PreprocessorState | None
    fitted: models.Fitted | None
    task: str
    features: list
    label: str
    key: list


def run_experiment(df: DataFrame, kind: str, features: Sequence[str], label: str, key, params: dict | None = None,
                   grid=None, k: int = 5, seed: int = 42, prep: dict | None = None, refit_metric: str | None = None,
                   parallelism: int = 4):
    """Y2: fit without CV, or with folds + grid search (then refit the best on
    all rows). The preprocessor is fitted on the training rows and kept with
    the model. Returns (bundle, cv_table or None)."""
    task = models.TASK_OF[kind]
    features = list(features)
    keys = [key] if isinstance(key, str) else list(key)
    cv = None
    if grid is not None:
        folded = (splits.stratified_kfold(df, label, k, keys, seed) if task == "classification"
                  else splits.kfold(df, k, keys, seed))
        metric = refit_metric or ("f1" if task == "classification" else "root_mean_squared_error")
        cv, best, _ = search.grid_search(folded, "fold", kind, features, label, keys, grid, task, metric, prep,
                                         parallelism, refit=False)
        params = best
    train, used, st = search.prepared(df, features, prep) if prep is not None else (df, features, None)
    fitted = models.fit_model(train, kind, used, label, keys, params or {})
    return Bundle(st, fitted, task, features, label, keys), cv


def predict(df: DataFrame, bundle: Bundle) -> DataFrame:
    """Through the fitted preprocessor; p1 is NULL for models without probabilities."""
    if bundle is None or bundle.fitted is None:
        raise NotFittedError("model is not fitted")
    return models.predict_model(df if bundle.prep is None else pipeline.apply_preprocessor(df, bundle.prep), bundle.fitted)


def score(df: DataFrame, bundle: Bundle, json_path: str | None = None) -> DataFrame:
    """All metrics of the task (+ target / prediction diagnostics); written
    as JSON when a path is given (S11)."""
    p = predict(df, bundle)
    proba = "p1" if bundle.task == "classification" and bundle.fitted.kind.startswith("random_forest") else None
    t = metrics.score_table(p, bundle.task, bundle.label, "prediction", proba)
    if json_path:
        writers.write_json(t, json_path)
    return t


def save_bundle(bundle: Bundle, path: str, spark: SparkSession) -> None:
    """Preprocessor state and model state as tables, never pickle."""
    if bundle.prep is not None:
        pipeline.save_preprocessor(bundle.prep, f"{path}/preprocessor", spark)
    models.save_model(bundle.fitted, f"{path}/model", spark)
    import json
    spark.createDataFrame([(json.dumps({"task": bundle.task, "features": bundle.features, "label": bundle.label,
                                        "key": bundle.key, "has_prep": bundle.prep is not None}),)],
                          "manifest string").coalesce(1).write.mode("overwrite").text(f"{path}/_bundle")


def load_bundle(spark: SparkSession, path: str) -> Bundle:
    import json
    meta = json.loads(spark.read.text(f"{path}/_bundle").first()["value"])
    st = pipeline.load_preprocessor(spark, f"{path}/preprocessor") if meta["has_prep"] else None
    return Bundle(st, models.load_model(spark, f"{path}/model"), meta["task"], meta["features"], meta["label"],
                  meta["key"])
