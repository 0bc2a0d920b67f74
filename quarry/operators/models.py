"""Model adapters: one fit/predict interface over the forest, the SVR and the
Spark ML baselines, plus persistence of their small state as tables (S12)."""

from __future__ import annotations

import json
from dataclasses import dataclass
from typing import Sequence

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import forest, pipeline, svr

MODELS = ("random_forest", "random_forest_ml", "svr", "huber_regression")
TASK_OF = {"random_forest": "classification", "random_forest_ml": "classification", "svr": "regression",
           "huber_regression": "regression"}
FOREST_FIT_KEYS = ("n_trees", "max_depth", "min_samples_split", "min_samples_leaf", "impurity", "max_features",
                   "max_bins", "seed")
SVR_FIT_KEYS = ("kernel", "C", "epsilon", "gamma", "coef0", "degree", "n_landmarks", "max_iter", "tol", "seed")


@dataclass
class Fitted:
    kind: str
    model: object
    features: list
    params: dict
    prep: object = None    # fitted preprocessor that predictions need first


def fit_model(df: DataFrame, kind: str, features: Sequence[str], label: str, key, params: dict | None = None) -> Fitted:
    p = dict(params or {})
    if kind == "random_forest":
        fp = {k: v for k, v in p.items() if k in FOREST_FIT_KEYS}
        m = forest.fit_forest(df, features, label, key, **fp)
    elif kind == "random_forest_ml":
        m = forest.fit_forest_ml(df, features, label, n_trees=p.get("n_trees", 100), max_depth=p.get("max_depth", 15),
                                 min_instances=p.get("min_samples_leaf", 2), impurity=p.get("impurity", "gini"),
                                 seed=p.get("seed", 42))
    elif kind == "svr":
        sp = {k: v for k, v in p.items() if k in SVR_FIT_KEYS}
        m = svr.fit_svr(df, features, label, key=key, **sp)
    elif kind == "huber_regression":
        m = svr.fit_baseline_regressor(df, features, label, "huber")
    else:
        raise ValueError(f"unknown model {kind!r}; expected one of {MODELS}")
    return Fitted(kind, m, list(features), p)


def predict_model(df: DataFrame, fitted: Fitted) -> DataFrame:
    """Adds ``prediction`` (and ``p1`` = P(1) for classifiers; NULL when the
    model has no probabilities)."""
    if fitted.prep is not None:
        df = pipeline.apply_preprocessor(df, fitted.prep)
    k = fitted.kind
    if k == "random_forest":
        out = forest.predict_forest(df, fitted.model, fitted.params.get("vote", "soft"),
                                    fitted.params.get("threshold", 0.5))
        return out.withColumn("p1", F.element_at("probability", 2)).drop("probability", "confidence")
    if k == "random_forest_ml":
        from pyspark.ml.functions import vector_to_array
        out = fitted.model.transform(df)
        return (out.withColumn("p1", F.element_at(vector_to_array("probability"), 2))
                .withColumn("prediction", F.col("prediction").cast("int"))
                .drop("_features", "rawPrediction", "probability"))
    if k == "svr":
        return svr.predict_svr(df, fitted.model).withColumn("p1", F.lit(None).cast("double"))
    out = fitted.model.transform(df).drop("_features")
    return out.withColumn("p1", F.lit(None).cast("double"))


# ----------------------------------------------------------------------------- S12

def save_model(fitted: Fitted, path: str, spark: SparkSession) -> None:
    """Model state as parquet tables (never pickle) + a JSON manifest."""
    meta = {"kind": fitted.kind, "features": fitted.features, "params": fitted.params}
    if fitted.kind == "random_forest":
        m = fitted.model
        m.node_table(spark).write.mode("overwrite").parquet(f"{path}/nodes")
        rows = [(t, list(map(int, fs))) for t, fs in enumerate(m.tree_features)]
        spark.createDataFrame(rows, "tree_id int, features array<int>").write.mode("overwrite").parquet(f"{path}/tree_features")
        meta["thresholds"] = {c: list(map(float, v)) for c, v in m.thresholds.items()}
        meta["impurity"] = m.impurity
        meta["forest_features"] = m.features
    elif fitted.kind == "svr":
        m = fitted.model
        meta.update(kernel=m.kernel, gamma=m.gamma, coef0=m.coef0, degree=m.degree, C=m.C, epsilon=m.epsilon,
                    b=m.b, objective=m.objective, cols=m.cols)
        spark.createDataFrame([(i, list(map(float, v))) for i, v in enumerate(m.w.reshape(1, -1))],
                              "i int, v array<double>").write.mode("overwrite").parquet(f"{path}/w")
        if m.landmarks is not None:
            spark.createDataFrame([(i, list(map(float, v))) for i, v in enumerate(m.landmarks)],
                                  "i int, v array<double>").write.mode("overwrite").parquet(f"{path}/landmarks")
            spark.createDataFrame([(i, list(map(float, v))) for i, v in enumerate(m.proj)],
                                  "i int, v array<double>").write.mode("overwrite").parquet(f"{path}/proj")
    else:
        fitted.model.write().overwrite().save(f"{path}/ml")
    spark.createDataFrame([(json.dumps(meta),)], "manifest string").coalesce(1).write.mode("overwrite").text(
        f"{path}/_manifest")


def _mat(spark, p):
    rows = sorted(spark.read.parquet(p).collect(), key=lambda r: r["i"])
    return np.array([r["v"] for r in rows], dtype=np.float64)


def load_model(spark: SparkSession, path: str) -> Fitted:
    meta = json.loads(spark.read.text(f"{path}/_manifest").first()["value"])
    kind = meta["kind"]
    if kind == "random_forest":
        nodes = spark.read.parquet(f"{path}/nodes").toPandas().sort_values(["tree_id", "node_id"])
        tf = {r["tree_id"]: list(r["features"]) for r in spark.read.parquet(f"{path}/tree_features").collect()}
        feats = meta["forest_features"]
        m = forest.Forest(feats, {c: np.asarray(v) for c, v in meta["thresholds"].items()}, meta["impurity"])
        for t, g in nodes.groupby("tree_id"):
            fidx = g["feature"].map(lambda f: feats.index(f) if isinstance(f, str) else -1).to_numpy()
            m.trees.append({"feat": fidx.astype(np.int64), "bin": np.zeros(len(g), np.int64),
                            "thr": g["threshold"].fillna(np.nan).to_numpy(np.float64),
                            "left": g["left"].to_numpy(np.int64), "right": g["right"].to_numpy(np.int64),
                            "c0": g["c0"].to_numpy(np.float64), "c1": g["c1"].to_numpy(np.float64),
                            "imp": g["impurity"].to_numpy(np.float64), "depth": g["depth"].to_numpy(np.int64)})
            m.tree_features.append(tf.get(t, []))
        return Fitted(kind, m, meta["features"], meta["params"])
    if kind == "svr":
        L = _mat(spark, f"{path}/landmarks") if meta["kernel"] != "linear" else None
        P = _mat(spark, f"{path}/proj") if meta["kernel"] != "linear" else None
        w = _mat(spark, f"{path}/w").ravel()
        m = svr.SVRModel(meta["cols"], meta["kernel"], meta["gamma"], meta["coef0"], meta["degree"], meta["C"],
                         meta["epsilon"], L, P, w, meta["b"], meta["objective"])
        return Fitted(kind, m, meta["features"], meta["params"])
    from pyspark.ml import PipelineModel
    return Fitted(kind, PipelineModel.load(f"{path}/ml"), meta["features"], meta["params"])
