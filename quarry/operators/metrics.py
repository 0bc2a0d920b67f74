"""Evaluation metrics as aggregations over (y_true, y_pred[, score]).

Every metric accepts ``group_by`` and returns one row per group. Regression
metrics come from one aggregation pass; classification metrics from one
``groupBy(y_true, y_pred).count()`` confusion pass (a table of at most
classes^2 rows per group); curves from per-distinct-score counts followed
by bucketed running sums (no global window).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.plans.ranks import row_number_global, running_sums
from quarry.plans.joins import join_groups, join_null_safe
from quarry.plans.quantiles import fresh_name, group_quantiles
from quarry.session import cut_lineage

# Machine epsilon of float64 (MAPE denominator floor) and the log-loss clip.
FLOAT64_EPS = 2.220446049250313e-16
LOG_LOSS_EPS = 1e-15
DEFAULT_BETA = 2.0

_INF = float("inf")


def _g(group_by) -> list[str]:
    if group_by is None:
        return []
    return [group_by] if isinstance(group_by, str) else list(group_by)


def _agg(df: DataFrame, group_by, *exprs) -> DataFrame:
    g = _g(group_by)
    return df.groupBy(*g).agg(*exprs) if g else df.agg(*exprs)


# ----------------------------------------------------------------------------- regression

def regression_report(df: DataFrame, y_true: str, y_pred: str, group_by=None,
                      normalization: str = "mean", force_finite: bool = True) -> DataFrame:
    """All regression metrics (Q1-Q11) in one aggregation pass, and one sort for the median."""
    if normalization not in ("mean", "min-max", "euclidean"):
        raise ValueError(f"normalization must be mean, min-max or euclidean, not {normalization!r}")
    y = F.col(y_true).cast("double")
    p = F.col(y_pred).cast("double")
    d = y - p
    ad = F.abs(d)
    base = _agg(
        df, group_by,
        F.count(F.lit(1)).alias("n"),
        F.max(ad).alias("max_error"),
        F.avg(ad).alias("mean_absolute_error"),
        F.avg(d * d).alias("mean_squared_error"),
        (F.avg(ad / F.greatest(F.lit(FLOAT64_EPS), F.abs(y))) * 100.0).alias("mean_absolute_percentage_error"),
        F.var_pop(y).alias("_vy"),
        F.var_pop(d).alias("_vd"),
        F.avg(y).alias("_my"),
        (F.max(y) - F.min(y)).alias("_range"),
        F.sqrt(F.sum(y * y)).alias("_norm"),
        F.least(F.min(y), F.min(p)).alias("_minyp"),
        F.avg(F.pow(F.log1p(y) - F.log1p(p), 2)).alias("_msle"),
    )
    g = _g(group_by)
    med = group_quantiles(df.select(*g, ad.alias("_ad")), "_ad", g, [0.5], "_q")
    base = join_groups(base, med, g, how="left").withColumn("median_absolute_error", F.col("_q")[0]).drop("_q")
    denom = {"mean": F.col("_my"), "min-max": F.col("_range"), "euclidean": F.col("_norm")}[normalization]
    bad = F.lit(-_INF) if force_finite else F.lit(float("nan"))
    rmse = F.sqrt(F.col("mean_squared_error"))
    out = (base
           .withColumn("root_mean_squared_error", rmse)
           .withColumn("normalized_root_mean_squared_error",
                       F.when(F.abs(denom) < 1e-12, F.lit(_INF)).otherwise(rmse / denom))
           .withColumn("r2", F.when(F.col("_vy") == 0, bad)
                       .otherwise(1.0 - F.col("mean_squared_error") / F.col("_vy")))
           .withColumn("explained_variance", F.when(F.col("_vy") == 0, bad)
                       .otherwise(1.0 - F.col("_vd") / F.col("_vy")))
           .withColumn("mean_squared_log_error", F.when(F.col("_minyp") >= 0, F.col("_msle")))
           .withColumn("root_mean_squared_log_error",
                       F.when(F.col("_minyp") >= 0, F.sqrt(F.col("_msle")))))
    return out.drop("_vy", "_vd", "_my", "_range", "_norm", "_minyp", "_msle")


def _single(name: str):
    def fn(df: DataFrame, y_true: str, y_pred: str, group_by=None, **kw) -> DataFrame:
        r = regression_report(df, y_true, y_pred, group_by, **kw)
        return r.select(*_g(group_by), F.col(name).alias("value"))
    fn.__name__ = name
    fn.__doc__ = f"{name.replace('_', ' ')} per group -> (group..., value)."
    return fn


max_error = _single("max_error")
mean_absolute_error = _single("mean_absolute_error")
mean_squared_error = _single("mean_squared_error")
median_absolute_error = _single("median_absolute_error")
root_mean_squared_error = _single("root_mean_squared_error")
normalized_root_mean_squared_error = _single("normalized_root_mean_squared_error")
mean_squared_log_error = _single("mean_squared_log_error")
root_mean_squared_log_error = _single("root_mean_squared_log_error")
mean_absolute_percentage_error = _single("mean_absolute_percentage_error")
r2_score = _single("r2")
explained_variance_score = _single("explained_variance")


def target_diagnostics(df: DataFrame, cols: Sequence[str], group_by=None) -> DataFrame:
    """Q23: min, max, mean and population std of target / prediction columns (long form)."""
    g = _g(group_by)
    parts = []
    for c in cols:
        x = F.col(c).cast("double")
        parts.append(_agg(df, g, F.min(x).alias("min"), F.max(x).alias("max"),
                          F.avg(x).alias("mean"), F.stddev_pop(x).alias("std"))
                     .select(*g, F.lit(c).alias("column"), "min", "max", "mean", "std"))
    out = parts[0]
    for p_ in parts[1:]:
        out = out.unionByName(p_)
    return out


# ----------------------------------------------------------------------------- classification

def _label(df: DataFrame, c: str) -> Column:
    """Class labels: whole numbers and booleans as long, other numbers as double (so that 1 equals 1.0 but not 1.2),
    any other type as it is."""
    kind = df.schema[c].dataType
    if isinstance(kind, (T.IntegralType, T.BooleanType)):
        return F.col(c).cast("long")
    return F.col(c).cast("double") if isinstance(kind, T.NumericType) else F.col(c)


def confusion_counts(df: DataFrame, y_true: str, y_pred: str, group_by=None) -> DataFrame:
    """Q13: per (group, class) tp, fp, fn, support; classes come from y_true."""
    g = _g(group_by)
    pairs = (df.select(*g, _label(df, y_true).alias("t"), _label(df, y_pred).alias("p"))
             .groupBy(*g, "t", "p").agg(F.count(F.lit(1)).alias("n")))
    by_true = pairs.groupBy(*g, F.col("t").alias("class")).agg(
        F.sum("n").alias("support"),
        F.sum(F.when(F.col("t") == F.col("p"), F.col("n")).otherwise(0)).alias("tp"))
    by_pred = pairs.groupBy(*g, F.col("p").alias("class")).agg(F.sum("n").alias("predicted"))
    return (join_null_safe(by_true, by_pred, [*g, "class"], "left")
            .select(*g, "class", F.col("tp").cast("long").alias("tp"),
                    (F.coalesce(F.col("predicted"), F.lit(0)) - F.col("tp")).cast("long").alias("fp"),
                    (F.col("support") - F.col("tp")).cast("long").alias("fn"),
                    F.col("support").cast("long").alias("support")))


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a.cast("double") / b).otherwise(F.lit(0.0))


def _fbeta(prec: Column, rec: Column, beta: float) -> Column:
    b2 = beta * beta
    return F.when(prec + rec > 0, (1 + b2) * prec * rec / (b2 * prec + rec)).otherwise(F.lit(0.0))


def classification_report(df: DataFrame, y_true: str, y_pred: str, group_by=None,
                          average: str = "binary", beta: float = DEFAULT_BETA,
                          pos_label=1) -> DataFrame:
    """Q12, Q14-Q17: accuracy, precision, recall, f1, fbeta for one averaging mode.

    ``binary`` on more than two classes raises at execution time.
    """
    if average not in ("binary", "micro", "macro", "weighted"):
        raise ValueError(f"average must be binary, micro, macro or weighted, not {average!r}")
    g = _g(group_by)
    acc = _agg(df, g, F.avg((_label(df, y_true) == _label(df, y_pred)).cast("double"))
               .alias("accuracy"), F.count(F.lit(1)).alias("n"))
    cc = confusion_counts(df, y_true, y_pred, g)
    per = (cc.withColumn("precision", _ratio(F.col("tp"), F.col("tp") + F.col("fp")))
             .withColumn("recall", _ratio(F.col("tp"), F.col("tp") + F.col("fn"))))
    per = per.withColumn("f1", _fbeta(F.col("precision"), F.col("recall"), 1.0)) \
             .withColumn("fbeta", _fbeta(F.col("precision"), F.col("recall"), beta))
    if average == "binary":
        ncls = _agg(cc, g, F.count(F.lit(1)).alias("_k"))
        pos = per.filter(F.col("class") == pos_label).select(*g, "precision", "recall", "f1", "fbeta")
        agg = join_groups(ncls, pos, g, how="left")
        agg = agg.select(*g, *[
            F.when(F.col("_k") > 2, F.raise_error(F.lit(
                "binary average on multi-class data; use micro, macro or weighted")).cast("double"))
            .otherwise(F.coalesce(F.col(m), F.lit(0.0))).alias(m)
            for m in ("precision", "recall", "f1", "fbeta")])
    elif average == "micro":
        b2 = beta * beta
        s = _agg(cc, g, F.sum("tp").alias("tp"), F.sum("fp").alias("fp"), F.sum("fn").alias("fn"))
        agg = s.select(*g,
                       _ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
                       _ratio(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"),
                       _ratio(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")).alias("f1"),
                       _ratio((1 + b2) * F.col("tp"),
                              (1 + b2) * F.col("tp") + b2 * F.col("fn") + F.col("fp")).alias("fbeta"))
    elif average == "macro":
        agg = _agg(per, g, *[F.avg(m).alias(m) for m in ("precision", "recall", "f1", "fbeta")])
    else:
        agg = _agg(per, g, F.sum("support").alias("_s"),
                   *[F.sum(F.col(m) * F.col("support")).alias(m) for m in ("precision", "recall", "f1", "fbeta")])
        agg = agg.select(*g, *[_ratio(F.col(m), F.col("_s")).alias(m)
                               for m in ("precision", "recall", "f1", "fbeta")])
    return join_groups(acc, agg, g)


def accuracy_score(df, y_true, y_pred, group_by=None):
    return _agg(df, group_by, F.avg((F.col(y_true) == F.col(y_pred)).cast("double")).alias("value"))


def log_loss(df: DataFrame, y_true: str, proba: str, group_by=None, eps: float = LOG_LOSS_EPS,
             classes: Sequence | None = None) -> DataFrame:
    """Q18. ``proba`` is P(1) (double) or an array of class probabilities whose
    positions follow the sorted ``classes`` of the model; without them the sorted
    distinct classes of ``y_true``, which are the model's only if each occurs."""
    g = _g(group_by)
    dt = df.schema[proba].dataType.simpleString()
    y = F.col(y_true).cast("double")
    if dt.startswith("array"):
        klass, place = (fresh_name(df.columns, n) for n in ("class", "place"))
        j = df.join(class_places(df, y_true, classes, klass, place), _label(df, y_true) == F.col(klass), "left")
        pt = F.element_at(F.col(proba), F.col(place) + 1).cast("double")
        pt = F.least(F.greatest(pt, F.lit(eps)), F.lit(1 - eps))
        return _agg(j, g, (-F.avg(F.ln(pt))).alias("value"))
    p = F.least(F.greatest(F.col(proba).cast("double"), F.lit(eps)), F.lit(1 - eps))
    return _agg(df, g, (-F.avg(y * F.ln(p) + (1 - y) * F.ln(1 - p))).alias("value"))


#: Classes that are sent to every task as a table at most; more are joined by a shuffle.
MAX_CLASSES = 10_000


def class_list(df: DataFrame, y_true: str, max_classes: int = MAX_CLASSES) -> list:
    """Sorted distinct classes (a size-checked list: class counts are small)."""
    rows = df.select(_label(df, y_true).alias("c")).distinct().limit(max_classes + 1).collect()
    if len(rows) > max_classes:
        raise ValueError(f"more than {max_classes} classes in {y_true}")
    return sorted(r["c"] for r in rows if r["c"] is not None)


def class_places(df: DataFrame, y_true: str, classes: Sequence | None, klass: str, place: str) -> DataFrame:
    """(``klass``, ``place`` from 0) of the sorted ``classes``, or of the distinct ones of ``y_true``."""
    label = _label(df, y_true)
    kind = df.select(label.alias("c")).schema["c"].dataType
    if classes is None:
        found = df.select(label.alias(klass)).filter(F.col(klass).isNotNull()).distinct()
        few = [r[0] for r in found.limit(MAX_CLASSES + 1).collect()]
        if len(few) > MAX_CLASSES:
            return cut_lineage(row_number_global(found, [klass], out=place).select(klass, F.col(place).cast("int").alias(place)))
        classes = few
    whole = float if isinstance(kind, T.DoubleType) else int if isinstance(kind, T.LongType) else (lambda c: c)
    schema = T.StructType([T.StructField(klass, kind), T.StructField(place, T.IntegerType())])
    return F.broadcast(df.sparkSession.createDataFrame([(c, i) for i, c in enumerate(sorted(map(whole, classes)))], schema))


# ----------------------------------------------------------------------------- curves

def _score_counts(df: DataFrame, y_true: str, score: str, g: list[str]) -> DataFrame:
    y = F.col(y_true).cast("long")
    return (df.groupBy(*g, F.col(score).cast("double").alias("threshold"))
            .agg(F.sum((y == 1).cast("long")).alias("pos"), F.sum((y != 1).cast("long")).alias("neg")))


def _curve(df: DataFrame, y_true: str, score: str, group_by=None, n_buckets=None) -> DataFrame:
    g = _g(group_by)
    c = _score_counts(df, y_true, score, g)
    r = running_sums(c, [("threshold", False)], ["pos", "neg"], partition_cols=g, n_buckets=n_buckets)
    tot = _agg(c, g, F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    return join_groups(r, tot, g)


def roc_curve(df: DataFrame, y_true: str, score: str, group_by=None, n_buckets=None) -> DataFrame:
    """Q19 curve: one point per distinct score (ties form one step)."""
    g = _g(group_by)
    c = _curve(df, y_true, score, g, n_buckets)
    return c.select(*g, "threshold",
                    _ratio(F.col("cum_neg"), F.col("N")).alias("fpr"),
                    _ratio(F.col("cum_pos"), F.col("P")).alias("tpr"))


def roc_auc_score(df: DataFrame, y_true: str, score: str, group_by=None, n_buckets=None) -> DataFrame:
    """Q19: trapezoid area; 0 when a class is missing."""
    g = _g(group_by)
    c = _curve(df, y_true, score, g, n_buckets)
    area = ((F.col("neg") / F.col("N")) *
            ((F.col("cum_pos") + (F.col("cum_pos") - F.col("pos"))) / (2.0 * F.col("P"))))
    c = c.withColumn("_a", F.when((F.col("P") > 0) & (F.col("N") > 0), area).otherwise(0.0))
    return _agg(c, g, F.sum("_a").alias("value"))


def precision_recall_curve(df: DataFrame, y_true: str, score: str, group_by=None, n_buckets=None):
    g = _g(group_by)
    c = _curve(df, y_true, score, g, n_buckets)
    return c.select(*g, "threshold",
                    _ratio(F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg")).alias("precision"),
                    _ratio(F.col("cum_pos"), F.col("P")).alias("recall"))


def average_precision_score(df: DataFrame, y_true: str, score: str, group_by=None, n_buckets=None):
    """Q20: sum over distinct thresholds of (recall step) x precision; 0 without positives."""
    g = _g(group_by)
    c = _curve(df, y_true, score, g, n_buckets)
    term = (F.col("pos") / F.col("P")) * (F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg")))
    c = c.withColumn("_a", F.when(F.col("P") > 0, term).otherwise(0.0))
    return _agg(c, g, F.sum("_a").alias("value"))


def roc_auc_ovr(df: DataFrame, y_true: str, proba: str, group_by=None, n_buckets=None, classes: Sequence | None = None) -> DataFrame:
    """Q21: mean one-vs-rest AUC; array positions follow the sorted ``classes`` of the model (without them the
    distinct ones of ``y_true``). A class of the model without rows has no curve and is left out of the mean."""
    g = _g(group_by)
    klass, place, truth, score, own = (fresh_name(g, n) for n in ("class", "place", "truth", "score", "own"))
    ex = df.select(*g, _label(df, y_true).alias(truth), F.posexplode(F.col(proba)).alias("at", score))
    ex = ex.join(class_places(df, y_true, classes, klass, place), F.col("at") == F.col(place))
    ex = ex.withColumn(own, (F.col(truth) == F.col(klass)).cast("int"))
    per = roc_auc_score(ex, own, score, group_by=[*g, klass], n_buckets=n_buckets)
    if classes is not None:
        seen = ex.groupBy(*g, klass).agg(F.max(own).alias(own)).filter(F.col(own) == 1).drop(own)
        per = join_null_safe(per, seen, [*g, klass], "left_semi")
    return _agg(per, g, F.avg("value").alias("value"))


# ----------------------------------------------------------------------------- scorer

def score_table(df: DataFrame, task: str, y_true: str, y_pred: str, proba: str | None = None,
                group_by=None, beta: float = DEFAULT_BETA, classes: Sequence | None = None) -> DataFrame:
    """Q22: all metrics of the task as a long table (group..., metric, value).
    ``classes``: those of the model, whose sorted order the places of an array ``proba`` follow.

    The few columns that the metrics read are checkpointed first, so whatever
    predicted them runs once per row."""
    g = _g(group_by)
    df = cut_lineage(df.select(*dict.fromkeys([*g, y_true, y_pred, *([proba] if proba else [])])))
    if task == "regression":
        r = regression_report(df, y_true, y_pred, g)
        names = ["max_error", "mean_absolute_error", "mean_absolute_percentage_error", "mean_squared_error",
                 "median_absolute_error", "root_mean_squared_error", "normalized_root_mean_squared_error",
                 "r2", "explained_variance", "mean_squared_log_error", "root_mean_squared_log_error"]
        return _long(r, g, names)
    if task != "classification":
        raise ValueError(f"task must be regression or classification, not {task!r}")
    k = _agg(df.select(*g, y_true).distinct(), g, F.count(F.lit(1)).alias("_k"))
    n_classes = max(k.agg(F.max("_k")).first()[0] or 0, len(classes or ()))
    parts = []
    if n_classes > 2:
        for avg_ in ("micro", "macro", "weighted"):
            rep = classification_report(df, y_true, y_pred, g, avg_, beta)
            parts.append(_long(rep.select(*g, *[F.col(m).alias(f"{m}_{avg_}") for m in
                                               ("precision", "recall", "f1")],
                                          F.col("fbeta").alias(f"fbeta_{avg_}")), g,
                               [f"precision_{avg_}", f"recall_{avg_}", f"f1_{avg_}", f"fbeta_{avg_}"]))
        acc = classification_report(df, y_true, y_pred, g, "micro", beta)
        parts.append(_long(acc, g, ["accuracy"]))
        if proba is not None:
            parts.append(_long(log_loss(df, y_true, proba, g, classes=classes).withColumnRenamed("value", "log_loss"), g, ["log_loss"]))
            parts.append(_long(roc_auc_ovr(df, y_true, proba, g, classes=classes).withColumnRenamed("value", "roc_auc"), g, ["roc_auc"]))
    else:
        rep = classification_report(df, y_true, y_pred, g, "binary", beta)
        parts.append(_long(rep, g, ["accuracy", "precision", "recall", "f1", "fbeta"]))
        if proba is not None:
            pcol = proba
            if df.schema[proba].dataType.simpleString().startswith("array"):
                df = df.withColumn("_p1", F.element_at(F.col(proba), -1))
                pcol = "_p1"
            parts.append(_long(log_loss(df, y_true, pcol, g).withColumnRenamed("value", "log_loss"), g, ["log_loss"]))
            parts.append(_long(roc_auc_score(df, y_true, pcol, g).withColumnRenamed("value", "roc_auc"), g, ["roc_auc"]))
            parts.append(_long(average_precision_score(df, y_true, pcol, g)
                               .withColumnRenamed("value", "average_precision"), g, ["average_precision"]))
    out = parts[0]
    for p_ in parts[1:]:
        out = out.unionByName(p_)
    return out


def _long(df: DataFrame, g: list[str], names: list[str]) -> DataFrame:
    stack = ", ".join(f"'{n}', CAST(`{n}` AS DOUBLE)" for n in names)
    return df.select(*g, F.expr(f"stack({len(names)}, {stack}) AS (metric, value)"))
