"""Evaluation metrics (Q rows)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.catalog import register
from quarry.catalog.fixtures import finish, fx, r, with_fx
from quarry.operators import metrics as M

EPS = "2.220446049250313e-16"

# ---------------------------------------------------------------- regression, grouped by grp

_REG = with_fx("fx_reg") + """, m AS (SELECT grp, AVG(y_true) AS ybar, AVG(y_true - y_pred) AS dbar FROM fx_reg GROUP BY grp)
"""


def _reg_query(metric: str):
    def q(spark, sf):
        return finish(M.regression_report(fx(spark, sf, "fx_reg"), "y_true", "y_pred", "grp")
                      .select("grp", F.col(metric).alias("value")))
    return q


_REG_SQL = {
    "max_error": "MAX(ABS(y_true - y_pred))",
    "mean_absolute_error": "AVG(ABS(y_true - y_pred))",
    "mean_squared_error": "AVG((y_true - y_pred) * (y_true - y_pred))",
    "median_absolute_error": "MEDIAN(ABS(y_true - y_pred))",
    "root_mean_squared_error": "SQRT(AVG((y_true - y_pred) * (y_true - y_pred)))",
    "normalized_root_mean_squared_error":
        "CASE WHEN ABS(AVG(y_true)) < 1e-12 THEN 'inf'::DOUBLE ELSE SQRT(AVG((y_true - y_pred) * (y_true - y_pred))) / AVG(y_true) END",
    "mean_squared_log_error":
        "CASE WHEN MIN(y_true) >= 0 AND MIN(y_pred) >= 0 THEN AVG(POWER(LN(1 + y_true) - LN(1 + y_pred), 2)) END",
    "root_mean_squared_log_error":
        "CASE WHEN MIN(y_true) >= 0 AND MIN(y_pred) >= 0 THEN SQRT(AVG(POWER(LN(1 + y_true) - LN(1 + y_pred), 2))) END",
    "mean_absolute_percentage_error": f"AVG(ABS(y_true - y_pred) / GREATEST({EPS}, ABS(y_true))) * 100",
    "r2": "CASE WHEN SUM((y_true - m.ybar) * (y_true - m.ybar)) = 0 THEN '-inf'::DOUBLE ELSE "
          "1 - SUM((y_true - y_pred) * (y_true - y_pred)) / SUM((y_true - m.ybar) * (y_true - m.ybar)) END",
    "explained_variance": "CASE WHEN SUM((y_true - m.ybar) * (y_true - m.ybar)) = 0 THEN '-inf'::DOUBLE ELSE "
                          "1 - SUM(POWER(y_true - y_pred - m.dbar, 2)) / SUM((y_true - m.ybar) * (y_true - m.ybar)) END",
}

for _name, _expr in _REG_SQL.items():
    register(_name, _REG + f"SELECT grp, {r(_expr, 'value')} FROM fx_reg JOIN m USING (grp) GROUP BY grp")(
        _reg_query(_name))


@register("regression_report", _REG + "SELECT grp, COUNT(*) AS n, " + ", ".join(
    r(e, n) for n, e in _REG_SQL.items()) + " FROM fx_reg JOIN m USING (grp) GROUP BY grp")
def q_regression_report(spark, sf):
    return finish(M.regression_report(fx(spark, sf, "fx_reg"), "y_true", "y_pred", "grp"))


@register("target_diagnostics", with_fx("fx_reg") + "SELECT grp, 'y_true' AS column, " +
          ", ".join([r("MIN(y_true)", "min"), r("MAX(y_true)", "max"), r("AVG(y_true)", "mean"),
                     r("STDDEV_POP(y_true)", "std")]) + " FROM fx_reg GROUP BY grp UNION ALL SELECT grp, 'y_pred', " +
          ", ".join([r("MIN(y_pred)", "min"), r("MAX(y_pred)", "max"), r("AVG(y_pred)", "mean"),
                     r("STDDEV_POP(y_pred)", "std")]) + " FROM fx_reg GROUP BY grp")
def q_target_diagnostics(spark, sf):
    return finish(M.target_diagnostics(fx(spark, sf, "fx_reg"), ["y_true", "y_pred"], "grp"))


# ---------------------------------------------------------------- classification

_CONF_SQL = """, cls AS (SELECT DISTINCT {g}y_true AS class FROM {t}),
c AS (SELECT {gc}cls.class,
        SUM(CASE WHEN t.y_true = cls.class AND t.y_pred = cls.class THEN 1 ELSE 0 END) AS tp,
        SUM(CASE WHEN t.y_true <> cls.class AND t.y_pred = cls.class THEN 1 ELSE 0 END) AS fp,
        SUM(CASE WHEN t.y_true = cls.class AND t.y_pred <> cls.class THEN 1 ELSE 0 END) AS fn,
        SUM(CASE WHEN t.y_true = cls.class THEN 1 ELSE 0 END) AS support
      FROM {t} t JOIN cls ON {on} GROUP BY {gc}cls.class)
"""


def _conf(t: str, grouped: bool) -> str:
    if grouped:
        return _CONF_SQL.format(g="grp, ", gc="cls.grp, ", t=t, on="t.grp = cls.grp")
    return _CONF_SQL.format(g="", gc="", t=t, on="TRUE")


@register("confusion_counts", with_fx("fx_multi") + _conf("fx_multi", False) +
          "SELECT class::BIGINT AS class, tp::BIGINT AS tp, fp::BIGINT AS fp, fn::BIGINT AS fn, "
          "support::BIGINT AS support FROM c")
def q_confusion(spark, sf):
    return M.confusion_counts(fx(spark, sf, "fx_multi"), "y_true", "y_pred")


@register("accuracy", with_fx("fx_cls") + "SELECT grp, " +
          r("AVG(CASE WHEN y_true = y_pred THEN 1.0 ELSE 0.0 END)", "value") + " FROM fx_cls GROUP BY grp")
def q_accuracy(spark, sf):
    return finish(M.accuracy_score(fx(spark, sf, "fx_cls"), "y_true", "y_pred", "grp"))


def _div(a, b):
    return f"CASE WHEN ({b}) > 0 THEN CAST({a} AS DOUBLE) / ({b}) ELSE 0.0 END"


def _fb(p, rc, beta):
    b2 = beta * beta
    return f"CASE WHEN ({p}) + ({rc}) > 0 THEN {1 + b2} * ({p}) * ({rc}) / ({b2} * ({p}) + ({rc})) ELSE 0.0 END"


_P, _R = _div("tp", "tp + fp"), _div("tp", "tp + fn")

register("binary_precision_recall_f", with_fx("fx_cls") + _conf("fx_cls", True) + f"""
SELECT grp, {r(_P, 'precision')}, {r(_R, 'recall')}, {r(_fb(_P, _R, 1.0), 'f1')}, {r(_fb(_P, _R, 2.0), 'fbeta')}
FROM c WHERE class = 1""")(
    lambda spark, sf: finish(M.classification_report(fx(spark, sf, "fx_cls"), "y_true", "y_pred", "grp",
                                                     "binary", 2.0).drop("accuracy", "n")))

register("multiclass_macro", with_fx("fx_multi") + _conf("fx_multi", False) + f"""
SELECT {r(f'AVG({_P})', 'precision')}, {r(f'AVG({_R})', 'recall')}, {r(f'AVG({_fb(_P, _R, 1.0)})', 'f1')},
       {r(f'AVG({_fb(_P, _R, 2.0)})', 'fbeta')} FROM c""")(
    lambda spark, sf: finish(M.classification_report(fx(spark, sf, "fx_multi"), "y_true", "y_pred", None,
                                                     "macro", 2.0).drop("accuracy", "n")))

register("multiclass_weighted", with_fx("fx_multi") + _conf("fx_multi", False) + f"""
SELECT {r(f'SUM(support * {_P}) / SUM(support)', 'precision')}, {r(f'SUM(support * {_R}) / SUM(support)', 'recall')},
       {r(f'SUM(support * {_fb(_P, _R, 1.0)}) / SUM(support)', 'f1')},
       {r(f'SUM(support * {_fb(_P, _R, 2.0)}) / SUM(support)', 'fbeta')} FROM c""")(
    lambda spark, sf: finish(M.classification_report(fx(spark, sf, "fx_multi"), "y_true", "y_pred", None,
                                                     "weighted", 2.0).drop("accuracy", "n")))

register("multiclass_micro", with_fx("fx_multi") + _conf("fx_multi", False) + f"""
SELECT {r(_div('SUM(tp)', 'SUM(tp) + SUM(fp)'), 'precision')}, {r(_div('SUM(tp)', 'SUM(tp) + SUM(fn)'), 'recall')},
       {r(_div('2 * SUM(tp)', '2 * SUM(tp) + SUM(fp) + SUM(fn)'), 'f1')},
       {r(_div('5 * SUM(tp)', '5 * SUM(tp) + 4 * SUM(fn) + SUM(fp)'), 'fbeta')},
       {r('(SELECT AVG(CASE WHEN y_true = y_pred THEN 1.0 ELSE 0.0 END) FROM fx_multi)', 'accuracy')},
       (SELECT COUNT(*) FROM fx_multi) AS n FROM c""")(
    lambda spark, sf: finish(M.classification_report(fx(spark, sf, "fx_multi"), "y_true", "y_pred", None,
                                                     "micro", 2.0)))

register("log_loss_binary", with_fx("fx_cls") + "SELECT grp, " + r(
    "-AVG(y_true * LN(LEAST(GREATEST(y_score, 1e-15), 1 - 1e-15)) + "
    "(1 - y_true) * LN(1 - LEAST(GREATEST(y_score, 1e-15), 1 - 1e-15)))", "value") + " FROM fx_cls GROUP BY grp")(
    lambda spark, sf: finish(M.log_loss(fx(spark, sf, "fx_cls"), "y_true", "y_score", "grp")))

register("log_loss_multiclass", with_fx("fx_multi") + "SELECT " + r(
    "-AVG(LN(LEAST(GREATEST(CASE y_true WHEN 0 THEN p0 WHEN 1 THEN p1 ELSE p2 END, 1e-15), 1 - 1e-15)))", "value")
    + " FROM fx_multi")(
    lambda spark, sf: finish(M.log_loss(fx(spark, sf, "fx_multi").withColumn("p", F.array("p0", "p1", "p2")),
                                        "y_true", "p")))

# AUC oracle: Mann-Whitney rank formula (half credit for ties), independent of the trapezoid
_AUC = """, s AS (SELECT {g}{score} AS sc, SUM(CASE WHEN {y} = 1 THEN 1 ELSE 0 END) AS pos,
                SUM(CASE WHEN {y} <> 1 THEN 1 ELSE 0 END) AS neg FROM {t} GROUP BY {g}{score}),
rk AS (SELECT {g}sc, pos, neg, COALESCE(SUM(neg) OVER (PARTITION BY {pg} ORDER BY sc
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM s),
tt AS (SELECT {g}SUM(pos) AS P, SUM(neg) AS N FROM s GROUP BY {pg})
"""


def _auc_sql(t, y, score, grouped):
    g = "grp, " if grouped else ""
    pg = "grp" if grouped else "1"
    return _AUC.format(g=g, pg=pg, t=t, y=y, score=score)


register("roc_auc", with_fx("fx_cls") + _auc_sql("fx_cls", "y_true", "y_score", True) + """
SELECT grp, """ + r("CASE WHEN MAX(P) > 0 AND MAX(N) > 0 THEN SUM(pos * (below + 0.5 * neg)) / (MAX(P) * MAX(N)) ELSE 0 END",
                    "value") + " FROM rk JOIN tt USING (grp) GROUP BY grp")(
    lambda spark, sf: finish(M.roc_auc_score(fx(spark, sf, "fx_cls"), "y_true", "y_score", "grp")))

register("roc_curve", with_fx("fx_cls") + """, s AS (SELECT grp, y_score, SUM(y_true) AS pos, SUM(1 - y_true) AS neg
  FROM fx_cls GROUP BY grp, y_score)
SELECT grp, """ + r("y_score", "threshold") + ", " +
         r("SUM(neg) OVER (PARTITION BY grp ORDER BY y_score DESC) / SUM(neg) OVER (PARTITION BY grp)", "fpr") + ", " +
         r("SUM(pos) OVER (PARTITION BY grp ORDER BY y_score DESC) / SUM(pos) OVER (PARTITION BY grp)", "tpr") +
         " FROM s")(
    lambda spark, sf: finish(M.roc_curve(fx(spark, sf, "fx_cls"), "y_true", "y_score", "grp")))

register("average_precision", with_fx("fx_cls") + """, s AS (SELECT grp, y_score, SUM(y_true) AS pos, COUNT(*) AS cnt
  FROM fx_cls GROUP BY grp, y_score),
c AS (SELECT grp, pos, SUM(pos) OVER (PARTITION BY grp ORDER BY y_score DESC) AS cp,
             SUM(cnt) OVER (PARTITION BY grp ORDER BY y_score DESC) AS cc,
             SUM(pos) OVER (PARTITION BY grp) AS P FROM s)
SELECT grp, """ + r("CASE WHEN MAX(P) > 0 THEN SUM(pos / P * cp / cc) ELSE 0 END", "value") + " FROM c GROUP BY grp")(
    lambda spark, sf: finish(M.average_precision_score(fx(spark, sf, "fx_cls"), "y_true", "y_score", "grp")))

register("roc_auc_ovr", with_fx("fx_multi") + """, ex AS (
  SELECT 0 AS c, CASE WHEN y_true = 0 THEN 1 ELSE 0 END AS yb, p0 AS p FROM fx_multi UNION ALL
  SELECT 1, CASE WHEN y_true = 1 THEN 1 ELSE 0 END, p1 FROM fx_multi UNION ALL
  SELECT 2, CASE WHEN y_true = 2 THEN 1 ELSE 0 END, p2 FROM fx_multi),
s AS (SELECT c, p, SUM(yb) AS pos, SUM(1 - yb) AS neg FROM ex GROUP BY c, p),
rk AS (SELECT c, pos, neg, COALESCE(SUM(neg) OVER (PARTITION BY c ORDER BY p
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below,
        SUM(pos) OVER (PARTITION BY c) AS P, SUM(neg) OVER (PARTITION BY c) AS N FROM s),
a AS (SELECT c, SUM(pos * (below + 0.5 * neg)) / (MAX(P) * MAX(N)) AS auc FROM rk GROUP BY c)
SELECT """ + r("AVG(auc)", "value") + " FROM a")(
    lambda spark, sf: finish(M.roc_auc_ovr(fx(spark, sf, "fx_multi").withColumn("p", F.array("p0", "p1", "p2")),
                                           "y_true", "p")))


@register("scorer_binary", with_fx("fx_cls") + _conf("fx_cls", True) + _auc_sql("fx_cls", "y_true", "y_score", True) + f"""
, acc AS (SELECT grp, AVG(CASE WHEN y_true = y_pred THEN 1.0 ELSE 0.0 END) AS accuracy,
            -AVG(y_true * LN(LEAST(GREATEST(y_score, 1e-15), 1 - 1e-15)) + (1 - y_true) * LN(1 - LEAST(GREATEST(y_score, 1e-15), 1 - 1e-15))) AS log_loss
          FROM fx_cls GROUP BY grp),
auc AS (SELECT grp, SUM(pos * (below + 0.5 * neg)) / (MAX(P) * MAX(N)) AS roc_auc FROM rk JOIN tt USING (grp) GROUP BY grp),
ap0 AS (SELECT grp, sc, pos, SUM(pos) OVER (PARTITION BY grp ORDER BY sc DESC) AS cp,
             SUM(pos + neg) OVER (PARTITION BY grp ORDER BY sc DESC) AS cc, SUM(pos) OVER (PARTITION BY grp) AS PP FROM s),
ap AS (SELECT grp, SUM(pos / PP * cp / cc) AS average_precision FROM ap0 GROUP BY grp),
pr AS (SELECT grp, {_P} AS precision, {_R} AS recall, {_fb(_P, _R, 1.0)} AS f1, {_fb(_P, _R, 2.0)} AS fbeta FROM c WHERE class = 1),
w AS (SELECT * FROM acc JOIN pr USING (grp) JOIN auc USING (grp) JOIN ap USING (grp))
SELECT grp, metric, ROUND(value, 6) + 0.0 AS value FROM w
UNPIVOT (value FOR metric IN (accuracy, precision, recall, f1, fbeta, log_loss, roc_auc, average_precision))""")
def q_scorer_binary(spark, sf):
    return finish(M.score_table(fx(spark, sf, "fx_cls"), "classification", "y_true", "y_pred", "y_score", "grp"))


@register("scorer_regression", _REG + "SELECT grp, metric, ROUND(value, 6) + 0.0 AS value FROM (SELECT grp, " + ", ".join(
    f"CAST({e} AS DOUBLE) AS {n}" for n, e in _REG_SQL.items()) + " FROM fx_reg JOIN m USING (grp) GROUP BY grp) w "
    "UNPIVOT INCLUDE NULLS (value FOR metric IN (" + ", ".join(_REG_SQL) + "))")
def q_scorer_regression(spark, sf):
    return finish(M.score_table(fx(spark, sf, "fx_reg"), "regression", "y_true", "y_pred", group_by="grp"))


# ---------------------------------------------------------------- labels of any number, classes without rows

_FRACTIONS = """SELECT o_orderkey AS id, CAST(o_custkey % 4 AS DOUBLE) / 4 + 1 AS t, CAST(o_orderkey % 5 AS DOUBLE) / 4 + 1 AS p FROM orders"""


@register("confusion_fractional", f"""WITH x AS ({_FRACTIONS}),
t AS (SELECT t AS class, COUNT(*) AS support, SUM(CASE WHEN t = p THEN 1 ELSE 0 END) AS tp FROM x GROUP BY t),
q AS (SELECT p AS class, COUNT(*) AS n FROM x GROUP BY p)
SELECT {r('t.class', 'class')}, tp::BIGINT AS tp, (COALESCE(n, 0) - tp)::BIGINT AS fp, (support - tp)::BIGINT AS fn, support::BIGINT AS support
FROM t LEFT JOIN q USING (class)""")
def q_confusion_fractional(spark, sf):
    fx(spark, sf, "orders")  # registers the views
    return finish(M.confusion_counts(spark.sql(_FRACTIONS), "t", "p"))


_ABSENT = "SELECT y_true, p0, p1, p2 FROM fx_multi WHERE y_true <> 1"


@register("log_loss_absent_class", with_fx("fx_multi") + f""", x AS ({_ABSENT})
SELECT {r('-AVG(LN(LEAST(GREATEST(CASE y_true WHEN 0 THEN p0 ELSE p2 END, 1e-15), 1 - 1e-15)))', 'value')} FROM x""")
def q_log_loss_absent(spark, sf):
    """Q18 where a class of the model has no row."""
    fx(spark, sf, "fx_multi")
    d = spark.sql(_ABSENT).select("y_true", F.array("p0", "p1", "p2").alias("p"))
    return finish(M.log_loss(d, "y_true", "p", classes=[0, 1, 2]))
