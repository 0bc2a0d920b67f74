"""Forest, SVR, explanation and search (T, R, X, M6-M8, Y rows)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.catalog import register
from quarry.catalog.fixtures import finish, fx, r, with_fx
from quarry.functions.hashing import md5_sql
from quarry.operators import forest, scoring
from quarry.operators.splits import train_test

KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
FEATS = ["qty", "price", "disc", "tax"]


def _num(spark, sf):
    return fx(spark, sf, "fx_num")


# ---------------------------------------------------------------- T1, T2, T4, T5

def _gini(a, b):
    return f"CASE WHEN ({a}) + ({b}) > 0 THEN 1 - POWER(({a}) / (({a}) + ({b})), 2) - POWER(({b}) / (({a}) + ({b})), 2) ELSE 0 END"


def _ent(a, b):
    def t(p):
        return f"CASE WHEN {p} > 0 THEN -{p} * LOG2({p}) ELSE 0 END"
    n = f"(({a}) + ({b}))"
    return f"CASE WHEN {n} > 0 THEN {t(f'(({a}) / {n})')} + {t(f'(({b}) / {n})')} ELSE 0 END"


@register("impurity", with_fx("fx_num") + f"""SELECT flag3, SUM(1 - y_cls)::BIGINT AS c0, SUM(y_cls)::BIGINT AS c1,
  {r(_gini('SUM(1 - y_cls)::DOUBLE', 'SUM(y_cls)::DOUBLE'), 'gini')},
  {r(_ent('SUM(1 - y_cls)::DOUBLE', 'SUM(y_cls)::DOUBLE'), 'entropy')},
  {r("CASE WHEN COUNT(*) > 0 THEN 1 - POWER(SUM(1 - y_cls) / COUNT(*), 2) - POWER(SUM(y_cls) / COUNT(*), 2) END", 'gini_array')}
FROM fx_num GROUP BY flag3""")
def q_impurity(spark, sf):
    c = _num(spark, sf).groupBy("flag3").agg(F.sum(1 - F.col("y_cls")).cast("long").alias("c0"),
                                             F.sum("y_cls").cast("long").alias("c1"))
    return finish(c.select("flag3", "c0", "c1",
                           forest.impurity_expr(F.col("c0").cast("double"), F.col("c1").cast("double"), "gini").alias("gini"),
                           forest.impurity_expr(F.col("c0").cast("double"), F.col("c1").cast("double"), "entropy").alias("entropy"),
                           forest.impurity_counts(F.array(F.col("c0").cast("double"), F.col("c1").cast("double")), "gini")
                           .alias("gini_array")))


def _poisson_sql(u: str) -> str:
    edges = forest._poisson_edges()
    return "CASE " + " ".join(f"WHEN {u} < {e!r} THEN {k}" for k, e in enumerate(edges)) + f" ELSE {len(edges)} END"


_BOOT = f"""SELECT c_custkey, t.tree_id::INTEGER AS tree_id,
  ({_poisson_sql(md5_sql(['c_custkey', 'tree_id'], 7) + ' / 4294967296.0')})::INTEGER AS weight
FROM customer, (SELECT UNNEST(RANGE(0, 3)) AS tree_id) t"""


@register("bootstrap", _BOOT)
def q_bootstrap(spark, sf):
    return forest.bootstrap(fx(spark, sf, "customer").select("c_custkey"), "c_custkey", 3, 7, hash_method="md5")


@register("out_of_bag", f"SELECT c_custkey, tree_id FROM ({_BOOT}) WHERE weight = 0")
def q_oob(spark, sf):
    return forest.oob(fx(spark, sf, "customer").select("c_custkey"), "c_custkey", 3, 7, hash_method="md5")


_SPLIT_FEATS = ["qty", "disc", "tax"]
_CAND = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {i} AS ford, {c} AS val, SUM(1 - y_cls)::DOUBLE AS c0, SUM(y_cls)::DOUBLE AS c1 "
    f"FROM fx_num GROUP BY {c}" for i, c in enumerate(_SPLIT_FEATS))


@register("best_split", with_fx("fx_num") + f""", cand AS ({_CAND}),
cum AS (SELECT feature, ford, val, LEAD(val) OVER (PARTITION BY feature ORDER BY val) AS nxt,
  SUM(c0) OVER (PARTITION BY feature ORDER BY val) AS l0, SUM(c1) OVER (PARTITION BY feature ORDER BY val) AS l1,
  SUM(c0) OVER (PARTITION BY feature) AS t0, SUM(c1) OVER (PARTITION BY feature) AS t1 FROM cand),
sc AS (SELECT feature, ford, (val + nxt) / 2 AS threshold, l0 + l1 AS nl, t0 - l0 + t1 - l1 AS nr,
  ((l0 + l1) * ({_gini('l0', 'l1')}) + (t0 - l0 + t1 - l1) * ({_gini('t0 - l0', 't1 - l1')})) / (t0 + t1) AS cost,
  {_gini('t0', 't1')} AS parent FROM cum WHERE nxt IS NOT NULL)
SELECT feature, {r('threshold', 'threshold')}, nl AS n_left, nr AS n_right, {r('parent - cost', 'gain')}
FROM sc WHERE nl >= 2 AND nr >= 2 AND parent - cost > 1e-12 ORDER BY cost, ford, threshold LIMIT 1""")
def q_best_split(spark, sf):
    m = forest.fit_forest(_num(spark, sf), _SPLIT_FEATS, "y_cls", KEY, n_trees=1, max_depth=1, min_samples_split=2,
                          min_samples_leaf=2, impurity="gini", max_features="all", max_bins=64, bootstrap_rows=False)
    nodes = m.node_table(spark)
    root = nodes.filter("node_id = 0").alias("p")
    kids = nodes.filter("node_id > 0")
    lj = root.join(kids.alias("l"), F.col("p.left") == F.col("l.node_id"))
    j = lj.join(kids.alias("q"), F.col("p.right") == F.col("q.node_id"))
    return finish(j.select(F.col("p.feature").alias("feature"), F.col("p.threshold").alias("threshold"),
                           F.col("l.n").alias("n_left"), F.col("q.n").alias("n_right"),
                           (F.col("p.impurity") - (F.col("l.n") * F.col("l.impurity") + F.col("q.n") * F.col("q.impurity"))
                            / F.col("p.n")).alias("gain")))


# ---------------------------------------------------------------- T6-T14, F13

def _fit_small(spark, sf, **kw):
    d = train_test(_num(spark, sf), KEY, 0.2, 42)
    params = dict(n_trees=20, max_depth=8, min_samples_split=5, min_samples_leaf=2, impurity="entropy")
    params.update(kw)
    m = forest.fit_forest(d.filter(~F.col("is_test")), FEATS, "y_cls", KEY, **params)
    return d, m


@register("forest_nodes")
def q_forest_nodes(spark, sf):
    _, m = _fit_small(spark, sf)
    return finish(m.node_table(spark))


@register("forest_predict_soft")
def q_forest_soft(spark, sf):
    d, m = _fit_small(spark, sf)
    p = forest.predict_forest(d.filter(F.col("is_test")).select(*KEY, *FEATS, "y_cls"), m, "soft", 0.6)
    return finish(p.withColumn("p1", F.element_at("probability", 2)).drop("probability"))


@register("forest_predict_hard")
def q_forest_hard(spark, sf):
    d, m = _fit_small(spark, sf)
    p = forest.predict_forest(d.filter(F.col("is_test")).select(*KEY, *FEATS, "y_cls"), m, "hard")
    return finish(p.drop("probability"))


@register("forest_importances")
def q_forest_importances(spark, sf):
    _, m = _fit_small(spark, sf)
    return finish(forest.importances(spark, m))


@register("select_from_model")
def q_select_from_model(spark, sf):
    _, m = _fit_small(spark, sf)
    return finish(scoring.select_from_model(forest.importances(spark, m)))


@register("forest_library_baseline")
def q_forest_ml(spark, sf):
    d = train_test(_num(spark, sf), KEY, 0.2, 42)
    model = forest.fit_forest_ml(d.filter(~F.col("is_test")), FEATS, "y_cls", n_trees=20, max_depth=8)
    p = model.transform(d.filter(F.col("is_test")))
    return p.select(*KEY, "y_cls", F.col("prediction").cast("int").alias("prediction"))


@register("forest_documents")
def q_forest_docs(spark, sf):
    """Forest on real labels: document quality from length features."""
    df = fx(spark, sf, "fx_doc")
    m = forest.fit_forest(df, ["n_chars", "n_spaces"], "quality", "doc_id", n_trees=20, max_depth=6)
    return finish(forest.predict_forest(df, m).drop("probability"))


# ---------------------------------------------------------------- R rows

from quarry.operators import svr  # noqa: E402

_SVR_COLS = ["qty", "disc", "tax"]


@register("svr_gamma_scale", with_fx("fx_num") + f"""SELECT {r(
    "CASE WHEN (SUM(qty*qty + disc*disc + tax*tax) / (3.0 * COUNT(*)) - POWER(SUM(qty + disc + tax) / (3.0 * COUNT(*)), 2)) < 1e-12 "
    "THEN 1.0 ELSE 1.0 / (3 * (SUM(qty*qty + disc*disc + tax*tax) / (3.0 * COUNT(*)) - "
    "POWER(SUM(qty + disc + tax) / (3.0 * COUNT(*)), 2))) END", 'gamma', 9)}, {r('1.0 / 3', 'gamma_auto', 9)} FROM fx_num""")
def q_gamma(spark, sf):
    df = _num(spark, sf)
    return finish(spark.createDataFrame([(svr.resolve_gamma(df, _SVR_COLS, "scale"),
                                          svr.resolve_gamma(df, _SVR_COLS, "auto"))], "gamma double, gamma_auto double"), 9)


@register("svr_epsilon_auto", with_fx("fx_num") + f"SELECT {r('GREATEST(0.1 * STDDEV_POP(y_reg), 1e-12)', 'epsilon')} FROM fx_num")
def q_eps(spark, sf):
    return finish(spark.createDataFrame([(svr.resolve_epsilon(_num(spark, sf), "y_reg", "auto"),)], "epsilon double"))


@register("epsilon_insensitive_loss", with_fx("fx_reg") + f"""SELECT grp,
  {r('SUM(GREATEST(ABS(y_true - y_pred) - 5000.0, 0))', 'loss', 4)}, {r('AVG(GREATEST(ABS(y_true - y_pred) - 5000.0, 0))', 'mean_loss')},
  SUM(CASE WHEN ABS(y_true - y_pred) - 5000.0 > 0 THEN 1 ELSE 0 END)::BIGINT AS n_outside FROM fx_reg GROUP BY grp""")
def q_loss(spark, sf):
    l = svr.epsilon_insensitive_loss(fx(spark, sf, "fx_reg"), "y_true", "y_pred", 5000.0, "grp")
    return finish(finish(l.select("grp", "loss", "n_outside"), 4).join(finish(l.select("grp", "mean_loss")), "grp"))


@register("support_rows", with_fx("fx_reg") + "SELECT id, grp FROM fx_reg WHERE ABS(y_true - y_pred) >= 5000.0 - 0.001")
def q_support(spark, sf):
    return svr.support_rows(fx(spark, sf, "fx_reg"), "y_true", "y_pred", 5000.0).select("id", "grp")


_LM = f"""lm AS (SELECT qty AS lq, disc AS ld, tax AS lt, ROW_NUMBER() OVER (ORDER BY {md5_sql(KEY, 5)}, {', '.join(KEY)}) - 1 AS landmark
  FROM fx_num ORDER BY {md5_sql(KEY, 5)}, {', '.join(KEY)} LIMIT 3)"""


@register("kernel_features", with_fx("fx_num") + f", {_LM}\nSELECT {', '.join(KEY)}, landmark::INTEGER AS landmark, " +
          r("EXP(-0.01 * GREATEST(POWER(qty - lq, 2) + POWER(disc - ld, 2) + POWER(tax - lt, 2), 0))", "k") +
          " FROM fx_num, lm")
def q_kernel_features(spark, sf):
    df = _num(spark, sf).select(*KEY, *_SVR_COLS)
    L = svr.hash_landmarks(df, _SVR_COLS, 3, KEY, 5, hash_method="md5")
    k = svr.kernel_features(df, _SVR_COLS, L, "rbf", 0.01)
    return finish(k.select(*KEY, F.posexplode("k").alias("landmark", "k")))


def _svr_fit(spark, sf, kernel="rbf"):
    d = train_test(_num(spark, sf), KEY, 0.2, 42)
    m = svr.fit_svr(d.filter(~F.col("is_test")), _SVR_COLS, "y_reg", kernel=kernel, C=1.0, epsilon="auto",
                    gamma="scale", n_landmarks=100, key=KEY)
    return d, m


@register("svr_fit_predict")
def q_svr(spark, sf):
    d, m = _svr_fit(spark, sf)
    return finish(svr.predict_svr(d.filter(F.col("is_test")).select(*KEY, *_SVR_COLS, "y_reg"), m))


@register("svr_objective_trace")
def q_svr_obj(spark, sf):
    _, m = _svr_fit(spark, sf)
    return spark.createDataFrame([(i, float(v)) for i, v in enumerate(m.objective)], "iteration int, objective double")


@register("svr_kernel_stats")
def q_kstats(spark, sf):
    _, m = _svr_fit(spark, sf)
    return finish(svr.kernel_stats(_num(spark, sf), m))


_LM20 = _LM.replace("LIMIT 3)", "LIMIT 20)")


@register("kernel_stats_rbf", with_fx("fx_num") + f""", {_LM20},
k AS (SELECT EXP(-0.01 * GREATEST(POWER(qty - lq, 2) + POWER(disc - ld, 2) + POWER(tax - lt, 2), 0)) AS k FROM fx_num, lm)
SELECT {', '.join([r('MIN(k)', 'min'), r('MAX(k)', 'max'), r('AVG(k)', 'mean'), r('STDDEV_POP(k)', 'std'), r('VAR_POP(k)', 'var'),
                   r('QUANTILE_CONT(k, 0.5)', 'median')])} FROM k""")
def q_kstats_rbf(spark, sf):
    """R8 with fixed landmarks and width, which SQL can follow."""
    df = _num(spark, sf).select(*KEY, *_SVR_COLS)
    marks = svr.hash_landmarks(df, _SVR_COLS, 20, KEY, 5, hash_method="md5")
    m = svr.SVRModel(_SVR_COLS, "rbf", 0.01, 0.0, 3, 1.0, 0.1, marks, None, None, 0.0, [])
    return finish(svr.kernel_stats(df, m))


@register("stratified_top_errors", with_fx("fx_reg") + f""", mm AS (SELECT MIN(y_pred) AS a, MAX(y_pred) AS b FROM fx_reg),
x AS (SELECT id, grp, y_pred, y_true - y_pred AS excess,
             LEAST(FLOOR((y_pred - a) / (((b + 1e-9) - a) / 6)), 5)::INTEGER AS bin FROM fx_reg, mm)
SELECT id, grp, {r('y_pred', 'y_pred', 4)}, {r('excess', 'excess', 4)}, bin FROM x
QUALIFY ROW_NUMBER() OVER (PARTITION BY bin ORDER BY ABS(excess) DESC, id) <= 10""")
def q_strat_fixed(spark, sf):
    """R11 over given predictions."""
    d = fx(spark, sf, "fx_reg").select("id", "grp", "y_pred", (F.col("y_true") - F.col("y_pred")).alias("excess"))
    return finish(svr.stratified_top(d, "y_pred", "excess", 6, 10, ["id"]), 4)


@register("svr_prediction_grid")
def q_grid(spark, sf):
    d, m = _svr_fit(spark, sf)
    return finish(svr.prediction_grid(d, m, "qty", "disc", 20))


@register("svr_contour_levels")
def q_contours(spark, sf):
    """The levels of the prediction surface and the grid cells that each crosses."""
    d, m = _svr_fit(spark, sf)
    return finish(svr.contour_levels(svr.prediction_grid(d, m, "qty", "disc", 20), 8))


@register("svr_fit_auto")
def q_svr_auto(spark, sf):
    """R4 with the default kernel: predictions for every row, null where a feature is missing."""
    d = _num(spark, sf).select(*KEY, *[F.when(F.col("l_orderkey") % 97 != 0, F.col(c)).alias(c) for c in _SVR_COLS], "y_reg")
    m = svr.fit_svr(d, _SVR_COLS, "y_reg")
    return finish(svr.predict_svr(d.select(*KEY, *_SVR_COLS), m), 4)


@register("svr_stratified_support")
def q_strat(spark, sf):
    d, m = _svr_fit(spark, sf)
    p = svr.predict_svr(d.select(*KEY, *_SVR_COLS, "y_reg"), m)
    p = p.withColumn("excess", F.abs(F.col("y_reg") - F.col("prediction")) - F.lit(m.epsilon))
    return finish(svr.stratified_top(svr.support_rows(p, "y_reg", "prediction", m.epsilon), "prediction", "excess", 5, 10, KEY))


@register("svr_compare_grids")
def q_cmp(spark, sf):
    d, m1 = _svr_fit(spark, sf, "rbf")
    _, m2 = _svr_fit(spark, sf, "linear")
    return finish(svr.compare_grids(d, {"rbf": m1, "linear": m2}, "qty", "disc", 10))


@register("svr_library_baseline")
def q_svr_ml(spark, sf):
    d = train_test(_num(spark, sf), KEY, 0.2, 42)
    model = svr.fit_baseline_regressor(d.filter(~F.col("is_test")), _SVR_COLS, "y_reg", "huber")
    return finish(model.transform(d.filter(F.col("is_test"))).select(*KEY, "y_reg", "prediction"))


# ---------------------------------------------------------------- X rows

from quarry.operators import explain  # noqa: E402

_W = {"qty": 0.8123457, "price": 0.0001234567, "disc": 201.2345678, "tax": -49.87654321}
_B0 = 1.2345
_BGSQL = f"bg AS (SELECT qty, price, disc, tax FROM fx_num ORDER BY {md5_sql(KEY, 3)}, {', '.join(KEY)} LIMIT 50), " \
         "mb AS (SELECT AVG(qty) AS m_qty, AVG(price) AS m_price, AVG(disc) AS m_disc, AVG(tax) AS m_tax FROM bg)"
_BASE = " + ".join(f"{w} * m_{c}" for c, w in _W.items()) + f" + {_B0}"
_PRED = " + ".join(f"{w} * {c}" for c, w in _W.items()) + f" + {_B0}"
_SHAP = with_fx("fx_num") + ", " + _BGSQL + ", sh AS (" + " UNION ALL ".join(
    f"SELECT {', '.join(KEY)}, '{c}' AS feature, {w} * ({c} - m_{c}) AS shap_value, {_BASE} AS base_value, "
    f"{_PRED} AS prediction, {c} AS value FROM fx_num, mb" for c, w in _W.items()) + ")\n"


def _linear_shap(spark, sf):
    df = _num(spark, sf).select(*KEY, *FEATS)
    bg = explain.background(df, FEATS, 50, KEY, 3, hash_method="md5")
    f = explain.LinearScorer([_W[c] for c in FEATS], _B0)
    return df, explain.shapley(df, f, FEATS, bg, KEY, n_permutations=2, seed=1)


@register("shapley_linear", _SHAP + f"SELECT {', '.join(KEY)}, feature, {r('value', 'value', 4)}, {r('shap_value', 'shap_value', 4)}, "
          f"{r('base_value', 'base_value', 4)}, {r('prediction', 'prediction', 4)} FROM sh")
def q_shap_lin(spark, sf):
    return finish(_linear_shap(spark, sf)[1], 4)


@register("shap_importance", _SHAP + f"SELECT feature, {r('AVG(ABS(shap_value))', 'mean_abs_shap', 4)} FROM sh GROUP BY feature")
def q_shap_imp(spark, sf):
    return finish(explain.shap_importance(_linear_shap(spark, sf)[1]), 4)


@register("shap_waterfall", _SHAP + f""", rk AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY {', '.join(KEY)}
  ORDER BY ABS(shap_value) DESC, feature) AS pos FROM sh)
SELECT {', '.join(KEY)}, feature, {r('shap_value', 'shap_value', 4)}, pos::INTEGER AS position FROM rk WHERE pos < 3
UNION ALL SELECT {', '.join(KEY)}, 'rest', {r('SUM(shap_value)', 'shap_value', 4)}, 3 FROM rk WHERE pos >= 3 GROUP BY {', '.join(KEY)}""")
def q_waterfall(spark, sf):
    return finish(explain.shap_waterfall(_linear_shap(spark, sf)[1], KEY, 3), 4)


@register("shap_decision", _SHAP + f"""SELECT {', '.join(KEY)}, feature, {r('shap_value', 'shap_value', 4)},
  {r(f"base_value + SUM(shap_value) OVER (PARTITION BY {', '.join(KEY)} ORDER BY ABS(shap_value), feature ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)", 'path_value', 4)}
FROM sh""")
def q_decision(spark, sf):
    return finish(explain.shap_decision(_linear_shap(spark, sf)[1], KEY), 4)


@register("shap_dependence", _SHAP + f""", top AS (SELECT feature FROM sh GROUP BY feature ORDER BY AVG(ABS(shap_value)) DESC, feature LIMIT 2)
SELECT {', '.join(KEY)}, feature, {r('value', 'value', 4)}, {r('shap_value', 'shap_value', 4)} FROM sh WHERE feature IN (SELECT feature FROM top)""")
def q_dependence(spark, sf):
    _, sh = _linear_shap(spark, sf)
    return finish(explain.shap_dependence(sh, KEY, 2), 4)


def _forest_shap(spark, sf):
    d, m = _fit_small(spark, sf, n_trees=10, max_depth=6)
    te = d.filter(F.col("is_test")).select(*KEY, *FEATS)
    bg = explain.background(d.filter(~F.col("is_test")), FEATS, 50, KEY, 3)
    return te, m, bg


@register("shapley_forest")
def q_shap_forest(spark, sf):
    te, m, bg = _forest_shap(spark, sf)
    return finish(explain.shapley(te, explain.ForestScorer(m), FEATS, bg, KEY, n_permutations=4, seed=2))


@register("shap_distribution", _SHAP + f""", mm AS (SELECT feature, MIN(value) AS lo, MAX(value) AS hi FROM sh GROUP BY feature),
b AS (SELECT sh.feature, shap_value, CASE WHEN hi = lo THEN 0 ELSE LEAST(FLOOR((value - lo) / ((hi - lo) / 10)), 9) END::INTEGER AS bin
      FROM sh JOIN mm ON sh.feature = mm.feature)
SELECT feature, bin, COUNT(*) AS n, {', '.join(r(f'QUANTILE_CONT(shap_value, {p / 100})', f'p{p}', 4) for p in (5, 25, 50, 75, 95))}
FROM b GROUP BY feature, bin""")
def q_shap_dist(spark, sf):
    _, sh = _linear_shap(spark, sf)
    return finish(explain.shap_distribution(sh, 10), 4)


@register("shap_interactions")
def q_shap_inter(spark, sf):
    te, m, bg = _forest_shap(spark, sf)
    return finish(explain.shap_interactions(te, explain.ForestScorer(m), FEATS, bg, n_permutations=2, seed=3))


# ---------------------------------------------------------------- M6-M8, Y, S11, S12

from quarry.operators import experiments, metrics as Mx, search, splits as Sp  # noqa: E402
from quarry.catalog.preparation import _scratch  # noqa: E402
from quarry.sources import readers as Rd  # noqa: E402
from quarry.catalog.evaluation import _REG, _REG_SQL  # noqa: E402

_CV_IN = """SELECT id, grp, y_true, y_pred, y_true * (0.95 + 0.001 * (id % 97)) AS y_alt FROM fx_reg"""
_FOLD = f"NTILE(5) OVER (ORDER BY {md5_sql('id', 11)}, id) - 1"


def _cv_table(spark, sf):
    fx(spark, sf, "fx_reg")  # registers the derived views
    df = Sp.kfold(spark.sql(_CV_IN), 5, "id", 11, hash_method="md5")
    parts = []
    for cid, col in ((0, "y_pred"), (1, "y_alt")):
        t = Mx.regression_report(df, "y_true", col, "fold").select(
            F.lit(cid).alias("candidate_id"), "fold",
            F.expr("stack(2, 'mean_absolute_error', mean_absolute_error, 'root_mean_squared_error', "
                   "root_mean_squared_error) AS (metric, value)"))
        parts.append(t)
    return parts[0].unionByName(parts[1])


_CV_SQL = with_fx("fx_reg") + f""", d AS (SELECT *, {_FOLD} AS fold FROM ({_CV_IN})),
f AS (SELECT 0 AS candidate_id, fold, AVG(ABS(y_true - y_pred)) AS mae, SQRT(AVG(POWER(y_true - y_pred, 2))) AS rmse FROM d GROUP BY fold
      UNION ALL SELECT 1, fold, AVG(ABS(y_true - y_alt)), SQRT(AVG(POWER(y_true - y_alt, 2))) FROM d GROUP BY fold),
cv AS (SELECT candidate_id, fold, 'mean_absolute_error' AS metric, mae AS value FROM f
       UNION ALL SELECT candidate_id, fold, 'root_mean_squared_error', rmse FROM f)
"""
_T4 = "2.7764451051977734"  # Student t 0.975 quantile, 4 degrees of freedom (5 folds)


@register("cv_results", _CV_SQL + "SELECT candidate_id, metric, COUNT(*) AS n, " + ", ".join([
    r("AVG(value)", "mean"), r("STDDEV_SAMP(value)", "std"), r("STDDEV_SAMP(value) / SQRT(COUNT(*))", "std_error"),
    r("QUANTILE_CONT(value, 0.5)", "median"), r("MIN(value)", "min"), r("MAX(value)", "max"),
    r("QUANTILE_CONT(value, 0.25)", "q1"), r("QUANTILE_CONT(value, 0.75)", "q3"),
    r("QUANTILE_CONT(value, 0.75) - QUANTILE_CONT(value, 0.25)", "iqr"),
    r("CASE WHEN ABS(AVG(value)) > 1e-10 THEN STDDEV_SAMP(value) / ABS(AVG(value)) * 100 ELSE 0 END", "coefficient_of_variation"),
    r(f"AVG(value) - {_T4} * STDDEV_SAMP(value) / SQRT(COUNT(*))", "lower"),
    r(f"AVG(value) + {_T4} * STDDEV_SAMP(value) / SQRT(COUNT(*))", "upper"),
    r(f"{_T4} * STDDEV_SAMP(value) / SQRT(COUNT(*))", "margin_of_error")]) + " FROM cv GROUP BY candidate_id, metric")
def q_cv_results(spark, sf):
    return finish(search.cv_results(_cv_table(spark, sf)))


@register("best_candidate", _CV_SQL + f"""SELECT candidate_id, {r('AVG(value)', 'mean')} FROM cv
WHERE metric = 'root_mean_squared_error' GROUP BY candidate_id ORDER BY AVG(value), candidate_id LIMIT 1""")
def q_best_candidate(spark, sf):
    t = _cv_table(spark, sf).withColumn("params", F.create_map(F.lit("candidate"), F.col("candidate_id").cast("string")))
    return finish(search.best_candidate(t, "root_mean_squared_error").select("candidate_id", "mean"))


def _doc_folds(spark, sf):
    return fx(spark, sf, "fx_doc").select("doc_id", "n_chars", "n_spaces", "quality")


@register("cross_validate_forest")
def q_cv_forest(spark, sf):
    d = Sp.stratified_kfold(_doc_folds(spark, sf), "quality", 5, "doc_id", 42)
    return finish(search.cross_validate(d, "fold", "random_forest", ["n_chars", "n_spaces"], "quality", "doc_id",
                                        dict(n_trees=10, max_depth=5), "classification", prep={"scaler": "robust"}))


@register("grid_search_forest")
def q_grid_forest(spark, sf):
    d = Sp.stratified_kfold(_doc_folds(spark, sf), "quality", 3, "doc_id", 42)
    cv, best, _ = search.grid_search(d, "fold", "random_forest", ["n_chars", "n_spaces"], "quality", "doc_id",
                                     {"n_trees": [5], "max_depth": [3, 5], "vote": ["soft", "hard"]},
                                     "classification", "f1", refit=False)
    return finish(search.cv_results(cv))


@register("grid_search_svr")
def q_grid_svr(spark, sf):
    d = Sp.kfold(_num(spark, sf).select(*KEY, *_SVR_COLS, "y_reg"), 3, KEY, 42)
    cv, best, _ = search.grid_search(d, "fold", "svr", _SVR_COLS, "y_reg", KEY,
                                     [{"kernel": ["linear"], "C": [1.0]}, {"kernel": ["rbf"], "C": [0.5, 2.0],
                                                                          "n_landmarks": [50]}],
                                     "regression", "root_mean_squared_error", parallelism=3, refit=False)
    return finish(cv)


def _experiment(spark, sf):
    d = Sp.train_test(_num(spark, sf), KEY, 0.2, 42)
    b, _ = experiments.run_experiment(d.filter(~F.col("is_test")), "random_forest", FEATS, "y_cls", KEY,
                                      dict(n_trees=10, max_depth=6), prep={"scaler": "robust"})
    return d.filter(F.col("is_test")), b


@register("experiment_one_hot")
def q_exp_one_hot(spark, sf):
    """Y2 with indicator encoders: a grid search over folds that each fit their own, then the refit."""
    d = fx(spark, sf, "fx_doc").select("doc_id", "n_chars", "n_spaces", "lang", "quality")
    b, cv = experiments.run_experiment(d, "random_forest", ["n_chars", "n_spaces", "lang"], "quality", "doc_id", k=3,
                                       grid={"n_trees": [5], "max_depth": [3, 4]}, prep={"encoder": "one_hot", "scaler": "min_max"})
    best = F.lit(",".join(b.fitted.features))
    return finish(search.cv_results(cv).withColumn("features", best))


@register("experiment_predict")
def q_exp_predict(spark, sf):
    te, b = _experiment(spark, sf)
    return finish(experiments.predict(te.select(*KEY, *FEATS, "y_cls"), b))


@register("experiment_score_json")
def q_exp_score(spark, sf):
    te, b = _experiment(spark, sf)
    path = _scratch(spark) + "/metrics"
    experiments.score(te, b, json_path=path)
    return finish(Rd.read_table(spark, path, fmt="json").select("metric", "value"))


@register("write_json_roundtrip", _REG + "SELECT grp, COUNT(*) AS n, " + ", ".join(
    r(e, n) for n, e in _REG_SQL.items()) + " FROM fx_reg JOIN m USING (grp) GROUP BY grp")
def q_json_roundtrip(spark, sf):
    path = _scratch(spark) + "/report"
    from quarry.sources import writers
    writers.write_json(Mx.regression_report(fx(spark, sf, "fx_reg"), "y_true", "y_pred", "grp"), path)
    return finish(Rd.read_table(spark, path, fmt="json"))


@register("bundle_roundtrip")
def q_bundle(spark, sf):
    te, b = _experiment(spark, sf)
    path = _scratch(spark) + "/bundle"
    experiments.save_bundle(b, path, spark)
    b2 = experiments.load_bundle(spark, path)
    p1 = experiments.predict(te.select(*KEY, *FEATS), b).select(*KEY, F.col("prediction").alias("a"), F.col("p1").alias("pa"))
    p2 = experiments.predict(te.select(*KEY, *FEATS), b2).select(*KEY, F.col("prediction").alias("b"), F.col("p1").alias("pb"))
    return p1.join(p2, KEY).select(*KEY, "a", "b", (F.col("a") == F.col("b")).alias("same_prediction"),
                                   (F.abs(F.col("pa") - F.col("pb")) < 1e-12).alias("same_probability"))
