"""Feature scoring, voting and selection (F and V rows)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.catalog import register
from quarry.catalog.fixtures import finish, fx, r, with_fx
from quarry.operators import encoding, scaling, scoring, voting

FEATS = ["qty", "price", "disc", "tax", "const_col"]
KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]


def _num(spark, sf):
    return fx(spark, sf, "fx_num").select(*KEY, *FEATS, "y_cls", "y_reg")


# ---------------------------------------------------------------- SQL builders (oracle side)

def _bin(c: str, src: str, n: int = 10) -> str:
    mn, mx = f"(SELECT MIN({c}) FROM {src})", f"(SELECT MAX({c}) FROM {src})"
    return f"CASE WHEN {mx} = {mn} THEN 0 ELSE LEAST(FLOOR(({c} - {mn}) / (({mx} - {mn}) / {n})), {n - 1}) END"


def _corr(c: str, t: str) -> str:
    return f"CASE WHEN STDDEV_POP({c}) = 0 OR STDDEV_POP({t}) = 0 THEN NULL ELSE CORR({c}, {t}) END"


def raw_sql(src: str, feats: list[str], target: str, method: str, task: str) -> str:
    parts = []
    for c in feats:
        if method == "correlation":
            parts.append(f"SELECT 'correlation' AS method, '{c}' AS feature, ABS({_corr(c, target)}) AS raw FROM {src}")
        elif method == "variance":
            parts.append(f"SELECT 'variance' AS method, '{c}' AS feature, VAR_POP({c}) AS raw FROM {src}")
        elif method == "f_score" and task == "regression":
            rr = f"POWER({_corr(c, target)}, 2)"
            parts.append(f"SELECT 'f_score' AS method, '{c}' AS feature, {rr} / (1 - {rr}) * (COUNT(*) - 2) AS raw FROM {src}")
        elif method == "f_score":
            parts.append(f"""SELECT 'f_score' AS method, '{c}' AS feature, CASE WHEN SUM(ssw) = 0 THEN NULL ELSE
  (SUM(nk * POWER(mk - (SELECT AVG({c}) FROM {src}), 2)) / (COUNT(*) - 1)) / (SUM(ssw) / (SUM(nk) - COUNT(*))) END AS raw
  FROM (SELECT COUNT(*) AS nk, AVG({c}) AS mk, VAR_POP({c}) * COUNT(*) AS ssw FROM {src} GROUP BY {target})""")
        elif method == "mutual_info":
            k = _bin(target, src) if task == "regression" else target
            parts.append(f"""SELECT 'mutual_info' AS method, '{c}' AS feature, SUM(cnt / n * LN(cnt * n / (pb * pc))) AS raw FROM (
  SELECT cnt, SUM(cnt) OVER () AS n, SUM(cnt) OVER (PARTITION BY b) AS pb, SUM(cnt) OVER (PARTITION BY k) AS pc
  FROM (SELECT b, k, COUNT(*) AS cnt FROM (SELECT {_bin(c, src)} AS b, {k} AS k FROM {src}) GROUP BY b, k))""")
        elif method == "chi2":
            parts.append(f"""SELECT 'chi2' AS method, '{c}' AS feature, SUM(POWER(o - e, 2) / e) AS raw FROM (
  SELECT o, nc / SUM(nc) OVER () * SUM(o) OVER () AS e FROM (
    SELECT SUM({_bin(c, src)}) AS o, COUNT(*) AS nc FROM {src} GROUP BY {target}))""")
        elif method == "chi2_contingency":
            parts.append(f"""SELECT 'chi2_contingency' AS method, '{c}' AS feature, SUM(cnt * cnt * n / (rb * cc)) - MAX(n) AS raw FROM (
  SELECT cnt, SUM(cnt) OVER () AS n, SUM(cnt) OVER (PARTITION BY b) AS rb, SUM(cnt) OVER (PARTITION BY k) AS cc
  FROM (SELECT b, k, COUNT(*) AS cnt FROM (SELECT {_bin(c, src)} AS b, {target} AS k FROM {src}) GROUP BY b, k))""")
    return " UNION ALL ".join(parts)


def scores_sql(src: str, feats: list[str], target: str, methods: list[str], task: str) -> str:
    """CTE body producing (method, feature, raw, score) with the F11 clean-up."""
    raw = " UNION ALL ".join(f"({raw_sql(src, feats, target, m, task)})" for m in methods)
    clean = ("CASE WHEN raw IS NULL OR isnan(raw) OR raw = '-inf'::DOUBLE THEN 0.0 "
             "WHEN raw = 'inf'::DOUBLE THEN 1.7976931348623157e308 ELSE raw END")
    return f"""SELECT method, feature, raw, CASE WHEN method = 'correlation' THEN raw
  WHEN MAX(raw) OVER (PARTITION BY method) > 0 THEN raw / MAX(raw) OVER (PARTITION BY method) ELSE raw END AS score
FROM (SELECT method, feature, {clean} AS raw FROM ({raw}))"""


def _score_out(cte: str = "sc") -> str:
    return f"SELECT method, feature, {r('raw', 'raw')}, {r('score', 'score')} FROM {cte}"


def _spark_scores(df):
    return finish(df.select("method", "feature", "raw", "score"))


# ---------------------------------------------------------------- F1-F11

@register("discretize", with_fx("fx_num") + f"SELECT {', '.join(KEY)}, " + ", ".join(
    f"CAST({_bin(c, 'fx_num')} AS INTEGER) AS {c}" for c in FEATS) + " FROM fx_num")
def q_discretize(spark, sf):
    return scoring.discretize(_num(spark, sf).select(*KEY, *FEATS), FEATS, 10)


@register("correlation_matrix", with_fx("fx_num") + " UNION ALL ".join(
    f"SELECT '{a}' AS x, '{b}' AS y, {r(_corr(a, b), 'corr')} FROM fx_num" for a in FEATS for b in FEATS))
def q_corr_matrix(spark, sf):
    return finish(scoring.correlation_matrix(_num(spark, sf), FEATS))


def _single_score(method: str, task: str, target: str, fn):
    sql = with_fx("fx_num") + f", sc AS ({scores_sql('fx_num', FEATS, target, [method], task)})\n" + _score_out()
    register(f"score_{method}_{task}", sql)(lambda spark, sf: _spark_scores(fn(_num(spark, sf), target, FEATS)))


_single_score("correlation", "regression", "y_reg", scoring.score_correlation)
_single_score("variance", "regression", "y_reg", scoring.score_variance)
_single_score("f_score", "regression", "y_reg", scoring.score_f_regression)
_single_score("f_score", "classification", "y_cls", scoring.score_f_classif)
_single_score("mutual_info", "classification", "y_cls", scoring.score_mi_classif)
_single_score("mutual_info", "regression", "y_reg", scoring.score_mi_regression)
_single_score("chi2", "classification", "y_cls", scoring.score_chi2)
_single_score("chi2_contingency", "classification", "y_cls", scoring.chi2_contingency)


@register("score_pvalues")
def q_score_p(spark, sf):
    df = _num(spark, sf)
    return finish(scoring.score_f_classif(df, "y_cls", FEATS).unionByName(scoring.score_chi2(df, "y_cls", FEATS))
                  .unionByName(scoring.chi2_contingency(df, "y_cls", FEATS))
                  .unionByName(scoring.score_f_regression(df, "y_reg", FEATS)))


@register("variance_threshold", with_fx("fx_num") + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {r(f'VAR_POP({c})', 'variance')}, VAR_POP({c}) > 0.2 AS selected FROM fx_num"
    for c in FEATS))
def q_variance_threshold(spark, sf):
    return finish(scoring.variance_threshold(_num(spark, sf), "y_reg", 0.2, FEATS))


@register("score_custom")
def q_score_custom(spark, sf):
    def spread(df, feats, target):  # a user scorer: max - min range of each feature
        row = df.agg(*[(F.max(c) - F.min(c)).alias(c) for c in feats])
        return row.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("raw"))
                                              for c in feats])).alias("s")).select("s.*")
    return finish(scoring.score_custom(_num(spark, sf), "y_reg", spread, "range", FEATS))


# ---------------------------------------------------------------- F12

_FC = with_fx("fx_num") + f", sc AS ({scores_sql('fx_num', FEATS, 'y_cls', ['f_score'], 'classification')})\n"


@register("select_k_best", _FC + f"""SELECT method, feature, {r('score', 'score')},
  ROW_NUMBER() OVER (ORDER BY score DESC, feature) <= 2 AS selected FROM sc""")
def q_kbest(spark, sf):
    s = scoring.select_univariate(scoring.score_f_classif(_num(spark, sf), "y_cls", FEATS), "k_best", 2)
    return finish(s.select("method", "feature", "score", "selected"))


@register("select_percentile", _FC + f"""SELECT method, feature, {r('score', 'score')},
  ROW_NUMBER() OVER (ORDER BY score DESC, feature) <= FLOOR(COUNT(*) OVER () * 40 / 100.0) AS selected FROM sc""")
def q_percentile(spark, sf):
    s = scoring.select_univariate(scoring.score_f_classif(_num(spark, sf), "y_cls", FEATS), "percentile", 40)
    return finish(s.select("method", "feature", "score", "selected"))


@register("select_pvalue_modes")
def q_pmodes(spark, sf):
    s = scoring.score_f_classif(_num(spark, sf), "y_cls", FEATS)
    out = None
    for mode in ("fpr", "fdr", "fwe"):
        t = scoring.select_univariate(s, mode).select(F.lit(mode).alias("mode"), "feature", "p_value", "selected")
        out = t if out is None else out.unionByName(t)
    return finish(out)


# p-values that both engines know: a share of the group's keys
_GIVEN = """SELECT 'given' AS method, o_orderpriority || '/' || CAST(o_custkey % 9 AS STRING) AS feature,
  AVG(o_totalprice) AS score, CAST(SUM(o_orderkey) % 1009 AS DOUBLE) / 5000.0 AS p_value
FROM orders GROUP BY o_orderpriority, o_custkey % 9"""


@register("select_given_pvalues", f"""WITH s AS ({_GIVEN}),
k AS (SELECT *, COUNT(*) OVER () AS d, ROW_NUMBER() OVER (ORDER BY p_value, feature) AS pos FROM s),
c AS (SELECT *, MAX(CASE WHEN p_value <= 0.05 * pos / d THEN p_value END) OVER () AS cut FROM k)
SELECT 'fpr' AS mode, feature, {r('p_value', 'p_value')}, p_value < 0.05 AS selected FROM c
UNION ALL SELECT 'fdr', feature, {r('p_value', 'p_value')}, COALESCE(p_value <= cut, FALSE) FROM c
UNION ALL SELECT 'fwe', feature, {r('p_value', 'p_value')}, p_value < 0.05 / d FROM c""")
def q_given_pvalues(spark, sf):
    """the modes on p-values, over given ones."""
    fx(spark, sf, "orders")  # registers the views
    s = spark.sql(_GIVEN)
    out = None
    for mode in ("fpr", "fdr", "fwe"):
        t = scoring.select_univariate(s, mode).select(F.lit(mode).alias("mode"), "feature", "p_value", "selected")
        out = t if out is None else out.unionByName(t)
    return finish(out)


_MI_IN = """SELECT c_custkey, CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE c_acctbal END AS acct,
  CAST(CASE c_mktsegment WHEN 'BUILDING' THEN 1.5 ELSE 0.25 END + c_nationkey % 3 AS DOUBLE) AS seg,
  c_acctbal + 2000.0 * (c_nationkey % 4) AS shifted, c_nationkey % 4 AS cls FROM customer"""


@register("score_mutual_info_neighbors", f"""WITH x AS ({_MI_IN}),
psi AS (SELECT n, -0.57721566490153286 + coalesce(sum(1.0 / (n - 1)) FILTER (n > 1) OVER (ORDER BY n), 0.0) AS h FROM range(1, 200001) t(n)),
v AS (SELECT c_custkey, cls, feature, x FROM (SELECT c_custkey, cls, unnest(['acct', 'seg', 'shifted']) AS feature,
  unnest([acct, seg, shifted]) AS x FROM x) WHERE x IS NOT NULL),
near AS (SELECT a.c_custkey, a.feature, a.x, a.cls, abs(a.x - b.x) AS d,
  ROW_NUMBER() OVER (PARTITION BY a.feature, a.c_custkey ORDER BY abs(a.x - b.x)) AS rk, COUNT(*) OVER (PARTITION BY a.feature, a.c_custkey) + 1 AS n_cls
  FROM v a JOIN v b ON a.feature = b.feature AND a.cls = b.cls AND a.c_custkey <> b.c_custkey),
rad AS (SELECT c_custkey, feature, x, n_cls, d AS radius FROM near WHERE rk = 3),
m AS (SELECT r.feature, r.c_custkey, r.n_cls, COUNT(*) AS m FROM rad r JOIN v ON v.feature = r.feature
  AND ((r.radius > 0 AND v.x > r.x - r.radius AND v.x < r.x + r.radius) OR (r.radius = 0 AND v.x = r.x)) GROUP BY ALL),
t AS (SELECT feature, COUNT(*) AS n, AVG((SELECT h FROM psi WHERE n = 3) - pc.h - pm.h) AS s
  FROM m JOIN psi pc ON pc.n = m.n_cls JOIN psi pm ON pm.n = m.m GROUP BY feature)
SELECT t.feature, {r('GREATEST(0.0, psi.h + s)', 'raw')} FROM t JOIN psi ON psi.n = t.n""")
def q_mi_neighbors(spark, sf):
    """F9 by nearest neighbours, against all pairs."""
    fx(spark, sf, "customer")  # registers the views
    return finish(scoring.score_mi_classif(spark.sql(_MI_IN), "cls", ["acct", "seg", "shifted"], estimator="neighbors").select("feature", "raw"))


# nulls, NaN and rows without a class
_HOLES = """SELECT CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_quantity END AS qty,
  CASE WHEN l_orderkey % 5 = 0 THEN CAST('NaN' AS DOUBLE) ELSE l_discount + 0.0 END AS disc,
  CASE WHEN l_orderkey % 11 = 0 THEN NULL ELSE l_returnflag END AS cls FROM lineitem"""


def _holes_sql(method: str) -> str:
    own = {c: raw_sql(f"(SELECT * FROM h WHERE {c} IS NOT NULL AND NOT isnan({c}) AND cls IS NOT NULL) AS t", [c], "cls", method, "classification")
           for c in ("qty", "disc")}
    return f"WITH h AS ({_HOLES}) SELECT feature, {r('raw', 'raw')} FROM (" + " UNION ALL ".join(f"({q})" for q in own.values()) + ")"


def _holes(method: str, fn):
    def q(spark, sf):
        fx(spark, sf, "lineitem")  # registers the views
        return finish(fn(spark.sql(_HOLES), "cls", ["qty", "disc"]).select("feature", "raw"))
    register(f"score_{method}_holes", _holes_sql(method))(q)


for _method, _fn in (("f_score", scoring.score_f_classif), ("mutual_info", scoring.score_mi_classif), ("chi2", scoring.score_chi2),
                     ("chi2_contingency", scoring.chi2_contingency)):
    _holes(_method, _fn)


# ---------------------------------------------------------------- V rows

_METHODS = ["f_score", "mutual_info", "correlation", "variance"]
_SC = with_fx("fx_num") + f", sc AS ({scores_sql('fx_num', FEATS, 'y_reg', _METHODS, 'regression')}),\n" + \
    "rk AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY method ORDER BY score DESC, feature) AS rank FROM sc)\n"


def _sel(spark, sf):
    return scoring.feature_scores(_num(spark, sf), "y_reg", "regression", _METHODS, FEATS)


@register("select_threshold", _SC + f"SELECT method, feature, {r('score', 'score')}, rank::INTEGER AS rank, "
          "score >= 0.2 AS selected FROM rk")
def q_v1(spark, sf):
    return finish(voting.select_threshold(_sel(spark, sf), 0.2).select("method", "feature", "score", "rank", "selected"))


@register("select_top_k", _SC + f"SELECT method, feature, {r('score', 'score')}, rank::INTEGER AS rank, rank <= 2 AS selected FROM rk")
def q_v2(spark, sf):
    return finish(voting.select_top_k(_sel(spark, sf), 2).select("method", "feature", "score", "rank", "selected"))


@register("select_top_percentile", _SC + f"SELECT method, feature, {r('score', 'score')}, rank::INTEGER AS rank, "
          "rank <= GREATEST(1, FLOOR(COUNT(*) OVER (PARTITION BY method) * 0.5)) AS selected FROM rk")
def q_v3(spark, sf):
    return finish(voting.select_top_percentile(_sel(spark, sf), 0.5).select("method", "feature", "score", "rank", "selected"))


_VOTE = _SC + """, v AS (SELECT feature, SUM(CASE WHEN score >= 0.2 THEN 1 ELSE 0 END)::BIGINT AS votes,
  AVG(rank) AS avg_rank, COUNT(*)::BIGINT AS n_methods FROM rk GROUP BY feature)
"""


@register("vote", _VOTE + f"SELECT feature, votes, {r('avg_rank', 'avg_rank')}, n_methods FROM v")
def q_v4(spark, sf):
    return finish(voting.vote(voting.select_threshold(_sel(spark, sf), 0.2)))


def _combine_sql(cond: str) -> str:
    return _VOTE + f"SELECT feature, votes, {r('avg_rank', 'avg_rank')}, n_methods, COALESCE({cond}, FALSE) AS final_selected FROM v"


register("combine_union", _combine_sql("votes > 0"))(
    lambda spark, sf: finish(voting.combine(voting.select_threshold(_sel(spark, sf), 0.2), "union")))
register("combine_intersection", _combine_sql("votes = n_methods"))(
    lambda spark, sf: finish(voting.combine(voting.select_threshold(_sel(spark, sf), 0.2), "intersection")))
register("combine_majority", _combine_sql("votes >= FLOOR(n_methods / 2) + 1"))(
    lambda spark, sf: finish(voting.combine(voting.select_threshold(_sel(spark, sf), 0.2), "majority")))
register("combine_min_votes", _combine_sql("votes > 0 AND votes >= 2"))(
    lambda spark, sf: finish(voting.combine(voting.select_threshold(_sel(spark, sf), 0.2), "union", min_votes=2)))

_W = {"f_score": 2.0, "mutual_info": 1.0, "correlation": 1.0, "variance": 0.5}
_WCASE = "CASE method " + " ".join(f"WHEN '{m}' THEN {w}" for m, w in _W.items()) + " END"


@register("combine_weighted", _VOTE + f""", ws AS (SELECT feature, SUM({_WCASE} * score) AS w FROM rk GROUP BY feature),
wn AS (SELECT feature, CASE WHEN MAX(w) OVER () > 0 THEN w / MAX(w) OVER () ELSE w END AS weighted_score FROM ws)
SELECT feature, votes, {r('avg_rank', 'avg_rank')}, n_methods, {r('weighted_score', 'weighted_score')},
  weighted_score >= 0.2 AS final_selected FROM v JOIN wn USING (feature)""")
def q_v8(spark, sf):
    return finish(voting.combine(voting.select_threshold(_sel(spark, sf), 0.2), "weighted", _W))


@register("selection_summary", _VOTE + "SELECT feature, " + ", ".join(
    f"{r(f'MAX(CASE WHEN method = {chr(39)}{m}{chr(39)} THEN score END)', m + '_score')}, "
    f"BOOL_OR(CASE WHEN method = '{m}' THEN score >= 0.2 END) AS {m}_selected" for m in _METHODS) +
    f", MAX(votes) AS votes, {r('MAX(avg_rank)', 'avg_rank')}, MAX(votes) >= 3 AS final_selected "
    "FROM rk JOIN v USING (feature) GROUP BY feature")
def q_v10(spark, sf):
    sel = voting.select_threshold(_sel(spark, sf), 0.2)
    return finish(voting.selection_summary(sel, voting.combine(sel, "majority"), _METHODS))


@register("score_summary", _SC + "SELECT feature, " + ", ".join(
    r(f"MAX(CASE WHEN method = '{m}' THEN score END)", m) for m in _METHODS) +
    f", {r('SUM(score) / 4', 'mean_score')} FROM sc GROUP BY feature")
def q_v11(spark, sf):
    return finish(voting.score_summary(_sel(spark, sf), _METHODS))


@register("select_best_features", _VOTE + f"""SELECT ROW_NUMBER() OVER (ORDER BY avg_rank, feature)::INTEGER AS position,
  feature, votes, {r('avg_rank', 'avg_rank')} FROM v WHERE votes >= 3""")
def q_v12(spark, sf):
    return finish(voting.select_best_features(_num(spark, sf), "y_reg", "regression", methods=_METHODS, features=FEATS))


# ---------------------------------------------------------------- flagship: which columns matter for y_reg?

_FLAG_FEATS = ["qty", "price", "disc", "tax", "flag3"]
_PREP = with_fx("fx_num") + """, q AS (SELECT """ + ", ".join(
    f"QUANTILE_CONT({c}, 0.5) AS m_{c}, CASE WHEN QUANTILE_CONT({c}, 0.75) = QUANTILE_CONT({c}, 0.25) THEN 1.0 "
    f"ELSE QUANTILE_CONT({c}, 0.75) - QUANTILE_CONT({c}, 0.25) END AS s_{c}" for c in _FLAG_FEATS[:4]) + """ FROM fx_num),
codes AS (SELECT flag3, DENSE_RANK() OVER (ORDER BY flag3) - 1 AS code FROM (SELECT DISTINCT flag3 FROM fx_num)),
prep AS (SELECT """ + ", ".join(f"({c} - m_{c}) / s_{c} AS {c}" for c in _FLAG_FEATS[:4]) + """,
  CAST(code AS DOUBLE) AS flag3, y_reg FROM fx_num JOIN codes USING (flag3), q)"""
_FLAG = _PREP + f", sc AS ({scores_sql('prep', _FLAG_FEATS, 'y_reg', _METHODS, 'regression')}),\n" + \
    """rk AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY method ORDER BY score DESC, feature) AS rank FROM sc),
v AS (SELECT feature, SUM(CASE WHEN score >= 0.2 THEN 1 ELSE 0 END)::BIGINT AS votes, AVG(rank) AS avg_rank FROM rk GROUP BY feature)
"""


@register("feature_ranking", _FLAG + f"""SELECT ROW_NUMBER() OVER (ORDER BY avg_rank, feature)::INTEGER AS position,
  feature, votes, {r('avg_rank', 'avg_rank')} FROM v WHERE votes >= 3""")
def q_feature_ranking(spark, sf):
    """Flagship: robust-scale the numeric columns, label-encode the return flag,
    score (F test, mutual information, |r|, variance), vote by majority, rank."""
    df = fx(spark, sf, "fx_num").select(*_FLAG_FEATS, "y_reg")
    st = scaling.fit_scaler(df, _FLAG_FEATS[:4], "robust")
    enc = encoding.fit_encoder(df, ["flag3"], "label")
    prep = encoding.transform(scaling.transform(df, st), enc)
    return finish(voting.select_best_features(prep, "y_reg", "regression", methods=_METHODS, features=_FLAG_FEATS))


# ---------------------------------------------------------------- F14

from quarry.functions.hashing import md5_sql  # noqa: E402
from quarry.operators import relief  # noqa: E402

_RELIEF = f"""WITH long AS (SELECT vec_id, label, t.i, embedding[t.i]::DOUBLE AS x FROM embeddings, range(1, 65) t(i)),
rg AS (SELECT i, MAX(x) - MIN(x) AS rg FROM long GROUP BY i),
anc AS (SELECT vec_id AS aid, label AS alab FROM embeddings),
pri AS (SELECT label, COUNT(*) / (SELECT COUNT(*) FROM embeddings)::DOUBLE AS prior FROM embeddings GROUP BY label),
dist AS (SELECT a.aid, a.alab, le.vec_id, le.label,
           SUM(CASE WHEN rg.rg = 0 THEN 0 ELSE ABS(la.x - le.x) / rg.rg END) AS dist
         FROM anc a JOIN long la ON la.vec_id = a.aid JOIN long le ON le.i = la.i AND le.vec_id <> a.aid
         JOIN rg ON rg.i = la.i GROUP BY a.aid, a.alab, le.vec_id, le.label),
nn AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY aid, label ORDER BY dist, vec_id) AS rk FROM dist) WHERE rk <= 5),
contrib AS (SELECT la.i, CASE WHEN nn.label = nn.alab THEN -1.0 ELSE p.prior / (1 - pa.prior) END / ((SELECT COUNT(*) FROM anc) * 5)
             * CASE WHEN rg.rg = 0 THEN 0 ELSE ABS(la.x - le.x) / rg.rg END AS c
            FROM nn JOIN long la ON la.vec_id = nn.aid JOIN long le ON le.vec_id = nn.vec_id AND le.i = la.i
            JOIN rg ON rg.i = la.i JOIN pri p ON p.label = nn.label JOIN pri pa ON pa.label = nn.alab),
w AS (SELECT 'embedding_' || (i - 1)::VARCHAR AS feature, SUM(c) AS weight FROM contrib GROUP BY i)
SELECT feature, {r('weight', 'weight')}, ROW_NUMBER() OVER (ORDER BY weight DESC, feature)::INTEGER AS rank,
  ROW_NUMBER() OVER (ORDER BY weight DESC, feature) <= 10 AS selected FROM w"""


@register("relief_weights", _RELIEF)
def q_relief(spark, sf):
    w = relief.relief_weights(fx(spark, sf, "embeddings"), "embedding", "label", "vec_id", k=5)
    return finish(w.withColumn("rank", F.col("rank").cast("int")))
