"""Grouped statistical tests (G rows)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.catalog import register
from quarry.catalog.fixtures import finish, fx, r, with_fx
from quarry.operators import stattests as G

# Cornish-Fisher expansion of the Student-t quantile around the normal one
# (Abramowitz & Stegun 26.7.5): an oracle independent of our inverse-CDF search.
_Z975 = "CAST(1.959963984540054 AS DOUBLE)"


def _t975(nu: str) -> str:
    z = _Z975
    g1 = f"(POWER({z},3) + {z}) / 4"
    g2 = f"(5*POWER({z},5) + 16*POWER({z},3) + 3*{z}) / 96"
    g3 = f"(3*POWER({z},7) + 19*POWER({z},5) + 17*POWER({z},3) - 15*{z}) / 384"
    g4 = f"(79*POWER({z},9) + 776*POWER({z},7) + 1482*POWER({z},5) - 1920*POWER({z},3) - 945*{z}) / 92160"
    return f"({z} + {g1}/{nu} + {g2}/POWER({nu},2) + {g3}/POWER({nu},3) + {g4}/POWER({nu},4))"


def _events(spark, sf):
    return fx(spark, sf, "events")


@register("describe_groups", "SELECT event_type, COUNT(*) AS n, " + ", ".join([
    r("AVG(value)", "mean"), r("STDDEV_SAMP(value)", "std"), r("STDDEV_SAMP(value) / SQRT(COUNT(*))", "std_error"),
    r("QUANTILE_CONT(value, 0.5)", "median"), r("MIN(value)", "min"), r("MAX(value)", "max"),
    r("QUANTILE_CONT(value, 0.25)", "q1"), r("QUANTILE_CONT(value, 0.75)", "q3"),
    r("QUANTILE_CONT(value, 0.75) - QUANTILE_CONT(value, 0.25)", "iqr"),
    r("CASE WHEN ABS(AVG(value)) > 1e-10 THEN STDDEV_SAMP(value) / ABS(AVG(value)) * 100 ELSE 0 END",
      "coefficient_of_variation")]) + " FROM events GROUP BY event_type")
def q_describe_groups(spark, sf):
    return finish(G.describe_groups(_events(spark, sf), "value", "event_type"))


@register("confidence_interval", "SELECT event_type, COUNT(*) AS n, " + ", ".join([
    r("AVG(value)", "point_estimate"),
    r(f"AVG(value) - {_t975('(COUNT(*) - 1)')} * STDDEV_SAMP(value) / SQRT(COUNT(*))", "lower"),
    r(f"AVG(value) + {_t975('(COUNT(*) - 1)')} * STDDEV_SAMP(value) / SQRT(COUNT(*))", "upper"),
    r(f"{_t975('(COUNT(*) - 1)')} * STDDEV_SAMP(value) / SQRT(COUNT(*))", "margin_of_error"),
    r("0.95", "confidence_level")]) + " FROM events GROUP BY event_type")
def q_confidence_interval(spark, sf):
    return finish(G.confidence_interval(_events(spark, sf), "value", "event_type", 0.95))


@register("shapiro_wilk")
def q_shapiro(spark, sf):
    return finish(G.shapiro(_events(spark, sf), "value", "event_type"))


@register("analyze_groups")
def q_analyze_groups(spark, sf):
    return finish(G.analyze_groups(_events(spark, sf), "value", "event_type"))


@register("paired_ttest", with_fx("fx_paired") + "SELECT COUNT(*) AS n, " + ", ".join([
    r("AVG(a - b)", "mean_difference"), r("STDDEV_SAMP(a - b)", "std_difference"),
    r("AVG(a - b) / (STDDEV_SAMP(a - b) / SQRT(COUNT(*)))", "statistic")]) + " FROM fx_paired")
def q_paired_ttest(spark, sf):
    return finish(G.paired_ttest(fx(spark, sf, "fx_paired"), "a", "b", with_p=False))


@register("paired_ttest_pvalue")
def q_paired_ttest_p(spark, sf):
    return finish(G.paired_ttest(fx(spark, sf, "fx_paired"), "a", "b", with_p=True))


_DZ = "CASE WHEN STDDEV_SAMP(a - b) < 1e-10 THEN 0.0 ELSE AVG(a - b) / STDDEV_SAMP(a - b) END"


@register("cohens_dz", with_fx("fx_paired") + f"""SELECT COUNT(*) AS n, {r(_DZ, 'effect_size')},
  CASE WHEN ABS({_DZ}) < 0.2 THEN 'negligible' WHEN ABS({_DZ}) < 0.5 THEN 'small'
       WHEN ABS({_DZ}) < 0.8 THEN 'medium' ELSE 'large' END AS effect_size_interpretation FROM fx_paired""")
def q_cohens_dz(spark, sf):
    return finish(G.cohens_dz(fx(spark, sf, "fx_paired"), "a", "b"))


_WIL = with_fx("fx_paired") + """, d AS (SELECT a - b AS d FROM fx_paired WHERE a - b <> 0),
rk AS (SELECT d, RANK() OVER (ORDER BY ABS(d)) + (COUNT(*) OVER (PARTITION BY ABS(d)) - 1) / 2.0 AS rnk FROM d),
w AS (SELECT SUM(CASE WHEN d > 0 THEN rnk ELSE 0 END) AS wp, SUM(CASE WHEN d < 0 THEN rnk ELSE 0 END) AS wm,
             COUNT(*) AS nz FROM rk)
"""


@register("wilcoxon", _WIL + "SELECT (SELECT COUNT(*) FROM fx_paired) AS n, " + ", ".join([
    r("wp", "w_plus"), r("wm", "w_minus"), "nz AS n_nonzero",
    r("CASE WHEN (SELECT COUNT(*) FROM fx_paired) >= 5 AND nz > 0 THEN LEAST(wp, wm) END", "statistic")]) + " FROM w")
def q_wilcoxon(spark, sf):
    return finish(G.wilcoxon(fx(spark, sf, "fx_paired"), "a", "b", with_p=False))


@register("wilcoxon_pvalue")
def q_wilcoxon_p(spark, sf):
    return finish(G.wilcoxon(fx(spark, sf, "fx_paired"), "a", "b", with_p=True))


_VAR_IN = "SELECT user_id, event_type, AVG(value) AS value FROM events GROUP BY user_id, event_type"


@register("compare_variants", _WIL + f"""SELECT COUNT(*) AS n, {r('AVG(a)', 'mean_a')}, {r('AVG(b)', 'mean_b')},
  {r('AVG(a) - AVG(b)', 'mean_difference')},
  {r('AVG(a - b) / (STDDEV_SAMP(a - b) / SQRT(COUNT(*)))', 't_statistic')}, {r(_DZ, 'effect_size')},
  CASE WHEN ABS({_DZ}) < 0.2 THEN 'negligible' WHEN ABS({_DZ}) < 0.5 THEN 'small'
       WHEN ABS({_DZ}) < 0.8 THEN 'medium' ELSE 'large' END AS effect_size_interpretation,
  {r('(SELECT LEAST(wp, wm) FROM w)', 'wilcoxon_statistic')} FROM fx_paired""")
def q_compare_variants(spark, sf):
    long = fx(spark, sf, "events").sparkSession.sql(_VAR_IN)
    return finish(G.compare_variants(long, "user_id", "event_type", "value", "click", "view", with_p=False, unpaired="drop"))


@register("compare_variants_report")
def q_compare_variants_p(spark, sf):
    long = fx(spark, sf, "events").sparkSession.sql(_VAR_IN)
    return finish(G.compare_variants(long, "user_id", "event_type", "value", "click", "view", with_p=True, unpaired="drop"))


@register("jarque_bera", """WITH m AS (SELECT event_type, AVG(value) AS mu, COUNT(*) AS n FROM events GROUP BY event_type),
c AS (SELECT event_type, MAX(n) AS n, AVG(POWER(value - mu, 2)) AS m2, AVG(POWER(value - mu, 3)) AS m3,
             AVG(POWER(value - mu, 4)) AS m4 FROM events JOIN m USING (event_type) GROUP BY event_type),
s AS (SELECT event_type, n, m3 / POWER(m2, 1.5) AS sk, m4 / (m2 * m2) - 3 AS ku FROM c)
SELECT event_type, n, """ + ", ".join([
    r("sk", "skewness"), r("ku", "kurtosis"), r("n / 6.0 * (sk * sk + ku * ku / 4)", "statistic"),
    r("EXP(-(n / 6.0 * (sk * sk + ku * ku / 4)) / 2)", "p_value")]) + " FROM s")
def q_jarque_bera(spark, sf):
    return finish(G.jarque_bera(_events(spark, sf), "value", "event_type"))
