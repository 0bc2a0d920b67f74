"""Column profiles (E rows)."""

from __future__ import annotations

from quarry.catalog import register
from quarry.catalog.fixtures import finish, fx, r, with_fx
from quarry.operators import profiles as E

_NUM = ["qty", "price", "disc", "tax"]


def _describe_sql(c: str) -> str:
    return (f"SELECT '{c}' AS column, COUNT({c}) AS count, " + ", ".join([
        r(f"AVG({c})", "mean"), r(f"VAR_SAMP({c})", "variance", 2), r(f"STDDEV_SAMP({c})", "std"),
        r(f"MIN({c})", "min"), r(f"QUANTILE_CONT({c}, 0.25)", "q1"), r(f"QUANTILE_CONT({c}, 0.5)", "median"),
        r(f"QUANTILE_CONT({c}, 0.75)", "q3"), r(f"MAX({c})", "max")]) + " FROM fx_num")


@register("describe_columns", with_fx("fx_num") + " UNION ALL ".join(_describe_sql(c) for c in _NUM))
def q_describe(spark, sf):
    return finish(E.describe_columns(fx(spark, sf, "fx_num"), _NUM), 6, {"variance": 2, "mean": 7})


def _box_sql(c: str) -> str:
    return f"""SELECT '{c}' AS column, {r('q1', 'q1')}, {r('med', 'median')}, {r('q3', 'q3')}, {r('q3 - q1', 'iqr')},
  {r('q1 - 1.5 * (q3 - q1)', 'lower_fence')}, {r('q3 + 1.5 * (q3 - q1)', 'upper_fence')},
  (SELECT COUNT(*) FROM fx_num WHERE {c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) AS n_outliers
FROM (SELECT QUANTILE_CONT({c}, 0.25) AS q1, QUANTILE_CONT({c}, 0.5) AS med, QUANTILE_CONT({c}, 0.75) AS q3 FROM fx_num)"""


_BOX_COLS = ["qty", "price", "disc", "y_reg"]


@register("box_stats", with_fx("fx_num") + " UNION ALL ".join(_box_sql(c) for c in _BOX_COLS))
def q_box(spark, sf):
    return finish(E.box_stats(fx(spark, sf, "fx_num"), _BOX_COLS))


_HIST_COLS = ["qty", "price", "disc", "tax", "const_col"]


def _hist_sql(c: str) -> str:
    return f"""SELECT '{c}' AS column, b.bin::INTEGER AS bin, {r('s.lo + b.bin * s.w', 'lo')},
  {r('CASE WHEN b.bin = s.nb - 1 THEN s.lo + s.nb * s.w ELSE s.lo + (b.bin + 1) * s.w END', 'hi')},
  (SELECT COUNT(*) FROM fx_num WHERE (CASE WHEN s.w = 0 THEN 0 ELSE LEAST(FLOOR(({c} - s.lo) / s.w), s.nb - 1) END) = b.bin)::BIGINT AS n
FROM (SELECT MIN({c}) AS lo, LEAST(10, COUNT(DISTINCT {c})) AS nb,
             (MAX({c}) - MIN({c})) / LEAST(10, COUNT(DISTINCT {c})) AS w FROM fx_num) s,
     LATERAL (SELECT UNNEST(RANGE(0, s.nb)) AS bin) b"""


@register("histogram", with_fx("fx_num") + " UNION ALL ".join(_hist_sql(c) for c in _HIST_COLS))
def q_histogram(spark, sf):
    return finish(E.histogram(fx(spark, sf, "fx_num"), _HIST_COLS, 10))


_DENS = with_fx("fx_num") + """, long AS (SELECT 'qty' AS column, qty AS value FROM fx_num UNION ALL SELECT 'y_reg', y_reg FROM fx_num),
st AS (SELECT "column", COUNT(*) AS n, MIN(value) AS lo, MAX(value) AS hi,
         STDDEV_SAMP(value) * POWER(COUNT(*)::DOUBLE, -0.2) AS bw, (MAX(value) - MIN(value)) / 2048 AS w
       FROM long GROUP BY "column"),
h AS (SELECT l."column", CASE WHEN w = 0 THEN 0 ELSE LEAST(FLOOR((value - lo) / w), 2047) END AS fb,
         COUNT(*) AS c, AVG(value) AS xc FROM long l JOIN st USING ("column") GROUP BY 1, 2),
g AS (SELECT "column", t.gi, lo + (hi - lo) * t.gi / 99 AS x, n, bw FROM st, range(0, 100) t(gi))
SELECT g."column", g.gi::INTEGER AS gi, """ + r("g.x", "x") + ", " + r(
    "SUM(h.c * EXP(-0.5 * POWER((g.x - h.xc) / g.bw, 2))) / (MAX(g.n) * MAX(g.bw) * SQRT(2 * PI()))", "density") + \
    ' FROM g JOIN h USING ("column") GROUP BY g."column", g.gi, g.x'


@register("density", _DENS)
def q_density(spark, sf):
    return finish(E.density(fx(spark, sf, "fx_num"), ["qty", "y_reg"], grid=100))


@register("series", """WITH p AS (SELECT ROW_NUMBER() OVER (ORDER BY ts, event_id) - 1 AS pos, value FROM events),
n AS (SELECT COUNT(*) AS n FROM events)
SELECT 'value' AS column, CAST(FLOOR(pos * 50 / n) AS INTEGER) AS bucket, MIN(pos) AS first_row, MAX(pos) AS last_row, """
          + ", ".join([r("MIN(value)", "min"), r("AVG(value)", "avg"), r("MAX(value)", "max")]) +
          " FROM p, n GROUP BY 1, 2")
def q_series(spark, sf):
    return finish(E.series(fx(spark, sf, "events"), ["value"], ["ts", "event_id"], buckets=50))


# ---------------------------------------------------------------- E6-E8

from pyspark.sql import functions as F  # noqa: E402

from quarry.functions.hashing import md5_sql  # noqa: E402
from quarry.operators import neighbors as N  # noqa: E402


@register("pca_projection")
def q_pca(spark, sf):
    proj, _ = N.pca(fx(spark, sf, "fx_num"), ["qty", "price", "disc", "tax"], 2,
                    ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"])
    return finish(proj, 4)


@register("pca_variance")
def q_pca_var(spark, sf):
    _, var = N.pca(fx(spark, sf, "embeddings"), "embedding", 3, ["vec_id"])
    return finish(var)


@register("knn_graph", """WITH e AS (SELECT vec_id, embedding FROM embeddings),
p AS (SELECT a.vec_id AS id, b.vec_id AS nbr,
        SQRT(list_sum(list_transform(list_zip(a.embedding, b.embedding), lambda z: POWER(z[1]::DOUBLE - z[2]::DOUBLE, 2)))) AS dist
      FROM e a JOIN e b ON a.vec_id <> b.vec_id),
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY id ORDER BY dist, nbr) AS rank FROM p)
SELECT id, nbr, """ + r("dist", "dist", 4) + ", rank::INTEGER AS rank FROM r WHERE rank <= 5")
def q_knn(spark, sf):
    g = N.knn_graph(fx(spark, sf, "embeddings"), "vec_id", "embedding", 5, method="exact", block_rows=128)
    return finish(g.withColumn("rank", F.col("rank").cast("int")), 4)


@register("knn_graph_lists")
def q_knn_lists(spark, sf):
    """E7 by inverted lists; recall against the exact graph is measured in tests/test_neighbors.py."""
    g = N.knn_graph(fx(spark, sf, "embeddings"), "vec_id", "embedding", 5)
    return finish(g.withColumn("rank", F.col("rank").cast("int")), 4)


@register("scatter_sample", "SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders ORDER BY " +
          md5_sql("o_orderkey", 9) + ", o_orderkey LIMIT 200")
def q_scatter(spark, sf):
    return N.scatter_sample(fx(spark, sf, "orders"), ["o_totalprice", "o_orderpriority"], 200, "o_orderkey", 9,
                            hash_method="md5")
