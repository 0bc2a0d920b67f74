"""Sources, cleaning, scaling and encoding (S and P rows)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from quarry.catalog import register
from quarry.catalog.fixtures import finish, fx, r, with_fx
from quarry.functions.hashing import md5_sql
from quarry.operators import cleaning, encoding, pipeline, scaling, splits
from quarry.session import ensure_checkpoint_dir
from quarry.sources import readers


def _scratch(spark) -> str:
    """A fresh folder under the shared checkpoint folder (never machine-local on a cluster)."""
    return f"{ensure_checkpoint_dir(spark)}/quarry-io/{uuid.uuid4().hex}"


# ---------------------------------------------------------------- S rows

@register("read_csv_decimal_mark", "SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END "
          "AS o_orderstatus, " + r("o_totalprice", "o_totalprice") + ", o_orderpriority FROM orders")
def q_read_csv(spark, sf):
    src = fx(spark, sf, "orders")
    path = _scratch(spark) + "/orders.CSV"
    (src.select(F.col("o_orderkey").cast("string").alias("o_orderkey"),
                F.when(F.col("o_orderstatus") == "P", F.lit("NA")).otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
                F.regexp_replace(F.col("o_totalprice").cast("string"), r"\.", ",").alias("o_totalprice"),
                "o_orderpriority")
     .write.option("header", True).option("sep", ";").csv(path))
    df = readers.read_table(spark, path, sep=";", decimal=",", missing_markers=["NA"])
    return finish(df.withColumn("o_orderkey", F.col("o_orderkey").cast("long")))


@register("read_json_records", "SELECT n_nationkey::BIGINT AS n_nationkey, n_name, n_regionkey::BIGINT AS n_regionkey FROM nation")
def q_read_json(spark, sf):
    path = _scratch(spark) + "/nation.json"
    fx(spark, sf, "nation").write.json(path)
    return readers.read_table(spark, path).select("n_nationkey", "n_name", "n_regionkey")


@register("read_parquet_pruned", "SELECT l_orderkey, l_quantity FROM lineitem WHERE l_quantity > 45")
def q_read_parquet(spark, sf):
    df = readers.read_table(spark, f"{sf}/lineitem.parquet")
    return df.select("l_orderkey", "l_quantity").filter(F.col("l_quantity") > 45)


@register("rename_columns", "SELECT r_regionkey AS region_id, r_name AS region_name FROM region")
def q_rename(spark, sf):
    return readers.rename_columns(fx(spark, sf, "region"), ["region_id", "region_name"])


@register("drop_unnamed", "SELECT n_nationkey, n_name FROM nation")
def q_drop_unnamed(spark, sf):
    df = fx(spark, sf, "nation").select(F.col("n_nationkey").alias("Unnamed: 0"), "n_nationkey", "n_name",
                                        F.col("n_regionkey").alias("_c3"))
    return readers.drop_unnamed(df)


@register("drop_all_null", with_fx("fx_nulls") + "SELECT " + r("value", "value") +
          ", event_type, is_even FROM fx_nulls WHERE NOT (value IS NULL AND event_type IS NULL AND is_even IS NULL)")
def q_drop_all_null(spark, sf):
    return finish(readers.drop_all_null(fx(spark, sf, "fx_nulls").select("value", "event_type", "is_even")))


@register("narrow_types", "SELECT l_orderkey::SMALLINT AS l_orderkey, l_linenumber::TINYINT AS l_linenumber, "
          "l_quantity FROM lineitem")
def q_narrow(spark, sf):
    return readers.narrow_types(fx(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity"))


# ---------------------------------------------------------------- P1-P4

def _interp_sql(partition: str | None) -> str:
    pb = f"PARTITION BY {partition} " if partition else ""
    return with_fx("fx_nulls") + f""", p AS (SELECT event_id, value,
      ROW_NUMBER() OVER ({pb}ORDER BY ts, event_id) - 1 AS pos{', ' + partition if partition else ''} FROM fx_nulls),
q AS (SELECT event_id, value, pos,
  LAST_VALUE(CASE WHEN value IS NOT NULL THEN pos END IGNORE NULLS) OVER
    ({pb}ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pp,
  LAST_VALUE(value IGNORE NULLS) OVER ({pb}ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pv,
  FIRST_VALUE(CASE WHEN value IS NOT NULL THEN pos END IGNORE NULLS) OVER
    ({pb}ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS np,
  FIRST_VALUE(value IGNORE NULLS) OVER ({pb}ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nv
  FROM p)
SELECT event_id, {r('CASE WHEN value IS NOT NULL THEN value WHEN pp IS NOT NULL AND np IS NOT NULL '
                   'THEN pv + (nv - pv) * (pos - pp) / (np - pp) WHEN pp IS NOT NULL THEN pv ELSE nv END', 'value')}
FROM q"""


@register("interpolate_global", _interp_sql(None))
def q_interp(spark, sf):
    df = fx(spark, sf, "fx_nulls").select("event_id", "ts", "value")
    return finish(cleaning.interpolate(df, ["value"], ["ts", "event_id"], n_buckets=8).select("event_id", "value"))


@register("interpolate_by_user", _interp_sql("user_id"))
def q_interp_user(spark, sf):
    df = fx(spark, sf, "fx_nulls").select("event_id", "ts", "user_id", "value")
    return finish(cleaning.interpolate(df, ["value"], ["ts", "event_id"], partition_by=["user_id"], n_buckets=3)
                  .select("event_id", "value"))


@register("fill_category", with_fx("fx_nulls") + "SELECT event_id, COALESCE(event_type, 'Unknown') AS event_type FROM fx_nulls")
def q_fill_category(spark, sf):
    return cleaning.fill_category(fx(spark, sf, "fx_nulls").select("event_id", "event_type"), ["event_type"])


_MODE = "(SELECT {c} FROM fx_nulls WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY COUNT(*) DESC, {c} ASC LIMIT 1)"


@register("fill_mode", with_fx("fx_nulls") + "SELECT event_id, COALESCE(is_even, " + _MODE.format(c="is_even") +
          ") AS is_even, COALESCE(event_type, " + _MODE.format(c="event_type") + ") AS event_type FROM fx_nulls")
def q_fill_mode(spark, sf):
    df = fx(spark, sf, "fx_nulls").select("event_id", "is_even", "event_type")
    return cleaning.fill_mode(df, ["is_even", "event_type"])


@register("map_values", with_fx("fx_cat") + "SELECT c_custkey, CASE WHEN CAST(flag01 AS VARCHAR) = '0' THEN 'No' "
          "ELSE CAST(flag01 AS VARCHAR) END AS flag01 FROM fx_cat")
def q_map_values(spark, sf):
    return cleaning.map_values(fx(spark, sf, "fx_cat").select("c_custkey", "flag01"), {"flag01": {"0": "No"}})


# ---------------------------------------------------------------- P5-P10, P16

_KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
_SC = ["qty", "price", "disc", "tax", "const_col"]


def _scaled(method: str):
    def q(spark, sf):
        df = fx(spark, sf, "fx_num").select(*_KEY, *_SC)
        st = scaling.fit_scaler(df, _SC, method)
        return finish(scaling.transform(df, st), 4)
    return q


def _scale_sql(stats: str, expr: str) -> str:
    return with_fx("fx_num") + f", s AS (SELECT {stats} FROM fx_num)\nSELECT {', '.join(_KEY)}, " + ", ".join(
        r(expr.format(c=c), c, 4) for c in _SC) + " FROM fx_num, s"


_STD_STATS = ", ".join(f"AVG({c}) AS m_{c}, CASE WHEN STDDEV_POP({c}) = 0 THEN 1.0 ELSE STDDEV_POP({c}) END AS s_{c}"
                       for c in _SC)
_MM_STATS = ", ".join(f"MIN({c}) AS m_{c}, CASE WHEN MAX({c}) = MIN({c}) THEN 1.0 ELSE MAX({c}) - MIN({c}) END AS s_{c}"
                      for c in _SC)
_MA_STATS = ", ".join(f"0.0 AS m_{c}, CASE WHEN MAX(ABS({c})) = 0 THEN 1.0 ELSE MAX(ABS({c})) END AS s_{c}" for c in _SC)
_RB_STATS = ", ".join(f"QUANTILE_CONT({c}, 0.5) AS m_{c}, CASE WHEN QUANTILE_CONT({c}, 0.75) = QUANTILE_CONT({c}, 0.25) "
                      f"THEN 1.0 ELSE QUANTILE_CONT({c}, 0.75) - QUANTILE_CONT({c}, 0.25) END AS s_{c}" for c in _SC)
_AFFINE = "({c} - m_{c}) / s_{c}"

register("scale_standard", _scale_sql(_STD_STATS, _AFFINE))(_scaled("standard"))
register("scale_min_max", _scale_sql(_MM_STATS, _AFFINE))(_scaled("min_max"))
register("scale_max_abs", _scale_sql(_MA_STATS, _AFFINE))(_scaled("max_abs"))
register("scale_robust", _scale_sql(_RB_STATS, _AFFINE))(_scaled("robust"))
register("scale_power")(_scaled("power"))


def _quantile_sql() -> str:
    """P10: knots, then for each value the knots around it; a value that several knots share lies in their middle."""
    probs = "[" + ", ".join(repr(i / 999) for i in range(1000)) + "]"
    ctes = []
    for c in _SC:
        ctes.append(f"""kn_{c} AS (SELECT unnest(range(1000)) AS i, unnest(QUANTILE_CONT({c}, {probs})) AS k FROM fx_num),
di_{c} AS (SELECT k, MIN(i) AS a, MAX(i) AS b, LEAD(k) OVER (ORDER BY k) AS nk, LEAD(MIN(i)) OVER (ORDER BY k) AS na FROM kn_{c} GROUP BY k),
un_{c} AS (SELECT x, CASE WHEN x = k THEN (a + b) / 2.0 ELSE b + (x - k) / (nk - k) * (na - b) END / 999.0 AS u
  FROM (SELECT DISTINCT {c} AS x FROM fx_num) v ASOF JOIN di_{c} d ON v.x >= d.k)""")
    joins = " ".join(f"JOIN un_{c} ON un_{c}.x = fx_num.{c}" for c in _SC)
    return with_fx("fx_num") + ", " + ",\n".join(ctes) + f"\nSELECT {', '.join(_KEY)}, " + ", ".join(
        r(f"un_{c}.u", c, 4) for c in _SC) + f" FROM fx_num {joins}"


register("scale_quantile", _quantile_sql())(_scaled("quantile"))


@register("inverse_robust", with_fx("fx_num") + f"SELECT {', '.join(_KEY)}, " + ", ".join(r(c, c, 4) for c in _SC) +
          " FROM fx_num")
def q_inverse_robust(spark, sf):
    df = fx(spark, sf, "fx_num").select(*_KEY, *_SC)
    st = scaling.fit_scaler(df, _SC, "robust")
    return finish(scaling.inverse_transform(scaling.transform(df, st), st), 4)


# ---------------------------------------------------------------- P11-P15

_SPLIT = f"{md5_sql('c_custkey', 42)} / 4294967296.0 < 0.2"


def _cat_split(spark, sf):
    return splits.train_test(fx(spark, sf, "fx_cat"), "c_custkey", 0.2, 42, hash_method="md5")


@register("label_encode", with_fx("fx_cat") + f""", tr AS (SELECT * FROM fx_cat WHERE NOT ({_SPLIT})),
codes AS (SELECT seg, DENSE_RANK() OVER (ORDER BY seg) - 1 AS code FROM (SELECT DISTINCT seg FROM tr))
SELECT c_custkey, code::INTEGER AS seg FROM fx_cat JOIN codes USING (seg) WHERE {_SPLIT}""")
def q_label_encode(spark, sf):
    d = _cat_split(spark, sf)
    st = encoding.fit_encoder(d.filter(~F.col("is_test")), ["seg"], "label")
    return encoding.transform(d.filter(F.col("is_test")).select("c_custkey", "seg"), st, unseen="error")


_SEGS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@register("one_hot_encode", with_fx("fx_cat") + "SELECT c_custkey, " + ", ".join(
    f"CASE WHEN c_mktsegment = '{s}' THEN 1 ELSE 0 END::INTEGER AS c_mktsegment_{s}" for s in _SEGS) + " FROM fx_cat")
def q_one_hot(spark, sf):
    df = fx(spark, sf, "fx_cat").select("c_custkey", "c_mktsegment")
    return encoding.transform(df, encoding.fit_encoder(df, ["c_mktsegment"], "one_hot"))


@register("binarize", with_fx("fx_cat") + "SELECT c_custkey, CASE WHEN flag01 = 1 THEN 1 ELSE 0 END::INTEGER AS flag01_1 FROM fx_cat")
def q_binarize(spark, sf):
    df = fx(spark, sf, "fx_cat").select("c_custkey", "flag01")
    return encoding.transform(df, encoding.fit_encoder(df, ["flag01"], "binarize"))


@register("multi_label_binarize", with_fx("fx_cat") + "SELECT c_custkey, " + ", ".join(
    f"CASE WHEN c_mktsegment = '{s}' THEN 1 ELSE 0 END::INTEGER AS labels_{s}" for s in _SEGS) +
    ", CASE WHEN flag01 = 1 THEN 1 ELSE 0 END::INTEGER AS labels_FLAG FROM fx_cat")
def q_multi_label(spark, sf):
    df = fx(spark, sf, "fx_cat").select(
        "c_custkey", F.filter(F.array(F.col("c_mktsegment"), F.when(F.col("flag01") == 1, F.lit("FLAG"))),
                              lambda x: x.isNotNull()).alias("labels"))
    return encoding.transform(df, encoding.fit_encoder(df, ["labels"], "multi_label"))


@register("unseen_to_unknown", with_fx("fx_nulls") + f""", f AS (SELECT event_id, COALESCE(event_type, 'Unknown') AS et FROM fx_nulls),
codes AS (SELECT et, DENSE_RANK() OVER (ORDER BY et) - 1 AS code FROM (SELECT DISTINCT et FROM f WHERE et <> 'purchase'))
SELECT f.event_id, COALESCE(codes.code, (SELECT code FROM codes WHERE et = 'Unknown'))::INTEGER AS event_type
FROM f LEFT JOIN codes USING (et)""")
def q_unseen(spark, sf):
    df = cleaning.fill_category(fx(spark, sf, "fx_nulls").select("event_id", "event_type"), ["event_type"])
    # fitted on a table whose categories exclude 'purchase', which is then unseen at transform
    st = encoding.fit_encoder(df.filter(F.col("event_type") != "purchase"), ["event_type"], "label")
    return encoding.transform(df, st, unseen="unknown")


@register("inverse_label", with_fx("fx_cat") + "SELECT c_custkey, seg FROM fx_cat")
def q_inverse_label(spark, sf):
    df = fx(spark, sf, "fx_cat").select("c_custkey", "seg")
    st = encoding.fit_encoder(df, ["seg"], "label")
    return encoding.inverse_transform(encoding.transform(df, st), st)


def _preprocessor_sql() -> str:
    """Interpolation within each part, then median and quartiles, codes and the mode of the training part."""
    part = f"{md5_sql('event_id', 42)} / 4294967296.0 < 0.2"
    filled = ("CASE WHEN value IS NOT NULL THEN value WHEN pp IS NOT NULL AND np IS NOT NULL "
              "THEN pv + (nv - pv) * (pos - pp) / (np - pp) WHEN pp IS NOT NULL THEN pv ELSE nv END")
    before = "(PARTITION BY is_test ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    after = "(PARTITION BY is_test ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    return with_fx("fx_nulls") + f""", p AS (SELECT *, {part} AS is_test,
  ROW_NUMBER() OVER (PARTITION BY {part} ORDER BY ts, event_id) - 1 AS pos FROM fx_nulls),
q AS (SELECT event_id, ts, is_even, value, pos, is_test, COALESCE(event_type, 'Unknown') AS et,
  LAST_VALUE(CASE WHEN value IS NOT NULL THEN pos END IGNORE NULLS) OVER {before} AS pp, LAST_VALUE(value IGNORE NULLS) OVER {before} AS pv,
  FIRST_VALUE(CASE WHEN value IS NOT NULL THEN pos END IGNORE NULLS) OVER {after} AS np, FIRST_VALUE(value IGNORE NULLS) OVER {after} AS nv FROM p),
f AS (SELECT *, {filled} AS v FROM q),
s AS (SELECT QUANTILE_CONT(v, 0.5) AS m, QUANTILE_CONT(v, 0.75) - QUANTILE_CONT(v, 0.25) AS iqr FROM f WHERE NOT is_test),
mode AS (SELECT is_even AS e FROM f WHERE NOT is_test AND is_even IS NOT NULL GROUP BY is_even ORDER BY COUNT(*) DESC, is_even LIMIT 1),
codes AS (SELECT et, DENSE_RANK() OVER (ORDER BY et) - 1 AS code FROM (SELECT DISTINCT et FROM f WHERE NOT is_test))
SELECT event_id, ts, {r('(v - m) / iqr', 'value', 4)}, code::INTEGER AS event_type, COALESCE(is_even, e) AS is_even
FROM f CROSS JOIN s CROSS JOIN mode JOIN codes USING (et) WHERE is_test"""


@register("preprocessor", _preprocessor_sql())
def q_preprocessor(spark, sf):
    df = fx(spark, sf, "fx_nulls").select("event_id", "ts", "value", "event_type", "is_even")
    d = splits.train_test(df, "event_id", 0.2, 42, hash_method="md5")
    st = pipeline.fit_preprocessor(d.filter(~F.col("is_test")).drop("is_test"), numeric=["value"],
                                   categorical=["event_type"], exclude=["event_id", "ts"], order_by=["ts", "event_id"])
    return finish(pipeline.apply_preprocessor(d.filter(F.col("is_test")).drop("is_test"), st), 4)


_SETS = """SELECT c_custkey, CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE c_custkey END AS code FROM customer"""


@register("one_hot_sparse", f"""WITH x AS ({_SETS}),
codes AS (SELECT code::VARCHAR AS v, ROW_NUMBER() OVER (ORDER BY code::VARCHAR) - 1 AS i FROM x WHERE code IS NOT NULL)
SELECT c_custkey, CASE WHEN i IS NULL THEN '' ELSE i::VARCHAR END AS indices, COUNT(i) OVER () AS size
FROM x LEFT JOIN codes ON code::VARCHAR = v""")
def q_one_hot_sparse(spark, sf):
    """P12 with as many categories as rows: one column of indices and values."""
    df = fx(spark, sf, "customer").selectExpr("c_custkey", "CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE c_custkey END AS code")
    out = encoding.transform(df, encoding.fit_encoder(df, ["code"], "one_hot", layout="sparse"))
    return out.select("c_custkey", F.array_join(F.col("code.indices").cast("array<string>"), ",").alias("indices"),
                      F.col("code.size").cast("long").alias("size"))


@register("inverse_indicators", "SELECT c_custkey, c_mktsegment, CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE c_custkey::VARCHAR END AS code FROM customer")
def q_inverse_indicators(spark, sf):
    """P16 of indicators, wide and sparse, for all categories."""
    df = fx(spark, sf, "customer").selectExpr("c_custkey", "c_mktsegment", "CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE c_custkey END AS code")
    wide = encoding.fit_encoder(df, ["c_mktsegment"], "one_hot")
    sparse = encoding.fit_encoder(df, ["code"], "one_hot", layout="sparse")
    coded = encoding.transform(encoding.transform(df, wide), sparse)
    return encoding.inverse_transform(encoding.inverse_transform(coded, sparse), wide).select("c_custkey", "c_mktsegment", "code")
