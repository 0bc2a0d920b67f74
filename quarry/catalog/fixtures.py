"""Derived inputs. The SQL text is the same in Spark SQL and DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

FIXTURES: dict[str, str] = {
    "fx_num": """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
       l_quantity AS qty, l_extendedprice AS price, l_discount + 0.0 AS disc, l_tax + 0.0 AS tax,
       CAST(1.0 AS DOUBLE) AS const_col,
       l_returnflag AS flag3,
       CASE WHEN l_quantity > 30 AND l_discount > 0.04 THEN 1 ELSE 0 END AS y_cls,
       0.8 * l_quantity + 200.0 * l_discount * l_discount - 50.0 * l_tax AS y_reg
FROM lineitem""",
    "fx_nulls": """
SELECT event_id, ts, user_id,
       CASE WHEN event_id % 7 = 0 OR event_id < 3 THEN NULL ELSE value END AS value,
       CASE WHEN event_id % 11 = 0 THEN NULL ELSE event_type END AS event_type,
       CASE WHEN event_id % 13 = 0 THEN NULL ELSE event_id % 2 = 0 END AS is_even
FROM events""",
    "fx_reg": """
SELECT o_orderkey AS id, o_orderpriority AS grp, o_totalprice AS y_true,
       o_totalprice * (0.9 + 0.02 * (o_orderkey % 11)) AS y_pred
FROM orders""",
    "fx_cls": """
SELECT o_orderkey AS id, o_orderpriority AS grp,
       CASE WHEN o_totalprice > 150000 THEN 1 ELSE 0 END AS y_true,
       CASE WHEN o_totalprice + 9000 * (o_orderkey % 13) > 200000 THEN 1 ELSE 0 END AS y_pred,
       LEAST(0.9, GREATEST(0.1, FLOOR(o_totalprice / 30000 + (o_orderkey % 3)) / 10)) AS y_score
FROM orders""",
    "fx_multi": """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, y_true, y_pred,
       s0 / (s0 + s1 + s2) AS p0, s1 / (s0 + s1 + s2) AS p1, s2 / (s0 + s1 + s2) AS p2
FROM (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, y_true, y_pred,
         CAST(CASE WHEN y_pred = 0 THEN 3 ELSE 1 END + (l_partkey % 5) AS DOUBLE) AS s0,
         CAST(CASE WHEN y_pred = 1 THEN 3 ELSE 1 END + (l_suppkey % 4) AS DOUBLE) AS s1,
         CAST(CASE WHEN y_pred = 2 THEN 3 ELSE 1 END + (l_orderkey % 3) AS DOUBLE) AS s2
  FROM (
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
           CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS y_true,
           CASE WHEN l_linenumber % 4 = 0 THEN 0
                WHEN l_returnflag = 'A' THEN 0 WHEN l_returnflag = 'N' THEN 1 ELSE 2 END AS y_pred
    FROM lineitem) a) b""",
    "fx_paired": """
SELECT user_id,
       AVG(CASE WHEN event_type = 'click' THEN value END) AS a,
       AVG(CASE WHEN event_type = 'view' THEN value END) AS b
FROM events GROUP BY user_id
HAVING COUNT(CASE WHEN event_type = 'click' THEN 1 END) > 0
   AND COUNT(CASE WHEN event_type = 'view' THEN 1 END) > 0""",
    "fx_cat": """
SELECT c_custkey, c_mktsegment,
       CASE WHEN c_custkey % 2 = 1 AND c_custkey % 50 = 7 THEN 'NEWSEG' ELSE c_mktsegment END AS seg,
       c_nationkey % 2 AS flag01
FROM customer""",
    "fx_doc": """
SELECT d.doc_id, d.lang, d.n_chars, LENGTH(d.text) - LENGTH(REPLACE(d.text, ' ', '')) AS n_spaces,
       l.quality, l.toxic
FROM documents d JOIN labels l ON d.doc_id = l.doc_id""",
}


def register_tables(spark: SparkSession, sf_dir: str) -> None:
    """Register the parquet tables and the derived inputs as temp views (lazy)."""
    for t in TABLES:
        spark.read.parquet(f"{sf_dir}/{t}.parquet").createOrReplaceTempView(t)
    for name, sql in FIXTURES.items():
        spark.sql(sql).createOrReplaceTempView(name)


def fx(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    register_tables(spark, sf_dir)
    return spark.table(name) if name in FIXTURES or name in TABLES else spark.sql(name)


def with_fx(*names: str) -> str:
    """WITH clause carrying the derived inputs for an oracle query."""
    return "WITH " + ",\n".join(f"{n} AS ({FIXTURES[n]})" for n in names) + "\n"


def finish(df: DataFrame, digits: int = 6, per_column: dict | None = None) -> DataFrame:
    """Round doubles (and normalise -0.0) so engines agree on the last digits;
    ``per_column`` overrides the digits of large-magnitude columns."""
    per_column = per_column or {}
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            d = per_column.get(f.name, digits)
            cols.append((F.round(F.col(f.name).cast("double"), d) + F.lit(0.0)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def r(expr: str, name: str, digits: int = 6) -> str:
    return f"ROUND(CAST({expr} AS DOUBLE), {digits}) + 0.0 AS {name}"
