"""Sinks (S11, S12)."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Metrics / statistics tables as JSON lines (one file per partition)."""
    df.write.mode(mode).json(path)


def save_tables(tables: dict[str, DataFrame], meta: dict, path: str, mode: str = "overwrite") -> None:
    """S12 building block: every state table as parquet under ``path``, plus a
    small JSON manifest written through Spark (works on any Hadoop filesystem)."""
    spark = next(iter(tables.values())).sparkSession if tables else SparkSession.getActiveSession()
    for name, t in tables.items():
        t.write.mode(mode).parquet(f"{path}/{name}")
    spark.createDataFrame([(json.dumps(meta, sort_keys=True),)], "manifest string") \
         .coalesce(1).write.mode(mode).text(f"{path}/_manifest")


def load_tables(spark: SparkSession, path: str) -> tuple[dict[str, DataFrame], dict]:
    meta = json.loads(spark.read.text(f"{path}/_manifest").first()["value"])
    tables = {name: spark.read.parquet(f"{path}/{name}") for name in meta.get("tables", [])}
    return tables, meta
