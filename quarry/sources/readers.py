"""Readers and table tidying."""

from __future__ import annotations

import logging
import os
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger(__name__)

# File extensions understood by the reader.
CSV_EXTENSIONS = (".csv", ".txt", ".tsv")
JSON_EXTENSIONS = (".json",)
PARQUET_EXTENSIONS = (".parquet", ".pq")


class ReadError(RuntimeError):
    """Any failure while reading a table, wrapped with the path."""


def file_type(path: str) -> str | None:
    ext = os.path.splitext(path.rstrip("/"))[1].lower()
    if ext in CSV_EXTENSIONS:
        return "csv"
    if ext in JSON_EXTENSIONS:
        return "json"
    if ext in PARQUET_EXTENSIONS:
        return "parquet"
    return None


def read_table(spark: SparkSession, path: str, sep: str = ",", decimal: str = ".",
               missing_markers: Sequence[str] | None = None, schema: T.StructType | str | None = None,
               fmt: str | None = None, json_array: bool | None = None) -> DataFrame:
    """Read CSV / JSON / Parquet chosen by extension (case-insensitive;
    unknown extensions are read as CSV with a warning). A decimal mark other
    than '.' is handled by reading numbers as text and converting with
    ``try_cast``. Missing markers become NULL. Errors are wrapped in ReadError."""
    kind = fmt or file_type(path)
    if kind is None:
        log.warning("unknown file type for %s; reading as CSV", path)
        kind = "csv"
    try:
        if kind == "parquet":
            df = spark.read.schema(schema).parquet(path) if schema else spark.read.parquet(path)
        elif kind == "json":
            if json_array is None:
                first = spark.read.text(path).filter(F.length(F.trim("value")) > 0).first()
                json_array = bool(first) and first["value"].lstrip().startswith("[")
            rd = spark.read.option("multiLine", bool(json_array))
            df = rd.schema(schema).json(path) if schema else rd.json(path)
        else:
            rd = spark.read.option("header", True).option("sep", sep)
            if schema is not None:
                df = rd.schema(schema).csv(path)
            elif decimal == ".":
                df = rd.option("inferSchema", True).csv(path)
            else:
                df = _decimal_mark(rd.option("inferSchema", False).csv(path), decimal)
        if missing_markers:
            df = null_markers(df, missing_markers)
        df.schema  # force analysis so bad paths fail here
        return df
    except ReadError:
        raise
    except Exception as e:  # noqa: BLE001
        raise ReadError(f"could not read {path}: {e}") from e


def _decimal_mark(df: DataFrame, decimal: str) -> DataFrame:
    """Text columns whose every non-null value parses as a number once the
    decimal mark is replaced become doubles (or longs when integral)."""
    pat = "\\" + decimal if decimal in ".^$|?*+()[]{}\\" else decimal
    conv = {c: F.expr(f"try_cast(regexp_replace(`{c}`, '{pat}', '.') AS DOUBLE)") for c in df.columns}
    # one aggregation decides the type of every column
    checks = df.agg(*[F.sum((F.col(c).isNotNull() & conv[c].isNull()).cast("long")).alias(f"bad{i}")
                      for i, c in enumerate(df.columns)],
                    *[F.sum((conv[c].isNotNull() & (conv[c] != F.floor(conv[c]))).cast("long")).alias(f"frac{i}")
                      for i, c in enumerate(df.columns)],
                    *[F.count(conv[c]).alias(f"num{i}") for i, c in enumerate(df.columns)]).first()
    cols = []
    for i, c in enumerate(df.columns):
        if checks[f"bad{i}"] == 0 and checks[f"num{i}"] > 0:
            cols.append((conv[c] if checks[f"frac{i}"] > 0 else conv[c].cast("long")).alias(c))
        else:
            cols.append(F.col(c))
    return df.select(*cols)


def rename_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rename by position, only when the counts match (order is kept)."""
    names = list(names)
    if len(names) != len(df.columns):
        log.warning("rename skipped: %d names for %d columns", len(names), len(df.columns))
        return df
    return df.toDF(*names)


def drop_unnamed(df: DataFrame) -> DataFrame:
    """Drop index-like columns named ``Unnamed...`` (pandas) or ``_c<N>`` (Spark blank header)."""
    drop = [c for c in df.columns if c.startswith("Unnamed") or (c.startswith("_c") and c[2:].isdigit())]
    return df.drop(*drop)


def null_markers(df: DataFrame, markers: Sequence[str]) -> DataFrame:
    """Replace missing markers by NULL in every column (one projection).
    Markers are compared with the text form of each value, and NaN becomes NULL."""
    markers = [str(m) for m in markers]
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType,)):
            cols.append(F.when(c.isin(markers), F.lit(None)).otherwise(c).alias(f.name))
        elif isinstance(f.dataType, T.NumericType):
            e = F.when(c.cast("string").isin(markers), F.lit(None).cast(f.dataType)).otherwise(c)
            if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
                e = F.when(F.isnan(c), F.lit(None).cast(f.dataType)).otherwise(e)
            cols.append(e.alias(f.name))
        else:
            cols.append(c)
    return df.select(*cols)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Spark treats NaN as a value; map it to NULL on entry."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.when(F.isnan(c), F.lit(None).cast(f.dataType)).otherwise(c).alias(f.name))
        else:
            cols.append(c)
    return df.select(*cols)


def drop_all_null(df: DataFrame) -> DataFrame:
    """Drop rows in which every column is NULL."""
    return df.na.drop(how="all")


_INT_TYPES = [(T.ByteType(), -2 ** 7, 2 ** 7 - 1), (T.ShortType(), -2 ** 15, 2 ** 15 - 1),
              (T.IntegerType(), -2 ** 31, 2 ** 31 - 1), (T.LongType(), -2 ** 63, 2 ** 63 - 1)]
_FLOAT32_MAX = 3.4028234663852886e38


def narrowest_types(df: DataFrame, floats: bool = False) -> dict[str, str]:
    """The narrowest type that holds each integer column (byte/short/int/long), from one
    min/max aggregation; float for doubles only when ``floats`` (range-only check,
    like the reference, so precision may be lost) - off by default."""
    num = [f for f in df.schema.fields if isinstance(f.dataType, (T.IntegralType, T.DoubleType, T.FloatType))]
    if not num:
        return {}
    mm = df.agg(*[F.min(f"`{f.name}`").alias(f"mn{i}") for i, f in enumerate(num)],
                *[F.max(f"`{f.name}`").alias(f"mx{i}") for i, f in enumerate(num)]).first()
    target = {}
    for i, f in enumerate(num):
        lo, hi = mm[f"mn{i}"], mm[f"mx{i}"]
        if lo is None:
            continue
        if isinstance(f.dataType, T.IntegralType):
            target[f.name] = next(t.simpleString() for t, a, b in _INT_TYPES if lo >= a and hi <= b)
        elif floats and isinstance(f.dataType, T.DoubleType) and max(abs(lo), abs(hi)) < _FLOAT32_MAX:
            target[f.name] = "float"
    return target


def with_types(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Columns cast to ``types``; a value that its type can't hold raises (in Spark's ANSI mode)."""
    return df.select(*[F.col(f"`{c}`").cast(types[c]).alias(c) if c in types else F.col(f"`{c}`") for c in df.columns])


def narrow_types(df: DataFrame, floats: bool = False) -> DataFrame:
    """Each column in the narrowest type that holds its values."""
    return with_types(df, narrowest_types(df, floats))
