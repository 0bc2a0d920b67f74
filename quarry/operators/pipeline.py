"""Preprocessor (P17): nulls -> value map -> scale -> encode -> narrow.

``fit_preprocessor`` runs one aggregation per kind of state (modes, scaler
moments/quantiles, category lists) and keeps only small state;
``apply_preprocessor`` is a chain of projections (plus the interpolation
windows when an order is given).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Mapping, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from quarry.operators import cleaning, encoding, scaling
from quarry.sources import readers, writers


class NotFittedError(RuntimeError):
    pass


@dataclass
class PreprocessorState:
    numeric: list = field(default_factory=list)
    categorical: list = field(default_factory=list)
    other: list = field(default_factory=list)
    value_map: dict = field(default_factory=dict)
    modes: dict = field(default_factory=dict)
    order_by: list | None = None
    nan_category: str = cleaning.NAN_CATEGORY
    scaler: scaling.ScalerState | None = None
    encoder: encoding.EncoderState | None = None
    unseen: str = "unknown"
    narrow: bool = False
    types: dict = field(default_factory=dict)   # narrow: column -> type, from the rows of the fit
    fitted: bool = False


def _roles(df: DataFrame, numeric, categorical, exclude):
    ex = set(exclude or [])
    num = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in ex]
    cat = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in ex]
    other = [f.name for f in df.schema.fields
             if f.name not in ex and f.name not in num and f.name not in cat]
    # requested columns that do not exist or have the wrong type are skipped
    num = [c for c in numeric if c in num] if numeric is not None else num
    cat = [c for c in categorical if c in cat] if categorical is not None else cat
    return num, cat, other


def _clean(df: DataFrame, st: PreprocessorState) -> DataFrame:
    df = readers.nan_to_null(df)
    if st.order_by and st.numeric:
        df = cleaning.interpolate(df, [c for c in st.numeric if c in df.columns], st.order_by)
    df = cleaning.fill_category(df, [c for c in st.categorical if c in df.columns], st.nan_category)
    df = cleaning.fill_mode(df, [c for c in st.modes if c in df.columns], st.modes)
    if st.value_map:
        df = cleaning.map_values(df, st.value_map)
        df = cleaning.fill_category(df, [c for c in st.value_map if c in df.columns], st.nan_category)
    return df


def fit_preprocessor(df: DataFrame, numeric: Sequence[str] | None = None,
                     categorical: Sequence[str] | None = None, exclude: Sequence[str] = (),
                     scaler: str = scaling.DEFAULT_SCALER, encoder: str = encoding.DEFAULT_ENCODER,
                     value_map: Mapping[str, Mapping] | None = None, order_by: Sequence | None = None,
                     nan_category: str = cleaning.NAN_CATEGORY, unseen: str = "unknown",
                     narrow: bool = False, encoder_layout: str = "wide") -> PreprocessorState:
    num, cat, other = _roles(df, numeric, categorical, exclude)
    vm = dict(value_map or {})
    # value-mapped numeric columns become categories
    num = [c for c in num if c not in vm]
    cat = cat + [c for c in vm if c in df.columns and c not in cat]
    st = PreprocessorState(numeric=num, categorical=cat, other=other, value_map=vm,
                           order_by=list(order_by) if order_by else None, nan_category=nan_category,
                           unseen=unseen, narrow=narrow)
    if other:
        st.modes = cleaning.fit_mode(df, other)
    clean = _clean(df, st)
    if num:
        st.scaler = scaling.fit_scaler(clean, num, scaler)
    if cat:
        st.encoder = encoding.fit_encoder(clean, cat, encoder, nan_category, encoder_layout)
    st.fitted = True
    if narrow:
        st.types = readers.narrowest_types(_transformed(df, st))
    return st


def _transformed(df: DataFrame, st: PreprocessorState) -> DataFrame:
    out = _clean(df, st)
    if st.scaler is not None:
        out = scaling.transform(out, st.scaler)
    return out if st.encoder is None else encoding.transform(out, st.encoder, st.unseen)


def apply_preprocessor(df: DataFrame, st: PreprocessorState, dry_run: bool = False) -> DataFrame:
    if dry_run:
        return df
    if st is None or not st.fitted:
        raise NotFittedError("preprocessor is not fitted")
    return readers.with_types(_transformed(df, st), st.types) if st.narrow else _transformed(df, st)


def fit_transform(df: DataFrame, **kw) -> tuple[DataFrame, PreprocessorState]:
    st = fit_preprocessor(df, **kw)
    return apply_preprocessor(df, st), st


def inverse_transform(df: DataFrame, st: PreprocessorState, cols: Sequence[str] | None = None) -> DataFrame:
    """Inverse for one, several or all fitted columns."""
    if not st.fitted:
        raise NotFittedError("preprocessor is not fitted")
    if st.scaler is not None:
        sc = [c for c in (cols or st.numeric) if c in st.numeric]
        if sc:
            df = scaling.inverse_transform(df, st.scaler, sc)
    if st.encoder is not None:
        ec = [c for c in (cols or st.categorical) if c in st.categorical]
        if ec:
            df = encoding.inverse_transform(df, st.encoder, ec)
    return df


# ----------------------------------------------------------------------------- S12 persistence

def state_tables(spark: SparkSession, st: PreprocessorState) -> tuple[dict[str, DataFrame], dict]:
    tables = {}
    if st.scaler is not None:
        tables["scaler"] = st.scaler.to_table(spark)
    if st.encoder is not None:
        tables["encoder"] = encoding.encoder_table(spark, st.encoder)
    meta = dict(numeric=st.numeric, categorical=st.categorical, other=st.other,
                value_map={c: {str(k): str(v) for k, v in m.items()} for c, m in st.value_map.items()},
                modes={c: (v.isoformat() if hasattr(v, "isoformat") else v) for c, v in st.modes.items()},
                order_by=st.order_by, nan_category=st.nan_category, unseen=st.unseen, narrow=st.narrow,
                types=st.types, encoder_method=st.encoder.method if st.encoder else None,
                encoder_layout=st.encoder.layout if st.encoder else None, tables=sorted(tables))
    return tables, meta


def state_from_tables(tables: dict[str, DataFrame], meta: dict) -> PreprocessorState:
    st = PreprocessorState(numeric=meta["numeric"], categorical=meta["categorical"], other=meta["other"],
                           value_map=meta["value_map"], modes=meta["modes"], order_by=meta["order_by"],
                           nan_category=meta["nan_category"], unseen=meta["unseen"], narrow=meta["narrow"],
                           types=meta["types"], fitted=True)
    if "scaler" in tables:
        st.scaler = scaling.ScalerState.from_rows(tables["scaler"].collect())
    if "encoder" in tables:
        st.encoder = encoding.encoder_from_table(tables["encoder"], meta["encoder_method"], meta["nan_category"],
                                                 meta["categorical"], meta["encoder_layout"])
    return st


def save_preprocessor(st: PreprocessorState, path: str, spark: SparkSession) -> None:
    tables, meta = state_tables(spark, st)
    if tables:
        writers.save_tables(tables, meta, path)
    else:
        import json
        spark.createDataFrame([(json.dumps(meta, sort_keys=True),)], "manifest string") \
             .coalesce(1).write.mode("overwrite").text(f"{path}/_manifest")


def load_preprocessor(spark: SparkSession, path: str) -> PreprocessorState:
    tables, meta = writers.load_tables(spark, path)
    return state_from_tables(tables, meta)
