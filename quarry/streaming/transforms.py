"""Fitted state applied to streaming DataFrames.

The reference has no streaming. What carries over is that every fitted
row-wise transform here is a projection (scalers, encoders, value maps,
fills with stored values) or a per-batch Arrow map (forest / SVR scoring), so
the same state applies to a ``readStream`` source unchanged. Interpolation
(P1) needs an order over the whole input and is refused on a stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from quarry.operators import experiments, pipeline


def apply_preprocessor_stream(stream: DataFrame, state: pipeline.PreprocessorState) -> DataFrame:
    if state.order_by:
        raise ValueError("interpolation by row order is not defined on an unbounded stream; "
                         "fit the preprocessor without order_by for streaming use")
    return pipeline.apply_preprocessor(stream, state)


def predict_stream(stream: DataFrame, bundle: experiments.Bundle) -> DataFrame:
    """Score a stream with a fitted bundle (preprocessor + model)."""
    if bundle.prep is not None and bundle.prep.order_by:
        raise ValueError("the bundle's preprocessor interpolates by row order; not usable on a stream")
    return experiments.predict(stream, bundle)
