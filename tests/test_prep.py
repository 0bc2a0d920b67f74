import json
import math
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from quarry.operators import cleaning, encoding, pipeline, scaling
from quarry.sources import readers


def test_robust_scaler_exact_quantiles(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "x double")
    st = scaling.fit_scaler(df, ["x"], "robust")
    assert st.center["x"] == 2.5 and st.scale["x"] == 3.0


def test_constant_column_rules(spark):
    df = spark.createDataFrame([(5.0,), (5.0,)], "x double")
    mm = scaling.transform(df, scaling.fit_scaler(df, ["x"], "min_max")).collect()
    assert all(r["x"] == 0.0 for r in mm)
    sd = scaling.fit_scaler(df, ["x"], "standard")
    assert sd.scale["x"] == 1.0


@pytest.mark.parametrize("method", ["standard", "min_max", "max_abs", "robust", "power", "quantile"])
def test_inverse_of_transform(spark, method):
    df = spark.createDataFrame([(float(v),) for v in [-3.0, -1.0, 0.0, 0.5, 2.0, 7.0, 11.0]], "x double")
    st = scaling.fit_scaler(df, ["x"], method)
    back = scaling.inverse_transform(scaling.transform(df, st), st).collect()
    orig = df.collect()
    assert all(abs(a["x"] - b["x"]) < 1e-6 for a, b in zip(orig, back))


def test_unknown_scaler():
    with pytest.raises(ValueError):
        scaling.fit_scaler(None, ["x"], "nope")


def test_interpolation_edges(spark):
    df = spark.createDataFrame([(1, None), (2, 2.0), (3, None), (4, 6.0), (5, None)], "t int, v double")
    for nb in (1, 3):
        out = {r["t"]: r["v"] for r in cleaning.interpolate(df, ["v"], ["t"], n_buckets=nb).collect()}
        assert out == {1: 2.0, 2: 2.0, 3: 4.0, 4: 6.0, 5: 6.0}


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,)], "v double")
    assert readers.nan_to_null(df).filter(F.col("v").isNull()).count() == 1


def test_mode_ties_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "c string")
    assert cleaning.fit_mode(df, ["c"]) == {"c": "a"}


def test_unseen_category(spark):
    fit = spark.createDataFrame([("x",), ("y",)], "c string")
    new = spark.createDataFrame([("z",)], "c string")
    st = encoding.fit_encoder(fit, ["c"], "label")
    with pytest.raises(Exception):
        encoding.transform(new, st, unseen="unknown").collect()
    fit2 = spark.createDataFrame([("x",), ("Unknown",)], "c string")
    st2 = encoding.fit_encoder(fit2, ["c"], "label")
    assert encoding.transform(new, st2, unseen="unknown").first()["c"] == 0  # 'Unknown' < 'x'


def test_binarizer_two_classes_one_column(spark):
    df = spark.createDataFrame([("n",), ("y",)], "c string")
    out = encoding.transform(df, encoding.fit_encoder(df, ["c"], "binarize"))
    assert out.columns == ["c_y"]


def test_preprocessor_not_fitted(spark):
    df = spark.createDataFrame([(1.0,)], "x double")
    with pytest.raises(pipeline.NotFittedError):
        pipeline.apply_preprocessor(df, pipeline.PreprocessorState())
    assert pipeline.apply_preprocessor(df, None, dry_run=True) is df


def test_preprocessor_save_load(spark):
    df = spark.createDataFrame([(1.0, "a"), (2.0, None), (4.0, "b")], "x double, c string")
    st = pipeline.fit_preprocessor(df, scaler="standard")
    path = tempfile.mkdtemp(prefix="quarry-test-")
    pipeline.save_preprocessor(st, path, spark)
    st2 = pipeline.load_preprocessor(spark, path)
    a = pipeline.apply_preprocessor(df, st).collect()
    b = pipeline.apply_preprocessor(df, st2).collect()
    assert a == b


def test_reader_dispatch(spark):
    d = tempfile.mkdtemp(prefix="quarry-io-")
    p = os.path.join(d, "t.JSON")
    with open(p, "w") as fh:
        json.dump([{"a": 1, "b": "x"}, {"a": 2, "b": "y"}], fh)
    assert readers.read_table(spark, p).count() == 2
    q = os.path.join(d, "t.data")
    with open(q, "w") as fh:
        fh.write("a;b\n1,5;NA\n2,0;x\n")
    df = readers.read_table(spark, q, sep=";", decimal=",", missing_markers=["NA"])
    rows = df.orderBy("a").collect()
    assert rows[0]["a"] == 1.5 and rows[0]["b"] is None
    with pytest.raises(readers.ReadError):
        readers.read_table(spark, os.path.join(d, "missing.parquet"))


def test_narrow_types(spark):
    df = spark.createDataFrame([(1, 100000), (2, -5)], "a long, b long")
    t = readers.narrow_types(df).schema
    assert t["a"].dataType.simpleString() == "tinyint" and t["b"].dataType.simpleString() == "int"


def test_interpolation_by_any_number_of_buckets(spark):
    rows = [(g, t, None if t % 3 == 0 else float(t * (g + 1))) for g in range(3) for t in range(30)]
    df = spark.createDataFrame(rows, "g int, t int, v double")
    a = {(r["g"], r["t"]): r["v"] for r in cleaning.interpolate(df, ["v"], ["t"], ["g"], n_buckets=4).collect()}
    b = {(r["g"], r["t"]): r["v"] for r in cleaning.interpolate(df, ["v"], ["t"], ["g"], n_buckets=1).collect()}
    assert a == b and all(v is not None for v in a.values())
