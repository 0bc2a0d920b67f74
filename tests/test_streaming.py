import tempfile

from pyspark.sql import functions as F

from quarry.operators import pipeline
from quarry.streaming import apply_preprocessor_stream

EV = "/root/testdata/sf0.001/events.parquet"


def test_fitted_state_applies_to_a_stream(spark):
    batch = spark.read.parquet(EV).select("event_id", "value", "event_type")
    st = pipeline.fit_preprocessor(batch, numeric=["value"], categorical=["event_type"], exclude=["event_id"])
    src = tempfile.mkdtemp(prefix="quarry-src-") + "/events"
    batch.write.parquet(src)                    # a streaming file source reads a directory
    stream = spark.readStream.schema(batch.schema).parquet(src)
    out = apply_preprocessor_stream(stream, st)
    ckpt = tempfile.mkdtemp(prefix="quarry-stream-")
    q = (out.writeStream.format("memory").queryName("prep_stream").outputMode("append")
         .option("checkpointLocation", ckpt).start())
    q.processAllAvailable()
    q.stop()
    got = spark.table("prep_stream")
    want = pipeline.apply_preprocessor(batch, st)
    diff = got.join(want.select("event_id", F.col("value").alias("v2"), F.col("event_type").alias("e2")), "event_id")
    assert diff.count() == batch.count()
    assert diff.filter((F.abs(F.col("value") - F.col("v2")) > 1e-12) | (F.col("event_type") != F.col("e2"))).count() == 0


def test_stream_refuses_order_dependent_state(spark):
    import pytest
    batch = spark.read.parquet(EV).select("event_id", "ts", "value")
    st = pipeline.fit_preprocessor(batch, numeric=["value"], exclude=["event_id", "ts"], order_by=["ts", "event_id"])
    with pytest.raises(ValueError):
        apply_preprocessor_stream(spark.readStream.schema(batch.schema).parquet(EV), st)
