"""Helpers shared by the operators: tables, written cuts, global positions."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.session import scratch_folder

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"

#: Rows and bytes in one Arrow batch at most: texts can be long, so batches stay small. A longer row is a batch of its own.
BATCH_ROWS, BATCH_BYTES = 1024, 4 << 20
#: Bytes of texts that a function over texts gets at once, as its words take many times their size; a longer text goes alone.
PIECE_BYTES = 256 << 10


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _bytes(size: str) -> int:
    """Bytes of a size as Spark's settings give it: 67108864b, 64m, 1gb."""
    number = size.strip().lower().removesuffix("b")
    return int(number.rstrip("kmgtp")) << 10 * (" kmgtp".find(number[-1]) if number[-1].isalpha() else 0)


def small_batches(spark: SparkSession) -> None:
    """Lower the Arrow batch size where texts travel to Python workers."""
    now = int(spark.conf.get(ARROW_ROWS))
    if now <= 0 or now > BATCH_ROWS:
        spark.conf.set(ARROW_ROWS, str(BATCH_ROWS))
    now = _bytes(spark.conf.get(ARROW_BYTES))
    if now <= 0 or now > BATCH_BYTES:
        spark.conf.set(ARROW_BYTES, str(BATCH_BYTES))


def shared_folder(spark: SparkSession) -> str:
    """This application's folder below ``spark.checkpoint.dir``.

    Only a session on one machine may name none (local tests): a scratch folder is set there.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = sc.getConf().get("spark.checkpoint.dir", None)
        sc.setCheckpointDir(named or scratch_folder(spark))
    return sc.getCheckpointDir()


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it again.

    Cuts the lineage: a lost executor costs no earlier stage.  The shuffle
    files of the written plan are released at once.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/cut-{uuid.uuid4().hex}"
    with _setting(spark, SHUFFLE_CLEANUP, "true"):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def positions(df: DataFrame, within: Sequence[str], order: Sequence[Column | str],
              out: str = "position") -> DataFrame:
    """Gapless 0-based position of each row among the rows equal in ``within``.

    One range shuffle over (within, order), so a group of any size is spread
    over many partitions; then one small table of counts per partition.  Nulls
    in ``within`` form a group.  Rows equal in ``order`` follow each other in
    any order, so give keys that separate all rows that differ.
    """
    spark = df.sparkSession
    within = list(within)
    keys = [*[F.col(c) for c in within], *[F.col(c) if isinstance(c, str) else c for c in order]]
    dealt = (df.repartitionByRange(shuffle_partitions(spark), *keys).sortWithinPartitions(*keys)
             .withColumn("_m", F.monotonically_increasing_id())
             .withColumn("_part", F.shiftright("_m", 33).cast("long"))
             .withColumn("_at", F.col("_m").bitwiseAND(F.lit(2 ** 33 - 1))).drop("_m"))
    dealt = cut(dealt)
    counts = dealt.groupBy("_part", *within).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    running = Window.partitionBy(*within).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = (counts.withColumn("_base", F.coalesce(F.sum("_n").over(running), F.lit(0)) - F.col("_first"))
              .select("_part", *within, "_base"))
    counts = counts.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(["_part", *within])], "_base")
    same = F.lit(True)
    for i, c in enumerate(["_part", *within]):
        same = same & (F.col(c).eqNullSafe(F.col(f"_k{i}")))
    return (dealt.join(counts, same).withColumn(out, F.col("_base") + F.col("_at"))
            .drop("_part", "_at", "_base", *[f"_k{i}" for i in range(len(within) + 1)]))


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run``, a map over batches, that gives freed memory back to the system at its end.

    Python workers serve many tasks and stay for a while, beside those of other functions.
    """
    def whole(batches: Iterator) -> Iterator:
        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
        if trim:
            trim(0)
    return whole


def pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """``batch`` in runs of rows whose last column takes ``PIECE_BYTES`` at most, or of one row."""
    if batch.num_rows < 2 or batch.columns[-1].nbytes <= PIECE_BYTES:
        yield batch
    else:
        half = batch.num_rows // 2
        yield from pieces(batch.slice(0, half))
        yield from pieces(batch.slice(half))


def from_texts(docs: DataFrame, text: str, declared: str, start: Callable[[], Callable[[list], list[pa.Array]]]) -> DataFrame:
    """``docs`` with columns made from each text in the place of the text.

    ``start`` is called in each task and gives the function from a list of
    texts (null: None) to the arrays of the ``declared`` columns.  The other
    columns stay in Arrow, so they pass through unchanged; those that bear a
    declared name are replaced.
    """
    small_batches(docs.sparkSession)
    names = [part.split()[0] for part in declared.split(", ")]
    keep = [c for c in docs.columns if c != text and c not in names]
    kept = docs.select(*keep, F.col(text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = start()
        for b in (piece for batch in batches for piece in pieces(batch)):
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], *made(b.columns[-1].to_pylist())], [*keep, *names])

    before = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1]]
    return kept.mapInArrow(tidy(run), ", ".join([*before, declared]))
