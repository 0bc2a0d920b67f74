"""Parallelism guard for CPU-heavy operators."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, factor: int = 2) -> DataFrame:
    """Round-robin repartition when the frame is read from fewer files than the
    cluster can run tasks (for example one small file = one task). Input of many
    files, and frames that aren't read from files, stay as they are. Judged by the
    scan's number of files, so no stage runs for it and no name leaves the file
    index; it never changes a result."""
    files = len(df._jdf.inputFiles())
    par = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(par * factor) if 0 < files < par else df
