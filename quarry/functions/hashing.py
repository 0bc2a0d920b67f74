"""Deterministic per-row hashes used for shuffling, splitting and sampling.

``xxhash64`` is the production default (JVM-side, fast). ``md5`` gives the
same number in Spark SQL and in other SQL engines, which is what the
oracle checks use:
Spark ``conv(substr(md5(concat_ws('|', k, seed)), 1, 8), 16, 10)``.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_32 = 4294967296.0


def row_hash(keys: Sequence[str] | str, seed: int, method: str = "xxhash64") -> Column:
    """Non-negative 32-bit hash of (keys, seed) as a long."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    if method == "md5":
        s = F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed)))
        return F.conv(F.substring(F.md5(s), 1, 8), 16, 10).cast("long")
    if method == "xxhash64":
        return F.pmod(F.xxhash64(*[F.col(k) for k in keys], F.lit(seed)), F.lit(2 ** 32)).cast("long")
    raise ValueError(f"unknown hash method {method!r}")


def unit_uniform(keys: Sequence[str] | str, seed: int, method: str = "xxhash64") -> Column:
    """Deterministic U[0, 1) per row."""
    return row_hash(keys, seed, method) / F.lit(TWO_32)


def md5_sql(keys: Sequence[str] | str, seed: int) -> str:
    """The same hash in DuckDB SQL (for oracle text)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    inner = ", ".join(f"CAST({k} AS VARCHAR)" for k in keys)
    return f"(('0x' || substr(md5(concat_ws('|', {inner}, '{seed}')), 1, 8))::BIGINT)"
