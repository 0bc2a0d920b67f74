"""Sharding by longest-processing-time scheduling: heaviest first, to the least-loaded shard.

Documents with equal texts must stay together, so groups of equal texts are what
is scheduled.  A heap over all groups would pass the corpus through the driver.
Instead groups that weigh more than a small part of a shard (at most
``shards * grain`` of them, by arithmetic) are scheduled one by one, and all
lighter ones in ``bundles`` fixed by a hash of their key; the driver's heap holds
these bounded few.  With more bundles than groups this is the plain schedule.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import positions

#: Bytes that each document weighs beside its text.
ROW_BYTES = 16


def schedule(weights: list[tuple[int, str]], shards: int) -> dict[str, int]:
    """Shard of each (weight, name): by falling weight, then name, to the shard with the least load, then number."""
    loads = [(0, s) for s in range(shards)]
    out = {}
    for weight, name in sorted(weights, key=lambda x: (-x[0], x[1])):
        load, shard = heapq.heappop(loads)
        out[name] = shard
        heapq.heappush(loads, (load + weight, shard))
    return out


def shard(docs: DataFrame, shards: int = 40, grain: int = 200, bundles: int = 16_384,
          doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the text, with ``size``, ``text_crc32``, ``shard`` and ``slot``.

    ``size``: UTF-8 bytes of the text plus 16; a null text weighs and groups like
    an empty one.  Groups of equal texts stay together, even one that weighs more
    than a shard's part.  ``slot`` counts the rows of a shard from 0, by doc_id
    (null first); repeated rows take a slot each.  Reruns agree.  Columns of
    ``docs`` with these names are replaced; no rows give no rows.
    """
    spark = docs.sparkSession
    added = ("size", "text_crc32", "shard", "slot", "_key", "_bundle", "_name")
    docs = docs.drop(*[c for c in added if c not in (doc_id, text)])
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = docs.withColumns({
        "size": F.octet_length(body).cast("long") + ROW_BYTES, "text_crc32": F.crc32(body),
        "_key": F.sha2(body, 256)}).drop(text)
    rows = rows.withColumn("_bundle", F.concat(F.lit("b"), F.pmod(F.xxhash64("_key"), F.lit(bundles))))
    groups = rows.groupBy("_key", "_bundle").agg(F.sum("size").alias("weight"))
    total = rows.agg(F.sum("size")).first()[0] or 0
    heavy = F.col("weight") > total / (shards * grain)  # so at most shards * grain groups
    units = groups.groupBy(F.when(heavy, F.col("_key")).otherwise(F.col("_bundle")).alias("_name")).agg(
        F.sum("weight").alias("weight"))
    plan = schedule([(r.weight, r._name) for r in units.collect()], shards)  # shards * grain + bundles rows at most
    known = spark.createDataFrame(list(plan.items()) or [("", 0)], "_name string, shard int")
    by_key = known.filter(F.length("_name") == 64).select(F.col("_name").alias("_key"), F.col("shard").alias("_own"))
    by_bundle = known.filter(F.length("_name") < 64).select(F.col("_name").alias("_bundle"), F.col("shard").alias("_shared"))
    placed = (rows.join(F.broadcast(by_key), "_key", "left").join(F.broadcast(by_bundle), "_bundle", "left")
              .withColumn("shard", F.coalesce("_own", "_shared")).drop("_bundle", "_own", "_shared"))
    return positions(placed, ["shard"], [F.col(doc_id), F.col("_key")], "slot").drop("_key")
