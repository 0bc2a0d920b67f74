"""Mixing sources to target weights by systematic sampling.

A document's expected copies are its source's target over its source's size.
Along the documents of a source, in order of size, the expected copies are summed
up; with one random offset for each source, a document is emitted once for each
integer that the running sum crosses in it.  So every document is taken
floor or ceil of its expected number of times, and, the order being by size, the
taken words miss the target by little more than the largest document.

The running sum is a position times the expected copies, since these are equal
within a source; positions come from one range shuffle, so a source with a third
of all rows is spread like any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.hashing import TWO_32
from quarry.llm.common import positions

#: Text without [^\x20\x09-\x0D]+ has no words.
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: str = "text") -> Column:
    """Number of words; 0 for a null text."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """(source, source_size, target) from one row (source, source_size) for each source.

    Sources take the weights in turn, in code point order with null last, and
    share ``share`` times all sizes by weight; no target passes ``most`` times
    its source's size, and what that cuts off is shared by weight again until none
    is above: the least level with sum(min(most * size, level * weight)) = total.
    """
    # one row for each source from here on: a mixture has few of them
    n = len(weights)
    turn = Window.orderBy(F.col("source").isNull(), "source")
    weighted = sizes.withColumn("weight", F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(turn) - 1) % n + 1).cast("int")))
    ordered = weighted.withColumn("cap", F.col("source_size") * F.lit(float(most))).withColumn(
        "reach", F.col("cap") / F.col("weight"))
    by_reach = Window.orderBy("reach", F.col("source").isNull(), "source")
    before, on = by_reach.rowsBetween(Window.unboundedPreceding, -1), by_reach.rowsBetween(0, Window.unboundedFollowing)
    level = ((F.lit(float(share)) * F.sum("source_size").over(Window.partitionBy())
              - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(on))
    # the first source, by reach, whose cap its level leaves alone fixes the level; later ones have lower levels
    levels = ordered.withColumn("level", level)
    fixed = F.max(F.when(F.col("level") <= F.col("reach"), F.col("level"))).over(Window.partitionBy())
    return levels.withColumn("target", F.least("cap", F.coalesce(fixed, F.lit(float("inf"))) * F.col("weight"))).select(
        "source", "source_size", "target")


def mixture(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0,
            seed: int = 7, doc_id: str = "doc_id", source: str = "source", text: str = "text",
            keep_text: bool = True) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target`` and ``copies``, how often the mix takes each row.

    A null text has size 0; null sources form one source; documents of size 0
    count in the order like others and take no words.  Rows that are equal in
    source, size and doc_id are told apart by their text, and by nothing where
    that is equal too.  Reruns agree: the offsets hang on ``seed`` and the
    source's name.  Columns of ``docs`` with the names above are replaced.
    """
    made = ("size", "source_size", "target", "copies", "_source", "_position", "_text")
    docs = docs.drop(*[c for c in made if c not in (doc_id, source, text)])
    sized = docs.withColumn("size", word_count(text)).withColumn("_source", F.col(source)).withColumn(
        "_text", F.xxhash64(text))
    sized = sized if keep_text else sized.drop(text)  # then no text is shuffled
    sizes = sized.groupBy(F.col("_source").alias("source")).agg(F.sum("size").alias("source_size"))
    aims = targets(sizes, weights, share, most)
    aims = aims.select(F.col("source").alias("_aim"), "source_size", "target")
    ranked = positions(sized, ["_source"], ["size", doc_id, "_text"], "_position")
    mixed = ranked.join(F.broadcast(aims), F.col("_source").eqNullSafe(F.col("_aim")))  # one row for each source
    name = F.concat_ws("|", F.coalesce("_source", F.lit("")), F.lit(str(seed)))
    offset = F.conv(F.substring(F.md5(name.cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(TWO_32)
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    crossed = F.floor(offset + (F.col("_position") + 1) * expected) - F.floor(offset + F.col("_position") * expected)
    mixed = mixed.withColumn("copies", F.least(crossed, F.ceil(expected)).cast("long"))
    return mixed.drop("_source", "_aim", "_position", "_text")


def emitted(mixed: DataFrame) -> DataFrame:
    """Each row of ``mixture`` as many times as the mix takes it, without the columns that it added."""
    rows = mixed.filter("copies > 0").withColumn(
        "_copy", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))))
    return rows.drop("_copy", "size", "source_size", "target", "copies")
