"""Conversations as training sequences that share their common beginnings.

Method: a prefix tree.  Conversations that start with the same turns share the
nodes of those turns; a tree's nodes are put in depth-first order, each turn once,
and each node tells the position id of its first character and the intervals of
the sequence (its ancestors) that it attends to.

Nothing holds a whole tree.  A turn's node is named by a running digest of its
conversation up to that turn; depth-first order is the order of the paths of
names, found by one range shuffle, in which a conversation adds the turns that it
doesn't share with the one before it.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import cut, shuffle_partitions, small_batches

LEARNED_ROLE = "assistant"
#: A turn is OPEN role AFTER_ROLE text CLOSE, role and text escaped.
OPEN, AFTER_ROLE, CLOSE = "### ", ": ", "</turn>\n"
#: What a text may not hold: OPEN's mark and CLOSE's tag, and the escape itself; in a role also the colon.
CONTROL = r"(\\|#(?=##)|<(?=/turn>))"
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
NAME_BYTES = 16


def escape(text: Column) -> Column:
    """``text`` without unescaped control strings: a backslash before the first character of each."""
    return F.regexp_replace(text, CONTROL, r"\\$1")


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def _named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The running digest and length of each conversation, whose turns follow each other."""
    now, digest, depth, position, parent = (), None, 0, 0, b""
    for b in batches:
        names, parents, depths, starts = [], [], [], []
        for conv, turn, chars in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist()):
            if now != (conv,):
                now, digest, depth, position, parent = (conv,), hashlib.sha256(), 0, 0, b""
            text = turn.as_buffer()
            digest.update(text.size.to_bytes(8, "big"))
            digest.update(text)
            depth += 1
            names.append(digest.digest()[:NAME_BYTES])
            parents.append(parent)
            depths.append(depth)
            starts.append(position)
            parent, position = names[-1], position + chars
        yield pa.RecordBatch.from_arrays([*b.columns, *[pa.array(x, t) for x, t in (
            (names, pa.binary()), (parents, pa.binary()), (depths, pa.int32()), (starts, pa.int64()))]],
            [*b.schema.names, "name", "parent", "depth", "position"])


def formatted_turns(conversations: DataFrame) -> DataFrame:
    """One row per turn: conv_id, ``text`` (formatted), ``chars``, where its learned text lies in it, name and position.

    ``name`` stands for the conversation up to and with the turn, ``parent`` for
    that before it (empty: none); ``position`` counts the characters before it.
    A conversation is read in order by one task, in constant memory.
    """
    small_batches(conversations.sparkSession)
    role, said = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    head = F.concat(F.lit(OPEN), F.regexp_replace(escape(role), "(:)", r"\\$1"), F.lit(AFTER_ROLE))
    text = F.concat(head, escape(said), F.lit(CLOSE))
    rows = (conversations.select("conv_id", "turn", "role", F.col("text").alias("said"), text.alias("text"),
                                 F.when(role == LEARNED_ROLE, F.char_length(head)).alias("learned"))
            .repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "said")
            .select("conv_id", "text", F.char_length("text").alias("chars"), "learned"))
    kind = rows.schema["conv_id"].dataType.simpleString()
    return rows.mapInArrow(_named, f"conv_id {kind}, text string, chars int, learned int, name binary, parent binary, depth int, position long")


def _depth_first(turns: DataFrame) -> DataFrame:
    """One row per different conversation, in depth-first order: its ``path``, how many turns it shares with those
    before it, and the place and start in the tree's sequence of its first other turn."""
    step = F.struct("depth", "name", "position", "chars")
    whole = (turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(step)).alias("steps"))
             .select(F.element_at("steps", -1)["name"].alias("leaf"), "steps")
             .groupBy("leaf").agg(F.first("steps").alias("steps"))
             .select("leaf", F.col("steps.name").alias("path"), F.col("steps.position").alias("position"),
                     (F.element_at("steps.position", -1) + F.element_at("steps.chars", -1)).alias("total")))
    n = shuffle_partitions(turns.sparkSession)
    dealt = cut(whole.repartitionByRange(n, "path").sortWithinPartitions("path").withColumn("at", F.monotonically_increasing_id()))
    dealt = dealt.withColumn("block", F.shiftright("at", 33))
    # the conversation before the first one of a block is the last one of the block before
    last = dealt.groupBy("block").agg(F.max_by("path", "at").alias("path"))
    last = last.select(F.lead("block").over(Window.orderBy("block")).alias("block"), F.col("path").alias("path_before"))
    before = F.coalesce(F.lag("path").over(Window.partitionBy("block").orderBy("at")), F.col("path_before"))
    rows = dealt.join(F.broadcast(last), "block", "left").withColumn("before", before)
    # equal names at a place mean equal turns up to it
    same = F.zip_with("path", F.slice("before", F.lit(1), F.size("path")), lambda a, b: a == b)
    rows = rows.withColumn("shared", F.when(F.col("before").isNull(), F.lit(0)).otherwise(
        F.size(F.filter(same, lambda x: x)))).drop("before", "path_before")
    rows = rows.withColumn("tree", F.get("path", F.lit(0))).withColumn("new_turns", (F.size("path") - F.col("shared")).cast("long"))
    rows = rows.withColumn("new_chars", F.col("total") - F.get("position", F.col("shared")))
    own = Window.partitionBy("block", "tree").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("tree").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy("block", "tree").agg(F.sum("new_turns").alias("t"), F.sum("new_chars").alias("c"))
    none = F.lit(0).cast("long")
    sums = sums.select("block", "tree", F.coalesce(F.sum("t").over(earlier), none).alias("t"), F.coalesce(F.sum("c").over(earlier), none).alias("c"))
    rows = rows.withColumn("_t", F.coalesce(F.sum("new_turns").over(own), none)).withColumn("_c", F.coalesce(F.sum("new_chars").over(own), none))
    return cut(rows.join(sums, ["block", "tree"]).select("leaf", "path", "position", "shared", "tree", (F.col("_t") + F.col("t")).alias("first_place"),
                                                         (F.col("_c") + F.col("c")).alias("first_start")))


def prefix_trees(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, ends) of the prefix trees of ``conversations`` (conv_id, turn, role, text).

    ``nodes``, one row per different beginning of a conversation, that is per
    turn that is emitted: ``tree`` (binary name), ``place`` (from 0, depth
    first) and ``start`` (character) in the tree's sequence, ``chars``,
    ``position`` (the position id of its first character, which counts
    ancestors only; ids rise by one), ``text`` (formatted), ``attends``: the
    intervals [start, end) of its ancestors and their places [first, last], in
    order, neighbours joined; within itself a node is causal.  ``loss_start``
    and ``loss_end`` delimit an assistant's text in the sequence, else null.
    ``ends``: conv_id with the ``tree`` and ``place`` of its last turn.

    A null role or text counts as empty; a null conv_id is a conversation; turns
    are ordered by (turn, role, text), nulls first, and repeated rows are turns
    of their own.  Equal conversations share their end.  An empty table gives
    empty tables; further columns are not read.
    """
    turns = cut(formatted_turns(conversations))
    order = _depth_first(turns)
    steps = order.select("leaf", "shared", "tree", "first_place", "first_start", F.posexplode(F.arrays_zip("path", "position")).alias("i", "step"),
                         F.get("position", F.col("shared")).alias("base"))
    new = steps.filter(F.col("i") >= F.col("shared")).select(
        "leaf", "tree", F.col("step.path").alias("name"), (F.col("first_place") + F.col("i") - F.col("shared")).alias("place"),
        (F.col("first_start") + F.col("step.position") - F.col("base")).alias("start"), (F.col("i") == F.col("shared")).alias("branches"),
        "first_place", "first_start")
    texts = turns.groupBy("name").agg(*[F.first(c).alias(c) for c in ("text", "chars", "learned", "position")])
    nodes = cut(new.join(texts, "name"))
    # the shared turns of each conversation, as runs of places that follow each other
    shared = (steps.filter(F.col("i") < F.col("shared")).select("leaf", "i", F.col("step.path").alias("name"))
              .join(nodes.select("name", "place", "start", "chars"), "name"))
    runs = (shared.groupBy("leaf", (F.col("place") - F.col("i")).alias("run"))
            .agg(F.min("start").alias("start"), F.max(F.col("start") + F.col("chars")).alias("end"),
                 F.min("place").alias("first"), F.max("place").alias("last"))
            .groupBy("leaf").agg(F.sort_array(F.collect_list(F.struct("start", "end", "first", "last"))).alias("runs")))
    own = F.array(F.struct(F.col("first_start").alias("start"), F.col("start").alias("end"),
                           F.col("first_place").alias("first"), (F.col("place") - 1).alias("last")))
    kept, tail = F.coalesce("runs", F.slice(own, 1, 0)), F.get("runs", F.size("runs") - 1)
    joins = tail["end"] == F.col("first_start")
    grown = F.concat(F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(0))), F.array(F.struct(
        tail["start"].alias("start"), F.col("start").alias("end"), tail["first"].alias("first"), (F.col("place") - 1).alias("last"))))
    attends = F.when(F.col("branches"), kept).when(joins, grown).otherwise(F.concat(kept, own))
    learned_end = F.col("start") + F.col("chars") - F.lit(len(CLOSE))
    table = nodes.join(runs, "leaf", "left").select(
        "tree", "place", "start", F.col("chars").cast("long").alias("chars"), "position", "text", attends.alias("attends"),
        (F.col("start") + F.col("learned")).alias("loss_start"), F.when(F.col("learned").isNotNull(), learned_end).alias("loss_end"), "name")
    table = cut(table)
    ends = (turns.groupBy("conv_id").agg(F.max_by("name", "depth").alias("name"))
            .join(table.select("name", "tree", "place"), "name").select("conv_id", "tree", "place"))
    return table.drop("name"), ends


#: One turn, as the template writes it.
_TURN = re.compile(re.escape(OPEN) + r"((?:[^\\:]|\\.)*)" + re.escape(AFTER_ROLE) + r"([^\\]*(?:\\.[^\\]*)*)" + re.escape(CLOSE) + r"\Z", re.DOTALL)


def parse_turn(text: str) -> tuple[str, str]:
    """Role and text of a formatted turn."""
    role, said = _TURN.match(text).groups()
    return unescape(role), unescape(said)


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of each sequence of turns; the turns of one follow each other."""
    names = ["tree", "place", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.binary(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    now, n, turns, learned, loss, chars = None, 0, None, 0, None, 0

    def told(found: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*found), kinds)], names)

    for b in batches:
        found = []
        for tree, end, text, start, loss_start, loss_end in zip(*(c.to_pylist() for c in b.columns)):
            if now != (tree, end):
                if now:
                    found.append((*now, n, turns.hexdigest(), learned, loss.hexdigest(), chars))
                now, n, turns, learned, loss, chars = (tree, end), 0, hashlib.sha256(), 0, hashlib.sha256(), 0
            role, said = parse_turn(text)
            turns.update(f"{role}\n{said}\n".encode())
            if loss_start is not None:
                under = unescape(text[loss_start - start:loss_end - start])
                learned += len(under)
                loss.update(under.encode())
            n, chars = n + 1, chars + len(text)
        if found:
            yield told(found)
    if now:
        yield told([(*now, n, turns.hexdigest(), learned, loss.hexdigest(), chars)])


def read_back(nodes: DataFrame, ends: DataFrame) -> DataFrame:
    """One row per conversation, from the trees alone: its turns and what the loss mask covers, as digests.

    Each different end is read once, by the places that its node attends to and
    its own; a conversation's turns pass one task in order, in constant memory.
    """
    small_batches(nodes.sparkSession)
    leaves = ends.select("tree", "place").distinct().join(nodes.select("tree", "place", "attends"), ["tree", "place"])
    places = F.flatten(F.transform("attends", lambda r: F.sequence(r["first"], r["last"])))
    wanted = leaves.select("tree", F.col("place").alias("end"), F.explode(F.concat(places, F.array("place"))).alias("place"))
    rows = (wanted.join(nodes.select("tree", "place", "text", "start", "loss_start", "loss_end"), ["tree", "place"])
            .repartition("tree", "end").sortWithinPartitions("tree", "end", "place")
            .select("tree", "end", "text", "start", "loss_start", "loss_end"))
    told = rows.mapInArrow(_read_back, "tree binary, place long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
                                       "formatted_chars long")
    return ends.join(told, ["tree", "place"]).drop("tree", "place")
