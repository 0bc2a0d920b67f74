"""Removal of repeated passages by blockwise suffix sorting with a difference cover.

A byte goes if it lies in a string of ``length`` bytes that also starts in a document
with a smaller doc_id.  So suffixes are sorted by their first ``length`` bytes, and
each group of equals needs its least document.

Method (after Kärkkäinen, "Fast BWT in small space by blockwise suffix sorting", 2007).
The cover is a set of residues such that any two positions have a common offset,
below the period, at which both are sample positions.

1. Cover samples.  The string that follows each sample position, as long as every
   offset leaves room for, gets its name; names are sorted one bucket at a time, and
   one bit for each says whether another document block, or another place in the
   block, has it.  A suffix with no shared sample ahead has no equal, and is done.
2. Suffix buckets.  The other suffixes are sorted one bucket at a time by the name of
   their first ``length`` bytes, so a long tie costs no comparison of bytes.  Each
   group's least document is found; one bit for each suffix says whether a smaller
   document than any of its own block has it.
3. The bits go back to the blocks, which mark and remove bytes.

Names are 80-bit fingerprints instead of the ranks that a recursive sort would give,
since only equality is asked for.  Documents lie in blocks of bounded size (very long
ones in overlapping pieces).  A block sends each name once, so a passage that a third
of all documents share is one entry for each block; a bucket holds a bounded number
of entries (``BUCKET_NAMES``); answers are one bit for each entry.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import cut, shuffle_partitions, small_batches
from quarry.llm.words import mix

#: Period of each cover -> its residues, whose differences are all residues (perfect difference sets).
COVERS = {7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (3, 6, 7, 12, 14), 31: (1, 5, 11, 24, 25, 27)}
#: Bytes of a block; a longer document is cut into pieces of so many.
BLOCK_BYTES = 2 << 20
#: Compression of a block's text, which is written once and shuffled twice.
TEXT_LEVEL = 5
#: Names in a bucket on average, at most.
BUCKET_NAMES = 4_000_000

_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BYTE2 = mix(np.arange(1001, 1257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_BASE = np.uint64(0xD1342543DE82EF95)


def cover_for(length: int) -> tuple[int, tuple[int, ...]]:
    """The longest period that leaves names of six tenths of ``length``: a short name is shared by chance, and
    then the suffixes around it are sorted for nothing."""
    if length < 10:
        raise ValueError(f"passages of {length} bytes are too short; 10 is the least")
    period = max((p for p in COVERS if 10 * (length - p + 1) >= 6 * length), default=min(COVERS))
    return period, COVERS[period]


class Runs:
    """Polynomial fingerprints of the runs of 1, 2, 4 and more values, of which those of any length up to ``length``
    are put together, at the wanted places only."""

    def __init__(self, values: np.ndarray, length: int, base: np.uint64):
        self.run, self.power, size = {1: values}, {1: base}, 1
        with np.errstate(over="ignore"):
            while 2 * size <= length and 2 * size <= len(values):
                run, power = self.run[size], self.power[size]
                self.run[2 * size], self.power[2 * size] = run[:-size] * power + run[size:], power * power
                size *= 2

    def names(self, at: np.ndarray, length: int) -> np.ndarray:
        """Mixed fingerprints of the ``length`` values from each place."""
        done, out = 0, np.zeros(len(at), np.uint64)
        with np.errstate(over="ignore"):
            for size in self.run:
                if length & size:
                    part = self.run[size][at + done]
                    out = out * self.power[size] + part if done else part
                    done += size
        return mix(out)


def names(values: np.ndarray, length: int, base: np.uint64) -> np.ndarray:
    """Mixed polynomial fingerprint of each run of ``length`` values."""
    at = np.arange(max(0, len(values) - length + 1))
    return Runs(values, length, base).names(at, length) if len(at) else np.empty(0, np.uint64)


def tags(data: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """16 bits of a second fingerprint of the ``length`` bytes from each place: its words, each by a factor of its own.
    The last word may overlap the one before."""
    if not len(at):
        return np.empty(0, np.uint16)
    words = np.lib.stride_tricks.sliding_window_view(data, 8)
    out = np.zeros(len(at), np.uint64)
    with np.errstate(over="ignore"):
        for k, shift in enumerate([*range(0, length - 8, 8), length - 8]):
            word = np.ascontiguousarray(words[at + shift]).view(np.uint64)[:, 0]
            out = (out + word) * _BYTE2[k]
    return (mix(out) >> np.uint64(48)).astype(np.uint16)


@dataclass
class Block:
    """Pieces of documents one after the other."""

    doc: np.ndarray      # doc_id of each piece
    size: np.ndarray     # bytes of each piece, overlap included
    own: np.ndarray      # of these the first so many are the piece's own
    data: np.ndarray     # all bytes

    def ends(self) -> np.ndarray:
        return np.cumsum(self.size)

    def runs(self, length: int) -> Runs:
        return Runs(_BYTE[self.data], length, _BASE)

    def samples(self, length: int, runs: Runs) -> tuple[np.ndarray, np.ndarray]:
        """Sample positions and their names."""
        period, cover = cover_for(length)
        room = length - period + 1
        last = len(self.data) - room + 1
        at = (np.arange(0, max(last, 0) + period, period)[:, None] + np.array(cover)).ravel()
        at = at[at < last]
        at = at[at + room <= self.ends()[self.piece_of(at)]]
        return at, runs.names(at, room)

    def piece_of(self, at: np.ndarray) -> np.ndarray:
        """The piece of each position, for rising positions."""
        first = np.searchsorted(at, self.ends() - self.size)
        return np.repeat(np.arange(len(self.size)), np.diff(np.r_[first, len(at)]))

    def suffixes(self, length: int, shared: np.ndarray) -> "Suffixes":
        """The suffixes ahead of which a sample is ``shared`` (one flag for each distinct sample name, in order)."""
        period, _ = cover_for(length)
        runs = self.runs(length)
        at, sample = self.samples(length, runs)
        order = np.argsort(sample)
        new = np.r_[True, sample[order][1:] != sample[order][:-1]][:len(sample)]
        good = np.sort(at[order[shared[np.cumsum(new) - 1]]]) if len(at) else at
        n = max(0, len(self.data) - length + 1)
        # a shared sample vouches for the suffixes of the last period up to it
        low, high = np.maximum(good - period + 1, 0), np.minimum(good + 1, n)
        step = np.bincount(low[low < n], minlength=n + 1) - np.bincount(np.maximum(high, 0), minlength=n + 1)[:n + 1]
        take = np.flatnonzero(np.cumsum(step)[:n] > 0)
        piece = self.piece_of(take)
        end = self.ends()[piece]
        fits = (take + length <= end) & (take < end - self.size[piece] + self.own[piece])
        take, piece = take[fits], piece[fits]
        name, tag = runs.names(take, length), tags(self.data, take, length)
        docs, index = np.unique(self.doc, return_inverse=True)
        return Suffixes.grouped(take, name, tag, index.astype(np.int32)[piece], docs)


def _by_name(name: np.ndarray, tag: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by (name, tag), and where a new pair begins in it."""
    order = np.argsort(name)
    a, t = name[order], tag[order]
    same = a[1:] == a[:-1]
    if (same & (t[1:] != t[:-1])).any():  # one name for different strings: hardly ever
        order = np.lexsort((tag, name))
        a, t = name[order], tag[order]
        same = (a[1:] == a[:-1]) & (t[1:] == t[:-1])
    return order, np.r_[True, ~same][:len(name)]


@dataclass
class Suffixes:
    """Suffixes of a block in groups of equal names: groups in order of (name, tag)."""

    at: np.ndarray       # positions
    group: np.ndarray    # the group of each
    name: np.ndarray     # of each group
    tag: np.ndarray
    docs: np.ndarray     # the block's documents, rising
    doc: np.ndarray      # of each suffix, as an index of docs
    least: np.ndarray    # least document of each group, likewise

    @staticmethod
    def grouped(at, name, tag, doc, docs) -> "Suffixes":
        order, new = _by_name(name, tag)
        starts = np.flatnonzero(new)
        doc = doc[order]
        least = np.minimum.reduceat(doc, starts) if len(starts) else doc
        first = order[starts]
        return Suffixes(at[order], np.cumsum(new) - 1, name[first], tag[first], docs, doc, least)


def _bucket(name: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of each name, rising with the name."""
    return ((name >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _pack(x: np.ndarray) -> bytes:
    """Numbers byte plane by byte plane, compressed: the planes of sorted numbers are mostly alike."""
    planes = np.ascontiguousarray(x).view(np.uint8).reshape(len(x), -1).T
    return zstandard.compress(np.ascontiguousarray(planes).tobytes(), 1)


def _unpack(b: bytes, kind) -> np.ndarray:
    width = np.dtype(kind).itemsize
    planes = np.frombuffer(zstandard.decompress(b), np.uint8).reshape(width, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


_BLOCK = "block long, docs binary, keys binary, sizes binary, owns binary, parts binary, data binary"


def _blocks(texts: DataFrame, length: int) -> DataFrame:
    """(doc_id, key, text) in blocks; ``parts``: -1 for a whole document, else the number of its piece."""
    small_batches(texts.sparkSession)

    def pieces(data: bytes):
        if len(data) <= BLOCK_BYTES:
            yield -1, data, len(data)
        else:
            for k, at in enumerate(range(0, len(data), BLOCK_BYTES)):
                yield k, data[at:at + BLOCK_BYTES + length - 1], min(BLOCK_BYTES, len(data) - at)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        held, size, n = [], 0, TaskContext.get().partitionId() << 32

        def block():
            docs, keys, parts, owns, data = zip(*held)
            row = [n, np.array(docs, np.int64).tobytes(), b"".join(keys),
                   np.array([len(d) for d in data], np.int64).tobytes(), np.array(owns, np.int64).tobytes(),
                   np.array(parts, np.int64).tobytes(), zstandard.compress(b"".join(data), TEXT_LEVEL)]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, [pa.int64()] + [pa.binary()] * 6)],
                                              [f.split()[0] for f in _BLOCK.split(", ")])

        for b in batches:
            for doc, key, text in zip(*(c.to_pylist() for c in b.columns)):
                for part, data, own in pieces(text.encode("utf-8", "replace")):
                    if held and size + len(data) > BLOCK_BYTES:
                        yield block()
                        held, size, n = [], 0, n + 1
                    held.append((doc, key, part, own, data))
                    size += len(data)
        if held:
            yield block()

    return texts.mapInArrow(run, _BLOCK)


def _block(row) -> Block:
    data = np.frombuffer(zstandard.decompress(row.data), np.uint8) if row.sizes else np.empty(0, np.uint8)
    return Block(*(np.frombuffer(b, np.int64) for b in (row.docs, row.sizes, row.owns)), data)


def _bits(rows: pd.DataFrame) -> np.ndarray:
    """The flags of a block's names, from one row (bucket, n, bits) for each bucket."""
    rows = rows.sort_values("bucket")
    flags = [np.unpackbits(np.frombuffer(b, np.uint8), count=n).astype(bool) for b, n in zip(rows["bits"], rows["n"])]
    return np.concatenate(flags) if flags else np.empty(0, bool)


def _answers(block: np.ndarray, flag: np.ndarray, names_of: pd.Series, bucket: int) -> pd.DataFrame:
    """One row (block, bucket, n, bits) for each block; ``block`` indexes ``names_of`` and is in its order."""
    cuts = np.flatnonzero(np.diff(block)) + 1
    return pd.DataFrame({"block": names_of.to_numpy(), "bucket": bucket,
                         "n": np.bincount(block, minlength=len(names_of)),
                         "bits": [np.packbits(f).tobytes() for f in np.split(flag, cuts)]})


def _shared_samples(blocks: DataFrame, length: int, buckets: int) -> DataFrame:
    """(block, bucket, n, bits): for each distinct sample name of a block whether it occurs anywhere else."""
    def named(batches):
        for b in batches:
            for row in b.itertuples():
                block = _block(row)
                _, sample = block.samples(length, block.runs(length))
                name, n = np.unique(sample, return_counts=True)
                of = _bucket(name, buckets)
                rows = []
                for k in np.unique(of):
                    a, z = np.searchsorted(of, [k, k + 1])
                    rows.append((k, row.block, _pack((name[a:z] & np.uint64(0xFFFFFFFF)).astype(np.uint32)),
                                 np.packbits(n[a:z] > 1).tobytes()))
                yield pd.DataFrame(rows, columns=["bucket", "block", "names", "more"])

    def sort(key, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("block").reset_index(drop=True)
        low = [_unpack(b, np.uint32) for b in rows["names"]]
        of = np.repeat(np.arange(len(rows)), [len(x) for x in low])
        more = np.concatenate([np.unpackbits(np.frombuffer(m, np.uint8), count=len(x)) for m, x in zip(rows["more"], low)])
        low = np.concatenate(low)
        order = np.argsort(low)
        new = np.r_[True, low[order][1:] != low[order][:-1]]
        starts = np.flatnonzero(new)
        known = (np.diff(np.r_[starts, len(order)]) > 1) | (np.maximum.reduceat(more[order], starts) > 0)
        flag = np.empty(len(order), bool)
        flag[order] = known[np.cumsum(new) - 1]
        return _answers(of, flag, rows["block"], int(key[0]))

    made = blocks.select("block", "docs", "sizes", "owns", "data").mapInPandas(
        named, "bucket int, block long, names binary, more binary")
    return made.groupBy("bucket").applyInPandas(sort, "block long, bucket int, n long, bits binary")


def _older_suffixes(blocks: DataFrame, shared: DataFrame, length: int, buckets: int) -> DataFrame:
    """(block, bucket, n, bits): for each suffix group of a block whether a smaller document elsewhere has it."""
    def named(b: pd.DataFrame, flags: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for row in b.itertuples():
            s = _block(row).suffixes(length, _bits(flags))
            of = _bucket(s.name, buckets)
            for k in np.unique(of):
                a, z = np.searchsorted(of, [k, k + 1])
                used = np.zeros(len(s.docs), bool)  # a row holds the documents that it refers to, no others
                used[s.least[a:z]] = True
                least = (np.cumsum(used) - 1)[s.least[a:z]]
                rows.append((k, row.block, _pack(s.name[a:z]), _pack(s.tag[a:z]), _pack(s.docs[used]),
                             _pack(least.astype(np.uint32))))
        return pd.DataFrame(rows, columns=["bucket", "block", "names", "tags", "docs", "least"])

    def sort(key, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("block").reset_index(drop=True)
        name, tag, doc, n = [], [], [], []
        for r in rows.itertuples():
            name.append(_unpack(r.names, np.uint64))
            tag.append(_unpack(r.tags, np.uint16))
            doc.append(_unpack(r.docs, np.int64)[_unpack(r.least, np.uint32)])
            n.append(len(name[-1]))
        of = np.repeat(np.arange(len(rows)), n)
        name, tag, doc = np.concatenate(name), np.concatenate(tag), np.concatenate(doc)
        order, new = _by_name(name, tag)
        least = np.minimum.reduceat(doc[order], np.flatnonzero(new))
        flag = np.empty(len(order), bool)
        flag[order] = least[np.cumsum(new) - 1] < doc[order]
        return _answers(of, flag, rows["block"], int(key[0]))

    sides = blocks.select("block", "docs", "sizes", "owns", "data").groupBy("block").cogroup(shared.groupBy("block"))
    made = sides.applyInPandas(named, "bucket int, block long, names binary, tags binary, docs binary, least binary")
    return made.groupBy("bucket").applyInPandas(sort, "block long, bucket int, n long, bits binary")


def _left(data: bytes, gone: np.ndarray) -> tuple[int, int, str]:
    """Bytes removed, maximal removed runs, digest of the rest."""
    kept = np.frombuffer(data, np.uint8)[~gone]
    return int(gone.sum()), int((np.diff(np.r_[0, gone.astype(np.int8)]) == 1).sum()), hashlib.sha256(kept.tobytes()).hexdigest()


def _covered(starts: np.ndarray, size: int, length: int) -> np.ndarray:
    step = np.zeros(size + length + 1, np.int32)
    np.add.at(step, starts, 1)
    np.add.at(step, starts + length, -1)
    return np.cumsum(step)[:size] > 0


_RESULT = "key binary, n_removed long, n_spans long, kept_sha256 string"


def _removed(blocks: DataFrame, shared: DataFrame, older: DataFrame, length: int) -> DataFrame:
    """(key, part, ...): the result of each whole document; own bytes and suffixes to remove of each piece."""
    answers = shared.withColumn("step", F.lit(1)).union(older.withColumn("step", F.lit(2)))

    def mark(b: pd.DataFrame, bits: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for row in b.itertuples():
            block = _block(row)
            s = block.suffixes(length, _bits(bits[bits["step"] == 1]))
            other = _bits(bits[bits["step"] == 2])
            gone = np.sort(s.at[other[s.group] | (s.least[s.group] < s.doc)]) if len(s.at) else s.at
            ends, data = block.ends(), block.data.tobytes()
            keys, parts = row.keys, np.frombuffer(row.parts, np.int64)
            for i, (end, size, own, part) in enumerate(zip(ends, block.size, block.own, parts)):
                start = end - size
                a, z = np.searchsorted(gone, [start, end])
                hits, key = gone[a:z] - start, keys[16 * i:16 * i + 16]
                if part < 0:
                    rows.append((key, -1, *_left(data[start:end], _covered(hits, size, length)), None, None))
                else:
                    rows.append((key, part, 0, 0, None, data[start:start + own], hits.astype(np.int64).tobytes()))
        return pd.DataFrame(rows, columns=["key", "part", "n_removed", "n_spans", "kept_sha256", "data", "hits"])

    sides = blocks.groupBy("block").cogroup(answers.groupBy("block"))
    return sides.applyInPandas(mark, "key binary, part long, n_removed long, n_spans long, kept_sha256 string, "
                                     "data binary, hits binary")


def _joined(pieces: DataFrame, length: int) -> DataFrame:
    """The result of documents that were cut into pieces."""
    def join(key, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("part").drop_duplicates("part")
        starts, at = [], 0
        for data, hits in zip(rows["data"], rows["hits"]):
            starts.append(np.frombuffer(hits, np.int64) + at)
            at += len(data)
        whole = b"".join(rows["data"])
        return pd.DataFrame([(key[0], *_left(whole, _covered(np.concatenate(starts), at, length)))],
                            columns=["key", "n_removed", "n_spans", "kept_sha256"])
    return pieces.groupBy("key").applyInPandas(join, _RESULT)


def remove_repeats(docs: DataFrame, length: int = 50, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row of ``docs``.

    Each byte of the UTF-8 text goes that lies in a string of ``length`` bytes
    which also starts in a document with a smaller doc_id; strings are judged on
    the input.  ``n_spans`` counts maximal removed runs, ``kept_sha256`` is of the
    rest.  A null text counts as empty; rows without a doc_id neither lose bytes
    nor cost others any; rows with one doc_id don't cost each other any, so
    repeated rows share a result.  Other columns are ignored; no rows give none.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    all_ = docs.select(F.col(doc_id).cast("long").alias("doc_id"), body.alias("text")).withColumn("key", F.unhex(F.md5("text")))
    rows = cut(all_.select("doc_id", "key", F.octet_length("text").cast("long").alias("n_bytes"),
                           F.sha2("text", 256).alias("whole")))
    # equal texts: only the one of least doc_id is searched, the others lose every byte they can
    low = cut(rows.filter(F.col("doc_id").isNotNull() & (F.col("n_bytes") >= length)).groupBy("key").agg(
        F.min("doc_id").alias("doc_id"), F.max("n_bytes").alias("n_bytes")))
    total = low.agg(F.sum("n_bytes")).first()[0] or 0
    firsts = all_.join(low.select("key", "doc_id").hint("shuffle_hash"), ["key", "doc_id"], "left_semi")
    blocks = cut(_blocks(firsts.select("doc_id", "key", "text"), length))
    period, cover = cover_for(length)
    buckets = max(shuffle_partitions(docs.sparkSession), -(-total * len(cover) // period // BUCKET_NAMES))
    shared = cut(_shared_samples(blocks, length, buckets))
    older = cut(_older_suffixes(blocks, shared, length, buckets))
    found = cut(_removed(blocks, shared, older, length))
    results = found.filter("part < 0").select("key", "n_removed", "n_spans", "kept_sha256").union(
        _joined(found.filter("part >= 0").select("key", "part", "data", "hits"), length)).dropDuplicates(["key"])
    results = cut(results.join(low.select("key", F.col("doc_id").alias("low")), "key"))
    out = rows.join(results, "key", "left")
    nothing = F.col("low").isNull() | F.col("doc_id").isNull()
    first = F.col("doc_id") == F.col("low")
    return out.select(
        "doc_id", "n_bytes",
        F.when(nothing, 0).when(first, F.col("n_removed")).otherwise(F.col("n_bytes")).cast("long").alias("n_removed"),
        F.when(nothing, 0).when(first, F.col("n_spans")).otherwise(1).cast("long").alias("n_spans"),
        F.when(nothing, F.col("whole")).when(first, F.col("kept_sha256")).otherwise(
            F.lit(hashlib.sha256(b"").hexdigest())).alias("kept_sha256"))
