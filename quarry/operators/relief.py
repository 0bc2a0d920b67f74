"""ReliefF feature weights (F14), re-aimed for scale.

As in the reference every row is an anchor (n^2 distances, range-normalised
Manhattan), unless a number of anchors is given, which are then chosen by hash.
Anchors are dealt into blocks, and all rows pass by each block twice, a batch at a
time: first to find the exact top-k per (anchor, class) under the (distance, key)
order, then to add up the differences to the neighbours found. A task holds its
anchors, their neighbours' numbers and one batch of rows; it returns one sum per
feature. Misses are weighted by class prior.

Nearly all pairs are ruled out by a lower bound of their distance in small integers
(see ``_Nearest``); only the others' distances are computed.
"""

from __future__ import annotations

from typing import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.hashing import row_hash
from quarry.operators.neighbors import _matrix, _vector_cols
from quarry.plans.joins import join_null_safe
from quarry.plans.parallel import spread
from quarry.plans.ranks import row_number_global
from quarry.session import cut_lineage

DEFAULT_N_FEATURES = 10
#: Anchors of a block at most, and as few as make blocks for all cores.
BLOCK_ROWS, MIN_ANCHOR_ROWS = 1 << 16, 1 << 8
#: Neighbours, and numbers of features, that a block of anchors holds at most.
BLOCK_SLOTS, BLOCK_CELLS = 1 << 22, 1 << 23
#: Steps in which the rows come to a block.
ANCHORS, SEARCH, SUM = 0, 1, 2


def relief_weights(df: DataFrame, cols, target: str, key: str, n_anchors: int | None = None, k: int = 10,
                   seed: int = 0, hash_method: str = "xxhash64", n_features: int = DEFAULT_N_FEATURES,
                   block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(feature, weight, rank, selected) with the top ``n_features`` selected.
    Every row is an anchor, or the first ``n_anchors`` in the order of their hashes.
    A non-integer target is label-encoded (dense rank of its distinct values). Rows whose
    target, or any feature, is missing (null or NaN) are left out. A row isn't its own
    neighbour, nor are others with its key; anchors with the same key share their k neighbours."""
    d, names = _vector_cols(df, cols)
    tdt = df.schema[target].dataType.simpleString()
    if tdt not in INTEGERS:
        names_of = d.select(F.col(target).cast("string").alias("_name")).filter("_name is not null").distinct()
        codes = cut_lineage(row_number_global(names_of, ["_name"], out="_cls"))
        d = d.join(codes, F.col(target).cast("string") == F.col("_name"), "left").drop("_name")
    else:
        d = d.withColumn("_cls", F.col(target).cast("long"))
    x = F.array(*[F.col(c).cast("float" if _single(df, cols) else "double") for c in names])
    rows = d.select(F.col(key).alias("key"), F.col("_cls").alias("cls"), x.alias("x")).filter(
        F.col("cls").isNotNull() & ~F.exists("x", lambda v: v.isNull() | F.isnan(v)))
    rows = cut_lineage(_numbered_keys(spread(rows)).withColumn("row", F.monotonically_increasing_id()))
    spark = df.sparkSession
    at = [F.col("x")[i].cast("double") for i in range(len(names))]
    got = rows.agg(F.count(F.lit(1)).alias("n"), *[(F.max(v) - F.min(v)).alias(f"r{i}") for i, v in enumerate(at)]).first()
    total = got["n"]
    rg = np.array([got[f"r{i}"] or np.inf for i in range(len(names))], dtype=np.float64)  # constant feature: diff 0
    m = total if n_anchors is None else min(n_anchors, total)
    anchors = rows
    if m < total:
        anchors = rows.orderBy(row_hash("key", seed, hash_method), "key").limit(m)
    classes = rows.groupBy("cls").agg(F.count(F.lit(1)).alias("n")).orderBy("cls").toArrow()
    labels, sizes = (classes.column(c).to_numpy() for c in ("cls", "n"))

    # as few blocks as keep the cores at work, as all rows go to each; more where neighbours or features fill the memory
    cores = spark.sparkContext.defaultParallelism
    most = min(block_rows, BLOCK_SLOTS // max(1, int(np.minimum(sizes, k).sum())), BLOCK_CELLS // max(1, len(names)))
    blocks, least = max(1, min(-(-m // MIN_ANCHOR_ROWS), 3 * cores)), -(-m // max(1, most))
    if least > blocks:
        blocks = -(-least // cores) * cores
    own = anchors.withColumn("a", F.pmod(F.xxhash64("key"), F.lit(blocks)).cast("int")).withColumn("step", F.lit(ANCHORS))
    every = rows.withColumn("a", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).withColumn(
        "step", F.explode(F.array(F.lit(SEARCH), F.lit(SUM))))
    dealt = own.unionByName(every).select("a", "step", "kid", "cls", "row", "x").repartitionById(blocks, "a")
    shared = spark.sparkContext.broadcast((rg, labels, sizes))
    part = dealt.sortWithinPartitions("a", "step").mapInArrow(_block_sums(shared, k, m), "i int, w double")
    weights = {r["i"]: r["w"] for r in part.groupBy("i").agg(F.sum("w").alias("w")).collect()}  # one row per feature
    ranked = sorted(((c, weights.get(i, 0.0)) for i, c in enumerate(names)), key=lambda t: (-t[1], t[0]))
    return spark.createDataFrame(
        [(f, float(w), i + 1, i < n_features) for i, (f, w) in enumerate(ranked)],
        "feature string, weight double, rank int, selected boolean")


INTEGERS = ("int", "bigint", "smallint", "tinyint")


def _single(df: DataFrame, cols) -> bool:
    """Whether single precision holds the features, so that half the bytes go to the blocks."""
    if isinstance(cols, str):
        return getattr(df.schema[cols].dataType, "elementType", None) == T.FloatType()
    return all(df.schema[c].dataType == T.FloatType() for c in cols)


def _numbered_keys(rows: DataFrame) -> DataFrame:
    """``kid``: whole numbers with the order and the equality of the keys. Missing numbers and
    times differ from each other, other missing keys are equal."""
    kind = rows.schema["key"].dataType.simpleString()
    if kind in INTEGERS:
        return rows.withColumn("kid", F.col("key").cast("long"))
    known = rows.select("key").filter("key is not null").distinct()
    rows = join_null_safe(rows, cut_lineage(row_number_global(known, ["key"], out="kid")), ["key"], "left")
    return rows if kind in ("float", "double", "timestamp", "timestamp_ntz") else rows.withColumn("kid", F.coalesce("kid", F.lit(-1)))


def _block_sums(shared, k: int, m: int):
    """(feature, weight) of the blocks of anchors in a partition, whose rows come in the order of their steps."""
    def sums(batches):
        rg, labels, sizes = shared.value
        s, block, own, search, pairs = np.zeros(len(rg)), None, [], None, None
        for b in batches:
            a, step = (b.column(i).to_numpy() for i in (0, 1))
            cuts = np.flatnonzero((np.diff(a) != 0) | (np.diff(step) != 0)) + 1
            for lo, hi in zip(np.r_[0, cuts], np.r_[cuts, len(a)]):
                if lo == hi:
                    continue
                if a[lo] != block:
                    block, own, search, pairs = a[lo], [], None, None
                rows = _Rows.of(b.slice(lo, hi - lo), labels)
                if step[lo] == ANCHORS:
                    own.append(rows)
                elif step[lo] == SEARCH and own:
                    search = search or _Nearest(_Rows.joined(own), rg, k, sizes)
                    search.add(rows)
                elif step[lo] == SUM and search:
                    pairs = pairs or _Pairs(search, sizes, m)
                    s += pairs.sums(rows)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(rg), dtype=np.int32)), pa.array(s)], ["i", "w"])
    return sums


#: Stands for a missing key.
NO_KEY = np.iinfo(np.int64).min


class _Rows:
    """Features, keys (and which are known), places of their classes, and numbers of some rows."""
    def __init__(self, x, kid, known, cls, row):
        self.x, self.kid, self.known, self.cls, self.row = self.parts = x, kid, known, cls, row

    @classmethod
    def of(cls, b: pa.RecordBatch, labels: np.ndarray) -> _Rows:
        kid = b.column(2)
        return cls(_matrix(b.column(5)), kid.fill_null(NO_KEY).to_numpy(zero_copy_only=False), kid.is_valid().to_numpy(zero_copy_only=False),
                   np.searchsorted(labels, b.column(3).to_numpy()), b.column(4).to_numpy())

    @classmethod
    def joined(cls, some: Sequence[_Rows]) -> _Rows:
        return cls(*map(np.concatenate, zip(*(r.parts for r in some))))

    def __getitem__(self, at) -> _Rows:
        return _Rows(*(p[at] for p in self.parts))

    def __len__(self) -> int:
        return len(self.row)

    def comparable(self, rg: np.ndarray) -> _Rows:
        """Rows whose distances are numbers."""
        with np.errstate(invalid="ignore"):
            fine = np.isfinite(self.x / rg).all(axis=1)
        return self if fine.all() else self[fine]


class _Grid:
    """Features as whole numbers from 0 to LEVELS, whose differences don't exceed those of the features.

    A feature is divided by its range, multiplied by a scale that all features share, cut off at
    both ends of a window, and rounded. What rounding changed is added up for each row, so
    ``scale * distance >= sum of differences - changes of both rows``."""
    LEVELS, SUMMED, NEAR = 63, 4, 4   # SUMMED differences fit 8 bits

    def __init__(self, x: np.ndarray, rg: np.ndarray):
        self.use = np.flatnonzero(np.isfinite(rg))
        some = x[::max(1, len(x) >> 12), self.use]   # they set the windows, the bound holds for any
        self.rg, self.scale = rg[self.use], 1.0
        self.mid = np.zeros(len(self.use))
        if not len(some) or not len(self.use):
            return
        lo, hi = np.quantile(some, [0.01, 0.99], axis=0)
        self.mid = lo / 2 + hi / 2
        width = max(float(np.max((hi - lo) / self.rg)), 1e-9)
        scales = [self.LEVELS / width * 2.0 ** halved for halved in range(12)]
        kept = self._kept(some[::max(1, len(some) >> 6)], some[::max(1, len(some) >> 10)], scales)
        self.scale = scales[int(np.argmin(kept))]

    def _kept(self, few: np.ndarray, some: np.ndarray, scales) -> list[int]:
        """For each scale, how many pairs it wouldn't rule out if only NEAR of ``some`` were wanted."""
        least = min(self.NEAR, len(some)) - 1
        limit = [np.partition((np.abs(some - v) / self.rg).sum(axis=1), least)[least] for v in few]
        kept = []
        for scale in scales:
            (q, off), (own, own_off) = self.levels(some, scale), self.levels(few, scale)
            q = q.astype(np.int32)
            kept.append(sum(int((np.abs(q - v).sum(axis=1) - off <= scale * lim + o).sum()) for v, o, lim in zip(own, own_off, limit)))
        return kept

    def levels(self, x: np.ndarray, scale: float) -> tuple[np.ndarray, np.ndarray]:
        f = np.clip((x - self.mid) / self.rg * scale + self.LEVELS / 2, 0, self.LEVELS)
        q = np.rint(f)
        return q.astype(np.int8), np.abs(f - q).sum(axis=1)

    def __call__(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.levels(x[:, self.use], self.scale)


class _Nearest:
    """The k nearest rows of each class, for each of some anchors, among rows that come in batches.

    Sums of differences on a grid (8 bits a feature) bound the distances from below. A pair whose
    bound exceeds the k-th least distance known for its anchor and class is left out, the distances of
    all others are computed. Equal distances are in the order of the keys, then of the rows' numbers."""
    #: Pairs of a part, whose sums stay in a core's cache; rows of a part; pairs whose distances are computed at once.
    PART, WIDTH, EXACT, HELD = 1 << 18, 12 << 10, 1 << 9, 1 << 17

    def __init__(self, anchors: _Rows, rg: np.ndarray, k: int, sizes: np.ndarray):
        self.rg, self.k, self.own = rg, k, anchors.comparable(rg)
        n, self.room = len(self.own), np.minimum(sizes, k)
        self.first = np.r_[0, np.cumsum(self.room)]
        self.slots, self.n_cls = int(self.first[-1]), len(sizes)
        self.dist = np.full(n * self.slots, np.inf)
        self.kid, self.row = (np.zeros(n * self.slots, np.int64) for _ in range(2))
        self.grid = _Grid(self.own.x, rg)
        q, self.off = self.grid(self.own.x)
        self.q = np.ascontiguousarray(q.T)[:, :, None]
        d = len(self.q)
        self.shift, self.kind = -(-d // 2) + 1, np.uint16 if (self.grid.LEVELS + 1) * d + 2 < 1 << 16 else np.uint32
        self.limit = np.full((n, self.n_cls), np.iinfo(self.kind).max, self.kind)   # of the sums
        self.kth = np.full((n, self.n_cls), np.inf)   # the k-th least distance is not above it
        self.held: list = []

    def add(self, rows: _Rows) -> None:
        rows = rows.comparable(self.rg)
        n = len(rows)
        pieces = -(-n // self.WIDTH)
        for p in range(pieces if len(self.own) else 0):
            piece = rows[p * n // pieces:(p + 1) * n // pieces]
            self._compare(piece[np.argsort(piece.cls, kind="stable")])

    def _compare(self, rows: _Rows) -> None:
        q, off = self.grid(rows.x)
        q, base = np.ascontiguousarray(q.T)[:, None, :], (self.shift - np.ceil(off)).astype(self.kind)
        cuts = np.flatnonzero(np.diff(rows.cls)) + 1
        runs = list(zip(rows.cls[np.r_[0, cuts]], np.r_[0, cuts], np.r_[cuts, len(rows)]))
        few = max(1, self.PART // len(rows))
        some = min(few, len(self.own))
        sums, part, one, near = (np.empty((some, len(rows)), t) for t in (self.kind, np.int8, np.int8, bool))
        count = 0
        for at in range(0, len(self.own), few):
            own = self.q[:, at:at + few]
            n = own.shape[1]
            s = sums[:n]
            self._sum(own, q, base, s, part[:n], one[:n])
            self._start(at, s, rows, runs)
            limit, hit = self.limit[at:at + n], near[:n]
            if len(runs) <= 64:
                for c, lo, hi in runs:
                    np.less_equal(s[:, lo:hi], limit[:, c, None], hit[:, lo:hi])
            else:
                np.less_equal(s, limit[:, rows.cls], hit)
            i, j = _true(hit)
            self.held.append((i + at, j))
            count += len(i)
            if count >= self.HELD:
                self._merge(rows)
                count = 0
        self._merge(rows)

    def _sum(self, own, q, base, sums, part, one) -> None:
        """Sums of the grid's differences; ``base`` makes up for the rows' rounding."""
        sums[...] = base
        summed = self.grid.SUMMED
        for g in range(0, len(q), summed):
            np.subtract(own[g], q[g], part)
            np.absolute(part, part)
            for j in range(g + 1, min(g + summed, len(q))):
                np.subtract(own[j], q[j], one)
                np.absolute(one, one)
                np.add(part, one, part)
            np.add(sums, part.view(np.uint8), sums)

    def _start(self, at: int, s: np.ndarray, rows: _Rows, runs) -> None:
        """Limits for anchors that have none in a class, from the k least sums of a part."""
        none = np.iinfo(self.kind).max
        for c, lo, hi in runs:
            take = self.k + 2
            if hi - lo <= 2 * take:
                continue
            new = np.flatnonzero(self.limit[at:at + len(s), c] == none)
            if len(new):
                j = np.argpartition(s[new, lo:hi], take - 1, axis=1)[:, :take] + lo
                dist = self._distances(np.repeat(new + at, take), j.ravel(), rows).reshape(len(new), take)
                self._lower(new + at, c, np.sort(dist, axis=1)[:, self.k - 1])

    def _lower(self, i, c, dist) -> None:
        fine = np.isfinite(dist)
        bound = np.where(fine, dist, 0.0) * (self.grid.scale * (1 + 1e-9)) + self.off[i] + (self.shift + 1e-6)
        most = np.iinfo(self.kind).max
        limit = np.where(fine, np.minimum(bound, most), most).astype(self.kind)
        self.limit[i, c] = np.minimum(self.limit[i, c], limit)
        self.kth[i, c] = np.minimum(self.kth[i, c], dist)

    def _distances(self, i: np.ndarray, j: np.ndarray, rows: _Rows) -> np.ndarray:
        """Of pairs of an anchor and a row; infinite if they have the same key, or no distance."""
        dist = np.zeros(len(i))
        for at in range(0, len(i), self.EXACT):
            diff, to = self.own.x.take(i[at:at + self.EXACT], axis=0), dist[at:at + self.EXACT]
            diff -= rows.x.take(j[at:at + self.EXACT], axis=0)
            np.abs(diff, diff)
            diff /= self.rg
            for of_feature in diff.T:
                to += of_feature
        dist[np.isnan(dist) | (self.own.kid[i] == rows.kid[j]) & self.own.known[i] & rows.known[j]] = np.inf
        return dist

    def _merge(self, rows: _Rows) -> None:
        """The pairs held go to the slots of their anchors and classes, if they are among the least."""
        if not self.held:
            return
        i, j = (np.concatenate(x) for x in zip(*self.held))
        self.held = []
        dist = self._distances(i, j, rows)
        fine = np.flatnonzero(np.isfinite(dist) & (dist <= self.kth[i, rows.cls[j]]))
        i, j, dist = i[fine], j[fine], dist[fine]
        if not len(i):
            return
        group = i * self.n_cls + rows.cls[j]
        seen = np.unique(group)
        c = seen % self.n_cls
        room = self.room[c]
        old = np.repeat(seen // self.n_cls * self.slots + self.first[c], room) + _places(room)
        group = np.r_[np.repeat(seen, room), group]
        dist, kid, row = np.r_[self.dist[old], dist], np.r_[self.kid[old], rows.kid[j]], np.r_[self.row[old], rows.row[j]]
        order = np.lexsort((row, kid, dist, group))
        sizes = np.bincount(np.searchsorted(seen, group), minlength=len(seen))
        order = order[_places(sizes) < np.repeat(room, sizes)]   # a class has as many slots as rows, if fewer than k
        self.dist[old], self.kid[old], self.row[old] = dist[order], kid[order], row[order]
        self._lower(seen // self.n_cls, c, self.dist[seen // self.n_cls * self.slots + self.first[c + 1] - 1])

    def found(self):
        """(anchor, class, distance, key, number of the row) of all neighbours."""
        at = np.flatnonzero(np.isfinite(self.dist))
        cls = np.repeat(np.arange(self.n_cls), self.room)[at % max(1, self.slots)]
        return at // max(1, self.slots), cls, self.dist[at], self.kid[at], self.row[at]


class _Pairs:
    """Anchors and the numbers of their neighbours, with the factors of their differences."""
    def __init__(self, search: _Nearest, sizes: np.ndarray, m: int):
        self.own, self.rg, k = search.own, search.rg, search.k
        i, cls, dist, kid, row = search.found()
        _, name, times = np.unique(self.own.kid, return_inverse=True, return_counts=True)
        name[~self.own.known] = len(times)
        if len(times) < len(self.own):   # anchors with the same key share their k neighbours
            order = np.lexsort((i, row, kid, dist, cls, name[i]))
            new = np.flatnonzero(np.r_[True, (np.diff(name[i][order]) != 0) | (np.diff(cls[order]) != 0)][:len(order)])
            order = order[_places(np.diff(np.r_[new, len(order)])) < k]
            i, cls, row = i[order], cls[order], row[order]
        prior = sizes / float(max(int(sizes.sum()), 1))
        home = self.own.cls[i]
        with np.errstate(divide="ignore", invalid="ignore"):   # a single class has hits only
            factor = np.where(cls == home, -1.0, prior[cls] / (1.0 - prior[home])) / float(max(m, 1) * k)
        order = np.argsort(row, kind="stable")
        self.i, self.row, self.factor = i[order], row[order], factor[order]

    def sums(self, rows: _Rows) -> np.ndarray:
        lo, hi = (np.searchsorted(self.row, rows.row, side) for side in ("left", "right"))
        j = np.repeat(np.arange(len(rows)), hi - lo)
        p = np.repeat(lo, hi - lo) + _places(hi - lo)
        s = np.zeros(len(self.rg))
        for at in range(0, len(j), _Nearest.EXACT):
            own = p[at:at + _Nearest.EXACT]
            s += self.factor[own] @ (np.abs(self.own.x[self.i[own]] - rows.x[j[at:at + _Nearest.EXACT]]) / self.rg)
        return s


def _places(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... within each of the groups that follow each other."""
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _true(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the true cells, of which there are few: eight of them are looked at together."""
    flat, n = hit.reshape(-1), hit.size & ~7
    eight = np.flatnonzero(flat[:n].view(np.uint64)) * 8
    at = (eight[:, None] + np.arange(8)).ravel()
    at = np.r_[at[flat[at]], n + np.flatnonzero(flat[n:])]
    return at // hit.shape[1], at % hit.shape[1]


def _block_kernel(rg: np.ndarray, k: int):
    """The k nearest rows of each class in a block, for each anchor of another block, as a table."""
    def kernel(anchors: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        labels, sizes = np.unique(rows["cls"].to_numpy(), return_counts=True)
        own, others = (_Rows(np.stack(t["x"].to_numpy()), t["key"].to_numpy(), t["key"].notna().to_numpy(),
                             np.searchsorted(labels, t["cls"].to_numpy()), t["row"].to_numpy()) for t in (anchors, rows))
        search = _Nearest(own, rg, k, sizes)
        search.add(others)
        i, cls, dist, kid, row = search.found()
        return pd.DataFrame({"anchor": search.own.kid[i], "arow": search.own.row[i], "cls": labels[cls], "dist": dist, "key": kid, "row": row})
    return kernel
