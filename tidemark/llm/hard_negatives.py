"""Hard negatives by filtering on segment summaries.

Each vector is quantised to whole numbers, cut into segments (1, then 4, then 16), and every
segment's mean and deviation are stored.  For two vectors the segments' inner product is

    length * (mean * mean + something of at most deviation * deviation)

by Cauchy and Schwarz, so the sum over the segments bounds the score from above and below.  Pairs
whose bounds cannot reach what is wanted are left out level by level; only the rest are scored
exactly.  No pair is left out that the exact score would keep.

Anchors are worked in blocks of bounded size, each broadcast to the tasks that hold the vectors; a
task sends its best few rows for each anchor.  A sixteenth of the vectors goes first: what it has
bounds what is worth sending from all of them, so what is shuffled does not grow with the tasks.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tidemark.llm import base

#: Whole numbers up to here are exact in a double.
EXACT = 2**53
LONG = 2**63 - 1


@dataclass(frozen=True)
class Settings:
    scale: int = 256
    positives: int = 5
    negatives: int = 3
    #: Share of the positive's score, in hundredths, that a negative must have and may not pass.
    low: int = 50
    high: int = 95
    #: Segments of a vector, level by level.
    segments: tuple[int, ...] = (1, 4, 16)
    #: Bytes of the vectors of one block of anchors.
    block_bytes: int = 8 << 20
    #: One of so many vectors is looked at first.
    first: int = 16
    #: Anchors and vectors that are held against each other at once.
    tile: int = 1024


def cuts(dims: int, n: int) -> np.ndarray:
    """Starts of at most ``n`` segments, and the end."""
    return np.unique(np.linspace(0, dims, min(n, dims) + 1).astype(np.int64))


def summarised(vectors: np.ndarray, segments: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Means and deviations of the segments of all levels, side by side."""
    if not vectors.shape[1]:
        return np.zeros((len(vectors), 0)), np.zeros((len(vectors), 0))
    means, deviations = [], []
    for n in segments:
        at = cuts(vectors.shape[1], n)
        sizes = np.diff(at)
        mean = np.add.reduceat(vectors, at[:-1], axis=1) / sizes
        square = np.add.reduceat((vectors - np.repeat(mean, sizes, axis=1)) ** 2, at[:-1], axis=1) / sizes
        means.append(mean)
        deviations.append(np.sqrt(square))
    return np.concatenate(means, axis=1), np.concatenate(deviations, axis=1)


def _matrix(lists: pa.Array, width: int, dtype) -> np.ndarray:
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    return lists.flatten().to_numpy(zero_copy_only=False).astype(dtype).reshape(len(lists), width)


@dataclass(frozen=True)
class Vectors:
    """Vectors of one length, with what bounds their products; the summaries carry the root of their segment's length."""

    uid: np.ndarray
    label: np.ndarray
    values: np.ndarray
    means: np.ndarray
    deviations: np.ndarray
    norm: np.ndarray

    @classmethod
    def of(cls, uid, label, values: np.ndarray, means: np.ndarray, deviations: np.ndarray, settings: Settings) -> Vectors:
        dims = values.shape[1]
        roots = np.sqrt(np.concatenate([np.diff(cuts(dims, n)) for n in settings.segments])) if dims else np.zeros(0)
        return cls(uid, label, values, means * roots, deviations * roots, np.linalg.norm(values.astype(np.float64), axis=1))

    def take(self, at) -> Vectors:
        return Vectors(self.uid[at], self.label[at], self.values[at], self.means[at], self.deviations[at], self.norm[at])

    def __len__(self) -> int:
        return len(self.uid)


def _rows(batch, settings: Settings) -> list[tuple[np.ndarray, Vectors]]:
    """(rows of the batch, vectors) for each length of vectors in ``batch``."""
    out = []
    sizes = batch.column("values").value_lengths().to_numpy(zero_copy_only=False)
    for dims in np.unique(sizes):
        at = np.flatnonzero(sizes == dims)
        part = batch.take(pa.array(at))
        n = sum(len(cuts(int(dims), s)) - 1 for s in settings.segments) if dims else 0
        out.append((at, Vectors.of(
            part.column("uid").to_numpy(), part.column("label").to_numpy(), _matrix(part.column("values"), int(dims), np.int64),
            _matrix(part.column("means"), n, np.float64), _matrix(part.column("deviations"), n, np.float64), settings,
        )))
    return out


def products(a: np.ndarray, b: np.ndarray, paired: bool = False) -> np.ndarray:
    """Exact inner products of all rows of ``a`` with all of ``b`` (or of row with row), held at the ends of 64 bits."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if most < EXACT:
        x, y = a.astype(np.float64), b.astype(np.float64)
        return (np.einsum("ij,ij->i", x, y) if paired else x @ y.T).astype(np.int64)
    x, y = a.astype(object), b.astype(object)
    whole = (x * y).sum(axis=1) if paired else x.dot(y.T)
    return np.array(np.clip(np.asarray(whole, object), -LONG, LONG), np.int64)


def _bounds(x: Vectors, y: Vectors, cols: slice, paired: bool) -> tuple[np.ndarray, np.ndarray]:
    def dot(p, q):
        return np.einsum("ij,ij->i", p[:, cols], q[:, cols]) if paired else p[:, cols] @ q[:, cols].T

    mid, off = dot(x.means, y.means), dot(x.deviations, y.deviations)
    # the summaries are stored in single precision
    off += 1 + 1e-6 * (x.norm * y.norm if paired else np.outer(x.norm, y.norm))
    return mid - off, mid + off


def survivors(x: Vectors, y: Vectors, low: np.ndarray, high: np.ndarray, alive: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, vector, score) of the pairs in ``alive`` whose score lies within the anchor's ``low`` and ``high``."""
    done, dims = 0, x.values.shape[1]
    at = None  # the pairs left, once they are few
    for n in settings.segments if dims else ():
        cols = slice(done, done + len(cuts(dims, n)) - 1)
        done = cols.stop
        if at is None:
            below, above = _bounds(x, y, cols, False)
            alive = alive & (above >= low[:, None]) & (below <= high[:, None])
            if np.count_nonzero(alive) * 8 < alive.size:
                at = np.nonzero(alive)
        else:
            below, above = _bounds(x.take(at[0]), y.take(at[1]), cols, True)
            keep = (above >= low[at[0]]) & (below <= high[at[0]])
            at = at[0][keep], at[1][keep]
    if at is None:
        scores = products(x.values, y.values)
        at = np.nonzero(alive & (scores >= low[:, None]) & (scores <= high[:, None]))
        return *at, scores[at]
    scores = products(x.values[at[0]], y.values[at[1]], True)
    keep = (scores >= low[at[0]]) & (scores <= high[at[0]])
    return at[0][keep], at[1][keep], scores[keep]


class Best:
    """The first ``k`` rows of each group by score (high first), id (low first, none last) and row."""

    def __init__(self, k: int, floor: np.ndarray):
        self.k, self.floor = k, floor  # a group's row must have its floor at least
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.size = self.kept = 0

    def add(self, group, score, vec_id, has_id, uid) -> None:
        keep = score >= self.floor[group]
        self.parts.append((group[keep], score[keep], vec_id[keep], has_id[keep], uid[keep]))
        self.size += int(keep.sum())
        if self.size > 2 * self.kept + 50_000:
            self.compact()

    def compact(self) -> tuple[np.ndarray, ...]:
        group, score, vec_id, has_id, uid = (np.concatenate(c) for c in zip(*self.parts)) if self.parts else (np.zeros(0, np.int64),) * 5
        order = np.lexsort((uid, vec_id, ~has_id.astype(bool), -score, group))
        ranked = group[order]
        rank = np.arange(len(ranked)) - np.searchsorted(ranked, ranked)
        kept = order[rank < self.k]
        last = order[rank == self.k - 1]
        self.floor[group[last]] = np.maximum(self.floor[group[last]], score[last])
        self.parts = [(group[kept], score[kept], vec_id[kept], has_id[kept], uid[kept])]
        self.size = self.kept = len(kept)
        return self.parts[0]


@dataclass(frozen=True)
class Block:
    """Anchors of one length; ``low``, ``high`` and ``floor`` have a column for each list that an anchor asks for."""

    anchors: Vectors
    low: np.ndarray
    high: np.ndarray
    same_label: bool
    keep: int

    @property
    def groups(self) -> int:
        return self.low.shape[1]


def _search(shared, settings: Settings):
    """For each anchor and list, the first rows of this task within its bounds: (anchor, list, score, vec_id, uid)."""

    def run(batches):
        blocks = shared.value
        best = {dims: Best(b.keep, b.low.ravel().copy()) for dims, b in blocks.items()}
        for batch in batches:
            ids = batch.column("vec_id")
            has_id = ids.is_valid().to_numpy(zero_copy_only=False)
            vec_id = ids.fill_null(0).to_numpy(zero_copy_only=False)
            for rows, vectors in _rows(batch, settings):
                block = blocks.get(vectors.values.shape[1])
                if block is None:
                    continue
                own = best[vectors.values.shape[1]]
                for y, x in _tiles(block, vectors, settings):
                    _held(block, own, x, y, vectors, vec_id[rows], has_id[rows], settings)
        out = []
        for dims, b in blocks.items():
            group, score, vec_id, has_id, uid = best[dims].compact()
            out.append((b.anchors.uid[group // b.groups], group % b.groups, score, vec_id, has_id, uid))
        anchor, which, score, vec_id, has_id, uid = (np.concatenate(c) for c in zip(*out))
        yield pa.RecordBatch.from_arrays(
            [pa.array(anchor, pa.int64()), pa.array(which, pa.int32()), pa.array(score, pa.int64()), pa.array(vec_id, pa.int64(), mask=~has_id.astype(bool)), pa.array(uid, pa.int64())],
            names=["anchor", "list", "score", "vec_id", "uid"],
        )

    return run


def _tiles(block: Block, vectors: Vectors, settings: Settings):
    """Vectors and anchors to hold against each other; for equal labels, those of one label."""
    step = settings.tile
    if not block.same_label:
        for r in range(0, len(vectors), step):
            for a in range(0, len(block.anchors), step):
                yield np.arange(r, min(r + step, len(vectors))), np.arange(a, min(a + step, len(block.anchors)))
        return
    for label in np.intersect1d(vectors.label, block.anchors.label):
        rows, anchors = np.flatnonzero(vectors.label == label), np.flatnonzero(block.anchors.label == label)
        for r in range(0, len(rows), step):
            for a in range(0, len(anchors), step):
                yield rows[r : r + step], anchors[a : a + step]


def _held(block: Block, best: Best, x: np.ndarray, y: np.ndarray, vectors: Vectors, vec_id, has_id, settings: Settings) -> None:
    anchors, rows = block.anchors.take(x), vectors.take(y)
    alive = anchors.uid[:, None] != rows.uid[None, :]
    if not block.same_label:
        alive &= anchors.label[:, None] != rows.label[None, :]
    floor, high = best.floor.reshape(-1, block.groups)[x], block.high[x]
    floor = np.where(floor > high, LONG, floor)  # an empty list asks for nothing
    a, r, score = survivors(anchors, rows, floor.min(axis=1), high.max(axis=1), alive, settings)
    for g in range(block.groups):
        fits = (score >= floor[a, g]) & (score <= high[a, g])
        best.add(x[a[fits]] * block.groups + g, score[fits], vec_id[y[r[fits]]], has_id[y[r[fits]]], rows.uid[r[fits]])


_FOUND = "anchor long, list int, score long, vec_id long, uid long"


def _first_rows(found: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("anchor", "list").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "uid")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _summaries(settings: Settings):
    def run(vectors: pa.Array) -> pa.Array:
        sizes = vectors.value_lengths().to_numpy(zero_copy_only=False)
        parts: list = [None] * len(vectors)
        for dims in np.unique(sizes):
            at = np.flatnonzero(sizes == dims)
            raw = _matrix(vectors.take(pa.array(at)), int(dims), np.float64)
            with np.errstate(over="ignore"):
                whole = np.clip(np.floor(settings.scale * raw), -EXACT, EXACT)
            means, deviations = summarised(whole, settings.segments)
            for k, row in enumerate(at):
                parts[row] = whole[k].astype(np.int64), means[k].astype(np.float32), deviations[k].astype(np.float32)

        def column(k: int, kind: pa.DataType) -> pa.ListArray:
            ends = np.concatenate([[0], np.cumsum([len(p[k]) for p in parts], dtype=np.int64)]).astype(np.int32)
            flat = np.concatenate([p[k] for p in parts]) if parts else np.zeros(0)
            return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, kind))

        return base.struct(values=column(0, pa.int64()), means=column(1, pa.float32()), deviations=column(2, pa.float32()))

    return run


def indexed(rows: DataFrame, anchor: Column, settings: Settings = Settings()) -> DataFrame:
    """Written: the rows that take part, with whole numbers and segment summaries of their vectors."""
    used = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("vector"), F.coalesce(anchor, F.lit(False)).alias("anchor"))
    sound = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    used = used.withColumn("uid", F.monotonically_increasing_id()).filter(F.col("label").isNotNull() & F.col("vector").isNotNull() & sound)
    udf = F.arrow_udf(_summaries(settings), "values array<long>, means array<float>, deviations array<float>")
    return base.written(used.select("uid", "vec_id", "label", "anchor", udf(F.col("vector")).alias("s")).select("uid", "vec_id", "label", "anchor", "s.*"), "vectors")


def _searched(vectors: DataFrame, blocks: dict[int, Block], settings: Settings) -> DataFrame:
    shared = vectors.sparkSession.sparkContext.broadcast(blocks)
    return vectors.select("uid", "vec_id", "label", "values", "means", "deviations").mapInArrow(_search(shared, settings), _FOUND)


def _lists(vectors: DataFrame, blocks: dict[int, Block], settings: Settings) -> DataFrame:
    """The first rows of each anchor's lists, found among all vectors; a part of them first raises what is asked for."""
    keep = next(iter(blocks.values())).keep
    part = vectors.filter(F.pmod(F.xxhash64("uid"), F.lit(settings.first)) == 0)
    part = part.coalesce(max(1, len(vectors.inputFiles()) // settings.first))
    known = _first_rows(_searched(part, blocks, settings), keep).filter(F.col("rank") == keep).select("anchor", "list", "score").toArrow()
    raised = {}
    for dims, b in blocks.items():
        low = b.low.copy()
        order = np.argsort(b.anchors.uid)
        anchor = known["anchor"].to_numpy()
        at = order[np.searchsorted(b.anchors.uid[order], anchor).clip(max=len(order) - 1)]
        mine = b.anchors.uid[at] == anchor
        np.maximum.at(low, (at[mine], known["list"].to_numpy()[mine]), known["score"].to_numpy()[mine])
        raised[dims] = replace(b, low=low)
    return _first_rows(_searched(vectors, raised, settings), keep)


def mined(rows: DataFrame, anchor: Column, settings: Settings = Settings()) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score, positive_rank).

    ``rows`` has vec_id, embedding and label; ``anchor`` tells which rows are anchors.  A row with a
    null label or vector, or a null, NaN or infinite component, takes no part.  Vectors of different
    lengths have no product and never meet; two vectors without a component score 0.  Components
    beyond 2^53 after scaling count as 2^53, scores beyond 64 bits as the largest number.

    A row's rivals are all other rows, also equal ones and those of the same id; equal scores go by
    the smaller vec_id, a null id last.  Of several anchors of one id each has its own lines.  An
    anchor without positives, or a positive without a fitting row, has no line; no rows, no lines.
    """
    spark = rows.sparkSession
    vectors = indexed(rows, anchor, settings)
    anchors = vectors.filter("anchor")
    bytes_ = anchors.agg(F.sum(8 * (1 + F.size("values") + F.size("means")))).first()[0] or 0
    n = max(1, math.ceil(bytes_ / settings.block_bytes))
    out = None
    for k in range(n):
        mine = anchors.filter(F.pmod(F.xxhash64("uid"), F.lit(n)) == k).select("uid", "vec_id", "label", "values", "means", "deviations").toArrow()
        if not mine.num_rows:
            continue
        parts = {v.values.shape[1]: v for _, v in _rows(mine.combine_chunks().to_batches()[0], settings)}
        asked = {d: Block(v, np.full((len(v), 1), -LONG), np.full((len(v), 1), LONG), True, settings.positives) for d, v in parts.items()}
        positives = base.written(_lists(vectors, asked, settings), "positives")
        near = positives.select("anchor", "rank", "score").toArrow()  # at most ``positives`` rows of an anchor of the block
        bands = {d: _bands(v, near, settings) for d, v in parts.items()}
        negatives = _lists(vectors, bands, settings)
        negatives = negatives.select("anchor", (F.col("list") + 1).alias("positive_rank"), F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
        known = positives.select("anchor", F.col("rank").alias("positive_rank"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
        named = known.join(vectors.filter("anchor").select(F.col("uid").alias("anchor"), F.col("vec_id").alias("anchor_id")), "anchor")
        lines = base.written(negatives.join(named, ["anchor", "positive_rank"]), "hard-negatives")
        out = lines if out is None else out.union(lines)
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long, positive_rank int"
    if out is None:
        return spark.createDataFrame([], schema)
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score", F.col("positive_rank").cast("int").alias("positive_rank"))


def _bands(anchors: Vectors, near: pa.Table, settings: Settings) -> Block:
    """For each positive of an anchor, the scores that its negatives may have; an empty range where there is none."""
    low = np.full((len(anchors), settings.positives), LONG)
    high = np.full((len(anchors), settings.positives), -LONG)
    place = {int(u): k for k, u in enumerate(anchors.uid)}
    for anchor, rank, score in zip(*(near[c].to_pylist() for c in ("anchor", "rank", "score"))):
        if anchor in place:
            at = place[anchor], rank - 1
            low[at] = max(-LONG, -(-settings.low * score // 100))
            high[at] = min(LONG, settings.high * score // 100)
    return Block(anchors, low, high, False, settings.negatives)
