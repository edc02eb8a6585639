"""Exact n most similar vectors by cosine: a pivot index read block by block.

A vector has numeric parts in fixed point (``z``, ``SCALE`` to the unit) and
one-hot parts given by the number of the hot place (``codes``), so products of
vectors are integers and equal vectors have equal cosines everywhere.

On unit vectors the cosine is a distance, d^2 = 2 - 2 cos, and pivots bound it:
|d(q, p) - d(x, p)| <= d(q, x).

1. Pivots are far-apart vectors of a bounded sample (they decide how fast,
   never what is found). Vectors are put in the order of their three nearest
   pivots and cut into blocks of equal size, however many share a pivot.
2. A block keeps, for each pivot, the least and largest distance of its vectors.
   Two blocks are at least as far apart as the gap between their ranges, for
   any pivot.
3. Each block is searched in itself first, which gives every vector a radius,
   the distance of its n-th best so far. The blocks within the largest radius
   are found by a join on intervals of pivot distance and read in rounds of
   rising bound (2, 4, 8, ... blocks); a block's search ends when the next bound is
   beyond its radius. No step looks at all pairs of vectors.

The index is written (checkpoint) and every round's state too, so a lost executor
repeats one round at most.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mercato.operators.indexing import dense_index
from mercato.operators.topk import empty_lists, merge_best
from mercato.session import ship

SCALE = 10_000
BLOCK = 512
PIVOTS = 24
SAMPLE = 2000  # vectors that pivots are chosen from
ROUND_BLOCKS = 64  # at most read for a block in one round
_BINS = 32  # intervals of a pivot distance, which lies in 0 .. 2
_EPS = 1e-6  # more than the rounding of distances

_BLOCK = "block int, ids binary, z binary, codes binary, size binary, ask binary, asked int, pivot int, lo array<double>, hi array<double>"


def _ints(batch, name: str) -> np.ndarray:
    col = batch.column(name)
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    return col.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(batch.num_rows, -1)


def sizes(z: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Lengths of the vectors."""
    return np.sqrt(((z * z).sum(1) + codes.shape[1] * SCALE * SCALE).astype(np.float64))


def cosines(z1, codes1, size1, z2, codes2, size2) -> np.ndarray:
    """Cosine of every vector of the first set with every one of the second; sums of integers, so
    that equal vectors get equal numbers wherever they stand."""
    if size1.max(initial=0.0) * size2.max(initial=0.0) < 2.0 ** 52:
        # no sum of products, in whatever order, exceeds the product of two lengths: exact as floats
        dot = z1.astype(np.float64) @ z2.astype(np.float64).T
    else:
        dot = np.zeros((len(z1), len(z2)), np.int64)
        for k in range(z1.shape[1]):
            dot += z1[:, k, None] * z2[None, :, k]
    for k in range(codes1.shape[1]):
        dot += SCALE * SCALE * (codes1[:, k, None] == codes2[None, :, k])
    return dot / (size1[:, None] * size2[None, :])


def distances(cos: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * cos))


def choose_pivots(z: np.ndarray, codes: np.ndarray, n: int) -> np.ndarray:
    """Places of at most n vectors, each the farthest from those before."""
    size = sizes(z, codes)
    far, chosen = np.full(len(z), np.inf), []
    at = 0
    while len(chosen) < min(n, len(z)) and far[at] > 0:
        chosen.append(at)
        far = np.minimum(far, distances(cosines(z[[at]], codes[[at]], size[[at]], z, codes, size))[0])
        at = int(np.argmax(far))
    return np.array(chosen, np.int64)


def build(vectors: DataFrame, key: str, block: int = BLOCK, pivots: int = PIVOTS) -> tuple[DataFrame, DataFrame]:
    """(blocks, ids) of the distinct vectors ``key, z array<bigint>, codes
    array<int>, ask boolean``; ``ids`` numbers the keys in their order."""
    ship(vectors.sparkSession)
    ids = dense_index(vectors, key, "_id")
    rows = vectors.join(ids, key).select("_id", "z", "codes", "ask").checkpoint()
    some = rows.orderBy(F.md5(F.col("_id").cast("string")), "_id").limit(SAMPLE).select("z", "codes").toArrow()  # SAMPLE rows
    if some.num_rows == 0:
        return vectors.sparkSession.createDataFrame([], _BLOCK), ids
    z0, c0 = _ints(some, "z"), _ints(some, "codes")
    at = choose_pivots(z0, c0, pivots)
    pz, pc = z0[at], c0[at]
    ps = sizes(pz, pc)

    def place(batches):
        for b in batches:
            if b.num_rows == 0:
                continue
            z, c = _ints(b, "z"), _ints(b, "codes")
            d = distances(cosines(z, c, sizes(z, c), pz, pc, ps))
            near = np.argsort(d, axis=1, kind="stable")[:, :3]
            order = np.zeros(b.num_rows, np.int64)
            for k in range(near.shape[1]):
                order = order * len(pz) + near[:, k]
            order = (order << 32) + (d[np.arange(len(d)), near[:, 0]] * (1 << 30)).astype(np.int64)
            dist = pa.ListArray.from_arrays(pa.array((np.arange(len(d) + 1) * d.shape[1]).astype(np.int32)), pa.array(d.ravel()))
            yield pa.RecordBatch.from_arrays([b.column("_id"), pa.array(order), b.column("z"), b.column("codes"), b.column("ask"),
                                              dist], ["_id", "order", "z", "codes", "ask", "dist"])

    placed = rows.mapInArrow(place, "_id int, order long, z array<bigint>, codes array<int>, ask boolean, dist array<double>").withColumn(
        "_o", F.struct("order", "_id"))
    placed = placed.join(dense_index(placed, "_o", "_place"), "_o").withColumn("block", F.floor(F.col("_place") / block).cast("int"))

    def pack(t: pa.Table) -> pa.Table:
        t = t.sort_by("_place")
        z, c = _ints(t, "z"), _ints(t, "codes")
        d = t.column("dist").combine_chunks().flatten().to_numpy().reshape(t.num_rows, -1)
        ask = t.column("ask").to_numpy(zero_copy_only=False).astype(np.uint8)
        out = [t.column("block")[0].as_py(), t.column("_id").to_numpy().astype(np.int64).tobytes(), z.tobytes(), c.tobytes(),
               sizes(z, c).tobytes(), ask.tobytes(), int(ask.sum()), int(d[0].argmin()), d.min(0).tolist(), d.max(0).tolist()]
        types = [pa.int32(), *[pa.binary()] * 5, pa.int32(), pa.int32(), *[pa.list_(pa.float64())] * 2]
        return pa.table([pa.array([v], k) for v, k in zip(out, types, strict=True)],
                        names=["block", "ids", "z", "codes", "size", "ask", "asked", "pivot", "lo", "hi"])

    return placed.select("block", "_place", "_id", "z", "codes", "ask", "dist").groupBy("block").applyInArrow(pack, _BLOCK).checkpoint(), ids


class _Block:
    def __init__(self, row: dict):
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.z = np.frombuffer(row["z"], np.int64).reshape(len(self.ids), -1)
        self.codes = np.frombuffer(row["codes"], np.int64).reshape(len(self.ids), -1)
        self.size = np.frombuffer(row["size"], np.float64)
        self.ask = np.flatnonzero(np.frombuffer(row["ask"], np.uint8))

    def asked_against(self, other: _Block) -> np.ndarray:
        a = self.ask
        return cosines(self.z[a], self.codes[a], self.size[a], other.z, other.codes, other.size)


def _search(n: int):
    """A block's row with its lists so far, and the blocks to read -> the new lists and radius."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if left.num_rows == 0:
            return left.select(["block", "best_id", "best", "radius"])
        row = left.to_pylist()[0]
        own = _Block(row)
        best_id, best = empty_lists(len(own.ask), n)
        if row["best"] is not None:
            best_id = np.frombuffer(row["best_id"], np.int64).reshape(-1, n).copy()
            best = np.frombuffer(row["best"], np.float64).reshape(-1, n).copy()
        every = np.arange(len(own.ask))
        for other in right.sort_by("bound").to_pylist():
            if len(every):
                other = _Block(other)
                merge_best(best_id, best, every, other.ids, own.asked_against(other))
        worst = best[:, -1].min() if len(every) else 1.0
        radius = float(distances(np.array([worst]))[0]) if np.isfinite(worst) else 4.0  # 4: all blocks
        return pa.table([pa.array([row["block"]], pa.int32()), pa.array([best_id.tobytes()], pa.binary()),
                         pa.array([best.tobytes()], pa.binary()), pa.array([radius])], names=["block", "best_id", "best", "radius"])

    return run


_LISTS = "block int, best_id binary, best binary, radius double"


def near_blocks(blocks: DataFrame, radius: DataFrame) -> DataFrame:
    """(block, other, bound) of the blocks that may hold a vector within
    ``radius`` (block, radius) of one of the block's, itself left out.

    Joined on intervals of the distance to the other block's own pivot; a pair
    that shares several intervals counts in the first only.
    """
    bin_ = lambda c: F.greatest(F.lit(0), F.least(F.lit(_BINS - 1), F.floor(c * (_BINS / 2.0)))).cast("int")
    reach = F.col("radius") + _EPS
    ask = (blocks.where("asked > 0").select("block", "lo", "hi").join(radius, "block")
           .select("block", "lo", "hi", "radius", F.posexplode(F.arrays_zip("lo", "hi")).alias("pivot", "r"))
           .select("block", "lo", "hi", "radius", "pivot", bin_(F.col("r.lo") - reach).alias("first"),
                   bin_(F.col("r.hi") + reach).alias("last"))
           .withColumn("bin", F.explode(F.sequence("first", "last"))))
    own = F.col("pivot") + 1
    have = (blocks.select(F.col("block").alias("other"), "pivot", F.col("lo").alias("lo2"), F.col("hi").alias("hi2"))
            .withColumn("first2", bin_(F.element_at("lo2", own))).withColumn("last2", bin_(F.element_at("hi2", own)))
            .withColumn("bin", F.explode(F.sequence("first2", "last2"))))
    gap = F.array_max(F.zip_with(F.zip_with("lo2", "hi", lambda a, b: a - b), F.zip_with("lo", "hi2", lambda a, b: a - b),
                                 lambda x, y: F.greatest(x, y, F.lit(0.0))))
    return (ask.join(have, ["pivot", "bin"]).where((F.col("bin") == F.greatest("first", "first2")) & (F.col("block") != F.col("other")))
            .withColumn("bound", gap).where(F.col("bound") <= reach).select("block", "other", "bound"))


def nearest(vectors: DataFrame, key: str, n: int, block: int = BLOCK, pivots: int = PIVOTS) -> DataFrame:
    """``(key, other, cos)``: for each vector with ``ask`` true its n most
    similar vectors, itself among them, ties to the smaller key. ``vectors``
    has one row a key: ``key, z array<bigint>, codes array<int>, ask boolean``."""
    blocks, ids = build(vectors, key, block, pivots)
    step = _search(n)
    fresh = lambda df: df.toDF(*df.columns)  # noqa: E731  both sides of a cogroup come from one table
    start = blocks.withColumn("best_id", F.lit(None).cast("binary")).withColumn("best", F.lit(None).cast("binary"))
    read = fresh(blocks.withColumn("bound", F.lit(0.0)))
    state = start.groupBy("block").cogroup(read.groupBy("block")).applyInArrow(step, _LISTS).checkpoint()
    pairs = near_blocks(blocks, state.select("block", "radius"))
    pairs = pairs.withColumn("turn", F.row_number().over(Window.partitionBy("block").orderBy("bound", "other"))).checkpoint()
    turns = pairs.agg(F.max("turn")).first()[0] or 0
    done, width = 0, 2
    while done < turns:
        now = (pairs.where(F.col("turn").between(done + 1, done + width)).join(state.select("block", "radius"), "block")
               .where(F.col("bound") <= F.col("radius") + _EPS).select(F.col("block").alias("asking"), F.col("other").alias("block"), "bound"))
        read = fresh(now.join(blocks, "block").drop("block").withColumnRenamed("asking", "block"))
        after = (blocks.join(state.drop("radius"), "block").groupBy("block").cogroup(read.groupBy("block"))
                 .applyInArrow(step, _LISTS)).checkpoint()
        done, width, state = done + width, min(2 * width, ROUND_BLOCKS), after
        open_ = (pairs.where(F.col("turn") == done + 1).join(state.select("block", "radius"), "block")
                 .where(F.col("bound") <= F.col("radius") + _EPS))
        if open_.isEmpty():  # bounds rise with the turn
            break

    def unpack(batches):
        for b in batches:
            for row in b.to_pylist():
                own = np.frombuffer(row["ids"], np.int64)[np.flatnonzero(np.frombuffer(row["ask"], np.uint8))]
                best_id = np.frombuffer(row["best_id"], np.int64).reshape(-1, n)
                best = np.frombuffer(row["best"], np.float64).reshape(-1, n)
                r, c = np.nonzero(np.isfinite(best))
                yield pa.RecordBatch.from_arrays([pa.array(own[r].astype(np.int32)), pa.array(best_id[r, c].astype(np.int32)),
                                                  pa.array(best[r, c])], ["_id", "_other", "cos"])

    found = blocks.select("block", "ids", "ask").join(state, "block").select("ids", "ask", "best_id", "best").mapInArrow(
        unpack, "_id int, _other int, cos double")
    return (found.join(ids, "_id").join(ids.select(F.col("_id").alias("_other"), F.col(key).alias("other")), "_other")
            .select(key, "other", "cos"))
