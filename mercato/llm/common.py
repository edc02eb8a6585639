"""Helpers shared by the operators: written cut points and numpy text hashing.

Text helpers work on whole Arrow batches: the bytes of many texts lie in one
buffer, words and their 64-bit hashes are found by array operations, and no
Python loop runs over characters or words. Equal words always get equal
hashes; two different words share one with probability 2^-64 a pair.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.session import ensure_checkpoint_dir, ship

U64 = np.uint64

#: Bytes of text handled at once inside a task (one longer text is its own block).
BLOCK_BYTES = 1_000_000


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that ``spark.checkpoint.dir`` names."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str = "cut") -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: ends its
    lineage, so a lost executor never repeats what came before."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def map_arrow(df: DataFrame, fn: Callable, schema) -> DataFrame:
    """``df.mapInArrow`` with this package at hand in the tasks."""
    ship(df.sparkSession)
    return df.mapInArrow(fn, schema)


def crc_mod(id_col: str, n: int):
    """crc32(id as text) mod n; null for a null id."""
    return F.crc32(F.col(id_col).cast("string")) % F.lit(n)


def learnable(id_col: str, n: int, held: int):
    """True where the row may be learned from (a row without id never is)."""
    return F.coalesce(crc_mod(id_col, n) != F.lit(held), F.lit(False))


def held_out(id_col: str, n: int, held: int):
    return F.coalesce(crc_mod(id_col, n) == F.lit(held), F.lit(False))


# ----------------------------------------------------------------- numpy text
def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = pc.fill_null(col.cast(pa.large_string()), "")
    if len(col) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = col.buffers()
    off = np.frombuffer(off, np.int64)[col.offset:col.offset + len(col) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def blocks(off: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes (or a single row) covering all rows."""
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = j


_WS = np.zeros(256, bool)
_WS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
#: Bytes of words: not white space; or letters, digits and non-ASCII only.
SPACED = ~_WS
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True

_BASE = U64(0x9E3779B97F4A7C15)
_INV = U64(pow(int(_BASE), -1, 1 << 64))
_POW = [np.ones(1, U64), np.ones(1, U64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the hash base and of its inverse, mod 2^64."""
    if len(_POW[0]) < n:
        size = 1 << (n - 1).bit_length()
        for k, b in ((0, _BASE), (1, _INV)):
            steps = np.full(size, b, U64)
            steps[0] = U64(1)
            _POW[k] = np.cumprod(steps)
    return _POW[0][:n], _POW[1][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes (a bijection)."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h ^= h >> U64(27)
    h *= U64(0x94D049BB133111EB)
    h ^= h >> U64(31)
    return h


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans [start, end)."""
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, U64)
    np.cumsum((data.astype(U64) + U64(1)) * up[:len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(U64))


def word_spans(data: np.ndarray, off: np.ndarray, kind: np.ndarray = SPACED):
    """(starts, ends, first): byte spans of all words, and for each text the
    index of its first word (one entry more than texts)."""
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(off), np.int64)
    inside = kind[data]
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    before[off[:-1][off[:-1] < n]] = False
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    after[off[1:][off[1:] > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, off)


def word_hashes(data: np.ndarray, off: np.ndarray, kind: np.ndarray = SPACED):
    """(hashes, first): hash of each word with A-Z lowered; texts as in word_spans."""
    low = _LOWER[data]
    starts, ends, first = word_spans(low, off, kind)
    return span_hashes(low, starts, ends), first


def shingle_hashes(words: np.ndarray, first: np.ndarray, size: int = 5):
    """(hashes, first) of the ``size``-word shingles of each text, in order.

    A text with fewer words than ``size``, but at least one, has one shingle:
    all its words.
    """
    count = np.diff(first)
    n_sh = np.where(count >= size, count - size + 1, np.minimum(count, 1))
    at = np.zeros(len(first), np.int64)
    np.cumsum(n_sh, out=at[1:])
    total = int(at[-1])
    if total == 0:
        return np.zeros(0, U64), at
    doc = np.repeat(np.arange(len(count)), n_sh)
    begin = first[doc] + np.arange(total) - at[doc]
    last = first[doc + 1]
    h = np.zeros(total, U64)
    padded = np.concatenate([words, np.zeros(size, U64)])
    for k in range(size):
        own = begin + k < last
        h = h * _BASE + np.where(own, padded[begin + k] | U64(1), U64(0))
    return mix(h), at


def arrow_strings(values) -> pa.Array:
    return pa.array(values, pa.string())


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str], rows: int = 20_000) -> Iterator[pa.Table]:
    """Tables of about ``rows`` rows that never end inside a group; the input
    must be sorted by ``keys``. The rest of an open group is carried on."""
    held: list[pa.Table] = []
    n = 0
    for batch in batches:
        held.append(pa.Table.from_batches([batch]))
        n += batch.num_rows
        if n < rows:
            continue
        t = pa.concat_tables(held).combine_chunks()
        change = np.zeros(t.num_rows, bool)
        for k in keys:
            v = t.column(k).to_numpy()
            change[1:] |= v[1:] != v[:-1]
        at = np.flatnonzero(change)
        if len(at) == 0:
            held = [t]
            continue
        yield t.slice(0, at[-1])
        held, n = [t.slice(at[-1])], t.num_rows - int(at[-1])
    if held:
        t = pa.concat_tables(held).combine_chunks()
        if t.num_rows:
            yield t


def group_starts(t: pa.Table, keys: list[str]) -> np.ndarray:
    """Index of the first row of each group of a sorted table."""
    change = np.zeros(t.num_rows, bool)
    change[:1] = True
    for k in keys:
        v = t.column(k).to_numpy()
        change[1:] |= v[1:] != v[:-1]
    return np.flatnonzero(change)


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest member index of the component of each of n nodes (edges a-b)."""
    root = np.arange(n)
    while len(a):
        ra, rb = root[a], root[b]
        low, high = np.minimum(ra, rb), np.maximum(ra, rb)
        open_ = low < high
        if not open_.any():
            break
        a, b = a[open_], b[open_]
        np.minimum.at(root, high[open_], low[open_])
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
    return root


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(a, b) edges between bigint nodes -> (node, root): smallest node of each
    connected component, for every node on an edge.

    Alternating large-star and small-star rounds; every round is written, so a
    lost executor repeats one round at most. A node with very many neighbours
    is only ever aggregated (map-side) and joined, never collected.
    """
    edges = cut(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                .distinct(), "edges")

    def stamp(e: DataFrame):
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    seen = stamp(edges)
    for _ in range(max_rounds):
        both = edges.union(edges.select(F.col("b"), F.col("a"))).toDF("u", "v")
        low = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = (both.filter("v > u").join(low, "u").filter("v <> m")
                 .select(F.col("v").alias("a"), F.col("m").alias("b")).distinct())
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        pairs = large.join(low, "a")
        small = (pairs.select("a", F.col("m").alias("b")).union(pairs.filter("b <> m").select(F.col("b"), F.col("m")))
                 .distinct())
        edges = cut(small, "edges")
        now = stamp(edges)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components did not settle")
    return (edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
            .union(edges.select(F.col("b"), F.col("b")).distinct()))


# ------------------------------------------------- Bloom filter of fixed size
BLOOM_BITS = 24
BLOOM_PROBES = 3


def _probe(keys: np.ndarray, k: int) -> np.ndarray:
    """Bit position of probe k."""
    return (keys >> U64(k * 20)) & U64((1 << BLOOM_BITS) - 1) if k < 2 else mix(keys) & U64((1 << BLOOM_BITS) - 1)


def bloom(keys: DataFrame) -> np.ndarray:
    """Bloom filter bits of the bigint column ``key``, as bytes: built by an aggregate over words of 64 bits,
    of which there are 2^BLOOM_BITS / 64 whatever the number of keys."""

    def places(batches):
        for batch in batches:
            k = batch.column("key").to_numpy(zero_copy_only=False).view(U64)
            pos = np.unique(np.concatenate([_probe(k, i) for i in range(BLOOM_PROBES)])).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(pos >> 6), pa.array(pos & 63)], ["word", "bit"])

    words = (keys.transform(map_arrow, places, "word long, bit long").groupBy("word")
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit as int))")).alias("bits")).toArrow())
    bits = np.zeros((1 << BLOOM_BITS) // 64, np.int64)
    if words.num_rows:
        bits[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return bits.view(np.uint8)


def bloom_hits(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Indices of the keys that pass the filter."""
    at = np.arange(len(keys))
    for k in range(BLOOM_PROBES):
        pos = _probe(keys[at], k)
        at = at[(bits[pos >> U64(3)] >> (pos & U64(7)).astype(np.uint8)) & 1 == 1]
    return at
