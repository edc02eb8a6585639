"""N-gram Jaccard join with Bayesian candidate pruning.

Which documents have a Jaccard similarity of at least ``threshold`` between
their sets of five-word shingles (words are runs of letters, digits and
non-ASCII characters, A-Z lowered)?

1. Every text is read once: a fingerprint of its word sequence, the number of
   shingles and ``HASHES`` MinHash values. Texts with the same words are one
   node from here on; copies are counted, never paired.
2. ``BANDS`` bands of MinHash values deal the nodes into buckets. Buckets
   with the same members are looked at once. A bucket is cut into blocks of
   at most ``BLOCK`` nodes, and each pair of blocks is a group of its own, so
   that no task gets a whole hot bucket.
3. Inside a group, pairs are compared ``STEP`` MinHash values at a time; after
   each step a pair is dropped when the posterior probability that its
   similarity reaches the threshold (uniform prior) is below ``tolerance``.
   Surviving pairs leave the task as a spanning forest, not as pairs.
4. The forest's components are small sets of alike texts. They are verified
   exactly, block by block, on the complete shingle sets: every pair inside a
   component that was a candidate is among them. Links are counted where they
   are found; only counts and a spanning forest leave the task.

``links`` gives one row a document: class_id (the smallest doc_id that it is
connected to by links), n_links (other documents at or above the threshold,
copies included), class_size.

Defined cases: a text of fewer than five words is one shingle; a null text or
one without a word links to nothing; null and repeated ids are documents like
others (class_id ignores null unless all are null); an empty table gives an
empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import (
    ALNUM,
    U64,
    blocks,
    components,
    cut,
    forest,
    group_starts,
    map_arrow,
    mix,
    powers,
    shingle_hashes,
    text_bytes,
    whole_groups,
    word_hashes,
)

THRESHOLD = 0.8
TOLERANCE = 1e-4
ROWS = 4
BANDS = 20
HASHES = ROWS * BANDS
STEP = 16
BLOCK = 256
#: Shingles in a block of exact verification, about.
BLOCK_SHINGLES = 400_000

_MULT = mix(np.arange(1, HASHES + 1, dtype=U64) * U64(0xD1342543DE82EF95)) | U64(1)


def least_matches(threshold: float, tolerance: float) -> dict[int, int]:
    """n -> fewest matches among n MinHash values with which a pair goes on.

    With a uniform prior, P(similarity >= t | m of n match) is the probability
    of at most m successes in n + 1 draws of probability t.
    """
    out = {}
    for n in range(STEP, HASHES + 1, STEP):
        p = m = 0
        while True:
            p += math.comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
            if p >= tolerance:
                break
            m += 1
        out[n] = m
    return out


def signatures(shingles: np.ndarray, first: np.ndarray) -> np.ndarray:
    """(texts, HASHES) uint32 MinHash values; texts without shingles get zeros."""
    n = len(first) - 1
    sig = np.zeros((n, HASHES), np.uint32)
    full = np.flatnonzero(np.diff(first) > 0)
    if len(full):
        at = first[full]
        for k in range(HASHES):
            sig[full, k] = np.minimum.reduceat(((shingles * _MULT[k]) >> U64(32)).astype(np.uint32), at)
    return sig


def _fingerprints(words: np.ndarray, first: np.ndarray):
    """Two 64-bit hashes of each text's word sequence."""
    up, down = powers(len(words) + 1)
    out = []
    for h in (words, mix(words ^ U64(0x5851F42D4C957F2D))):
        sums = np.zeros(len(words) + 1, U64)
        np.cumsum(h * up[:len(words)], out=sums[1:])
        out.append(mix((sums[first[1:]] - sums[first[:-1]]) * down[first[:-1]] + np.diff(first).astype(U64)))
    return out


def _read(batches):
    """(doc_id, tk, text) -> fingerprint, shingle count, MinHash values, band keys."""
    for batch in batches:
        data, off = text_bytes(batch.column("text"))
        for i, j in blocks(off):
            words, first = word_hashes(data[off[i]:off[j]], off[i:j + 1] - off[i], ALNUM)
            sh, at = shingle_hashes(words, first)
            f1, f2 = _fingerprints(words, first)
            sig = signatures(sh, at)
            band = np.zeros((j - i, BANDS), U64)
            for b in range(BANDS):
                h = np.full(j - i, U64(b + 1))
                for r in range(ROWS):
                    h = mix(h ^ sig[:, b * ROWS + r].astype(U64))
                band[:, b] = h
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").slice(i, j - i), batch.column("tk").slice(i, j - i),
                pa.array(f1.view(np.int64)), pa.array(f2.view(np.int64)), pa.array(np.diff(at).astype(np.int64)),
                pa.array([s.tobytes() for s in sig], pa.binary()),
                pa.ListArray.from_arrays(pa.array(np.arange(j - i + 1, dtype=np.int32) * BANDS),
                                         pa.array(band.reshape(-1).view(np.int64))),
            ], ["doc_id", "tk", "f1", "f2", "n_sh", "sig", "bands"])


def _block_pairs(n_blocks: str, salt: str):
    """Columns: own block, and the block pairs a row takes part in."""
    own = F.expr(f"pmod(xxhash64({salt}, 11L), {n_blocks})")
    pairs = F.expr(f"transform(sequence(0L, {n_blocks} - 1L), j -> struct(least(own, j) AS lo, greatest(own, j) AS hi))")
    return own, pairs


def _pairs_of(group: np.ndarray, cross: np.ndarray, own: np.ndarray):
    """All index pairs inside groups (runs of equal ``group``), in slices of
    equal distance; in a group of two blocks only pairs across them."""
    n, d = len(group), 1
    live = np.arange(n)
    while True:
        live = live[live + d < n]
        live = live[group[live] == group[live + d]]
        if len(live) == 0:
            return
        ok = ~cross[live] | (own[live] != own[live + d])
        yield live[ok], live[ok] + d
        d += 1


def _prune(threshold: float, tolerance: float):
    need = least_matches(threshold, tolerance)

    def run(batches):
        keys = ["bucket", "lo", "hi"]
        for t in whole_groups(batches, keys):
            starts = group_starts(t, keys)
            group = np.zeros(t.num_rows, np.int64)
            group[starts] = 1
            group = np.cumsum(group)
            own = t.column("own").to_numpy()
            cross = t.column("lo").to_numpy() != t.column("hi").to_numpy()
            node = t.column("node").to_numpy()
            sig = np.frombuffer(b"".join(t.column("sig").to_pylist()), np.uint32).reshape(-1, HASHES)
            ea, eb = [], []
            for a, b in _pairs_of(group, cross, own):
                match = np.zeros(len(a), np.int64)
                for n in range(STEP, HASHES + 1, STEP):
                    match += (sig[a, n - STEP:n] == sig[b, n - STEP:n]).sum(1)
                    go = match >= need[n]
                    a, b, match = a[go], b[go], match[go]
                ea.append(a)
                eb.append(b)
            if not ea:
                continue
            # a node may stand in several rows: join them through its first row
            _, at, same = np.unique(node, return_index=True, return_inverse=True)
            root = forest(len(at), same[np.concatenate(ea)], same[np.concatenate(eb)])
            names = node[at]
            ok = root != np.arange(len(at))
            yield pa.RecordBatch.from_arrays([pa.array(names[ok]), pa.array(names[root[ok]])], ["a", "b"])

    return run


def _shingle_sets(batches):
    """(node, text) -> (node, sorted different shingles)."""
    for batch in batches:
        data, off = text_bytes(batch.column("text"))
        for i, j in blocks(off):
            words, first = word_hashes(data[off[i]:off[j]], off[i:j + 1] - off[i], ALNUM)
            sh, at = shingle_hashes(words, first)
            sets = [np.unique(sh[p:q]) for p, q in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([
                batch.column("node").slice(i, j - i),
                pa.array([s.tobytes() for s in sets], pa.binary())], ["node", "shingles"])


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of the sets, by incidence matrix in column
    blocks; a shingle of one set only is left out, as it is in no intersection."""
    m = len(sets)
    owner = np.repeat(np.arange(m), [len(s) for s in sets])
    values = np.concatenate(sets) if m else np.zeros(0, U64)
    _, col, times = np.unique(values, return_inverse=True, return_counts=True)
    rank = np.cumsum(times > 1) - 1
    ok = times[col] > 1
    owner, col = owner[ok], rank[col[ok]]
    out = np.zeros((m, m))
    width = max(256, (4 << 20) // max(m, 1))
    order = np.argsort(col, kind="stable")
    owner, col = owner[order], col[order]
    for lo in range(0, int(col[-1]) + 1 if len(col) else 0, width):
        p, q = np.searchsorted(col, [lo, lo + width])
        part = np.zeros((m, width), np.float32)
        part[owner[p:q], col[p:q] - lo] = 1
        out += part @ part.T
    return out


def _verify(threshold: float):
    def run(batches):
        keys = ["cluster", "lo", "hi"]
        for t in whole_groups(batches, keys, rows=2_000):
            starts = np.append(group_starts(t, keys), t.num_rows)
            own, node = t.column("own").to_numpy(), t.column("node").to_numpy()
            lo, hi = t.column("lo").to_numpy(), t.column("hi").to_numpy()
            copies = t.column("copies").to_numpy()
            raw = t.column("shingles")
            links = np.zeros(t.num_rows, np.int64)
            up = np.arange(t.num_rows)
            for p, q in zip(starts[:-1], starts[1:], strict=True):
                sets = [np.frombuffer(raw[k].as_buffer(), U64) for k in range(p, q)]
                size = np.array([len(s) for s in sets], float)
                inter = overlaps(sets)
                linked = inter >= threshold * (size[:, None] + size[None, :] - inter) - 1e-9
                np.fill_diagonal(linked, False)
                if lo[p] != hi[p]:
                    linked &= own[p:q, None] != own[None, p:q]
                links[p:q] = linked @ copies[p:q]
                up[p:q] = p + forest(q - p, *np.nonzero(linked))
            yield pa.RecordBatch.from_arrays(
                [pa.array(node), pa.array(node[up]), pa.array(links)], ["node", "up", "links"])

    return run


def _linked(docs: DataFrame, threshold: float, tolerance: float, id_col: str, text_col: str) -> DataFrame:
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    own_docs = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("tk"),
                           F.col(text_col).alias("text"))
    id_type = own_docs.schema["doc_id"].dataType.simpleString()
    meta = cut(own_docs.transform(map_arrow, _read, f"doc_id {id_type}, tk long, f1 long, f2 long, n_sh long, sig binary, "
                                          "bands array<long>"), "minhash")
    wordy = meta.filter("n_sh > 0")
    nodes = (wordy.groupBy("f1", "f2").agg(F.min(F.struct("doc_id", "tk")).alias("rep"), F.count(F.lit(1)).alias("copies"),
                                           F.first("n_sh").alias("n_sh"))
             .withColumn("node", F.monotonically_increasing_id()))
    nodes = cut(nodes.select("f1", "f2", "rep.doc_id", "rep.tk", "copies", "n_sh", "node"), "nodes")

    # one signature a node
    sigs = (wordy.alias("w").join(nodes.select("f1", "f2", "node", "doc_id", "tk").alias("n"),
                                  (F.col("w.f1") == F.col("n.f1")) & (F.col("w.f2") == F.col("n.f2"))
                                  & F.col("w.doc_id").eqNullSafe(F.col("n.doc_id")) & (F.col("w.tk") == F.col("n.tk")))
            .select("node", "sig", "bands").dropDuplicates(["node"]))
    sigs = cut(sigs, "node-sigs")
    dealt = sigs.select("node", F.explode("bands").alias("bucket"))
    full = (dealt.groupBy("bucket").agg(F.count(F.lit(1)).alias("m"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("s"),
                                        F.bit_xor(F.xxhash64("node", F.lit(3))).alias("x"))
            .filter("m > 1"))
    # buckets with the same members count once
    full = full.groupBy("m", "s", "x").agg(F.min("bucket").alias("bucket")).select(
        "bucket", F.expr(f"(m + {BLOCK - 1}) div {BLOCK}").alias("nb"))
    own, pairs = _block_pairs("nb", "node")
    members = (dealt.join(full, "bucket").withColumn("own", own)
               .select("bucket", "node", "own", F.explode(pairs).alias("p"))
               .select("bucket", "node", "own", "p.lo", "p.hi"))
    keys = ["bucket", "lo", "hi"]
    near = (members.join(sigs.select("node", "sig"), "node").repartition(parts, *keys).sortWithinPartitions(*keys)
            .transform(map_arrow, _prune(threshold, tolerance), "a long, b long"))
    cluster = cut(components(near).withColumnRenamed("root", "cluster"), "clusters")

    # exact verification inside the clusters, on the texts of their nodes
    size = cluster.join(nodes.select("node", "n_sh"), "node").groupBy("cluster").agg(
        F.greatest(F.expr(f"(count(1) + {BLOCK - 1}) div {BLOCK}"),
                   F.expr(f"(sum(n_sh) + {BLOCK_SHINGLES - 1}) div {BLOCK_SHINGLES}")).alias("nb"))
    wanted = cluster.join(nodes.select("node", "doc_id", "tk", "copies"), "node").join(size, "cluster")
    sets = (own_docs.alias("d").join(wanted.select("node", "doc_id", "tk").alias("w"),
                                     (F.col("d.tk") == F.col("w.tk"))
                                     & F.col("d.doc_id").eqNullSafe(F.col("w.doc_id")))
            .select("node", "text").dropDuplicates(["node"]).transform(map_arrow, _shingle_sets, "node long, shingles binary"))
    own, pairs = _block_pairs("nb", "node")
    keys = ["cluster", "lo", "hi"]
    dealt = (sets.join(wanted.select("node", "cluster", "copies", "nb").withColumn("own", own), "node")
             .select("cluster", "node", "copies", "own", "shingles", F.explode(pairs).alias("p"))
             .select("cluster", "node", "copies", "own", "shingles", "p.lo", "p.hi"))
    found = cut(dealt.repartition(parts, *keys).sortWithinPartitions(*keys)
                .transform(map_arrow, _verify(threshold), "node long, up long, links long"), "links")
    count = found.groupBy("node").agg(F.sum("links").alias("links"))
    root = components(found.select(F.col("node").alias("a"), F.col("up").alias("b")))

    of = (nodes.select("f1", "f2", "node", "copies").join(count, "node", "left").join(root, "node", "left")
          .select("f1", "f2", "copies", F.coalesce("root", "node").alias("root"),
                  (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    each = cut(meta.select("doc_id", "tk", "f1", "f2", "n_sh").join(of, ["f1", "f2"], "left")
               .withColumn("root", F.when(F.col("n_sh") > 0, F.col("root")))
               .select("doc_id", "tk", "root", "n_links"), "doc-links")
    classes = (each.filter("root is not null").groupBy("root")
               .agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tk")).alias("first"),
                    F.count(F.lit(1)).alias("class_size"))
               .select("root", "class_size", F.col("first.doc_id").alias("class_id"), F.col("first.tk").alias("class_tk")))
    out = each.join(classes, "root", "left")
    lone = F.col("root").isNull()
    kept = F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("tk") == F.col("class_tk"))
    return out.select("doc_id", "tk", F.when(lone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
                      F.when(lone, F.lit(0)).otherwise(F.col("n_links")).cast("long").alias("n_links"),
                      F.when(lone, F.lit(1)).otherwise(F.col("class_size")).cast("long").alias("class_size"),
                      (lone | kept).alias("kept"))


def links(docs: DataFrame, *, threshold: float = THRESHOLD, tolerance: float = TOLERANCE,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id, n_links, class_size, kept."""
    return _linked(docs, threshold, tolerance, id_col, text_col).drop("tk")


def representatives(docs: DataFrame, *, threshold: float = THRESHOLD, tolerance: float = TOLERANCE,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with their own columns: of each class
    the document with the smallest id. Rows repeated with the same id and text
    are one document and stay together."""
    gone = (_linked(docs, threshold, tolerance, id_col, text_col).filter("not kept")
            .select(F.col("doc_id").alias("_id"), F.col("tk").alias("_tk")).distinct())
    return docs.join(gone, F.col(id_col).eqNullSafe(F.col("_id")) & (F.xxhash64(text_col) == F.col("_tk")), "left_anti")
