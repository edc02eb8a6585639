"""Benchmark decontamination: size-partitioned MinHash containment search.

Which documents contain at least ``threshold`` of the five-word shingles of a
benchmark item (words as in the Jaccard join: letters, digits, non-ASCII, A-Z
lowered)? A short item inside a long document has a tiny Jaccard similarity to
it, so sizes are brought together first:

1. Items are partitioned by their number of shingles, sizes growing by the
   square root of 2. For each size class u, documents are read through windows
   of 2u shingles at a stride of u: a passage of an item of the class lies
   inside one of them, and a contained item has a Jaccard similarity of at
   least 0.26 to that window.
2. An item and a window meet if one of ``HASHES`` MinHash values agrees
   (a miss has probability (1 - 0.26)^32 < 1e-4 for an item at the threshold,
   and far less for a whole copy). The items' MinHash keys are put into a Bloom
   filter of fixed size (2 MB), the only thing that is
   broadcast; window keys that pass it are joined to the items' keys by an
   ordinary join, so a filter overfull of items costs time, never results.
3. Candidate (document, item) pairs are verified by the exact share of the
   item's shingles that the whole document contains.

An item of one to four words is one shingle of its own word count, in a size class
of its own (-1 to -4): every run of as many words of a document is a window, and
the item is contained where one equals it. MinHash of one shingle is its hash, so
one key does for all functions.

Defined cases: null or wordless texts and items contain nothing; repeated items and documents are reported each; null ids are carried as they
are; an empty table on either side gives no pair.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import ALNUM, U64, blocks, bloom, bloom_hits, cut, map_arrow, mix, shingle_hashes, text_bytes, word_hashes

THRESHOLD = 0.8
HASHES = 32
SHINGLE = 5

_MULT = mix(np.arange(1, HASHES + 1, dtype=U64) * U64(0x9FB21C651E98DF25)) | U64(1)


def size_class(n: np.ndarray) -> np.ndarray:
    """Class of items of n shingles: the smallest c with n <= 2^(c/2)."""
    return np.ceil(2 * np.log2(np.maximum(n, 1)) - 1e-9).astype(np.int64)


def stride(c: int) -> int:
    return int(np.ceil(2 ** (c / 2) - 1e-9))


def keys_of(minima: np.ndarray, k: int, c: int) -> np.ndarray:
    """Keys of values of MinHash function k in size class c."""
    tag = (k + 1) * 0xC2B2AE3D27D4EB4F + c * 0x165667B19E3779F9
    return mix(minima + U64(tag & 0xFFFFFFFFFFFFFFFF))


def _short(words, first, size: int):
    """(hashes, text) of the runs of ``size`` words, fewer than five, of every text."""
    sh, at = shingle_hashes(words, first, size)
    text = np.repeat(np.arange(len(first) - 1), np.diff(at))
    whole = np.diff(first)[text] >= size  # a text of fewer words has no such run
    # runs of different word counts are kept apart
    return mix(sh[whole] ^ U64(0xD6E8FEB86659FD93 + size)), text[whole]


def _item_shingles(words: np.ndarray):
    """(different shingles, size class) of the words of an item."""
    n = len(words)
    first = np.array([0, n])
    if n < SHINGLE:
        return _short(words, first, n)[0], -n
    own = np.unique(shingle_hashes(words, first, SHINGLE)[0])
    return own, int(size_class(np.array([len(own)]))[0])


def _key_list(own: np.ndarray, c: int) -> np.ndarray:
    """Search keys of an item."""
    if c < 0:
        return keys_of(own, 0, c)
    return np.concatenate([keys_of(np.min(own * _MULT[k], keepdims=True), k, c) for k in range(HASHES)])


def _uids(n: int, seen: int) -> pa.Array:
    return pa.array((TaskContext.get().partitionId() << 40) + seen + np.arange(n, dtype=np.int64))


def _items(batches):
    """(item_id, text) -> item row with keys and shingles."""
    seen = 0
    for batch in batches:
        data, off = text_bytes(batch.column("text"))
        for i, j in blocks(off):
            words, first = word_hashes(data[off[i]:off[j]], off[i:j + 1] - off[i], ALNUM)
            out = []
            for r in np.flatnonzero(np.diff(first)):
                own, c = _item_shingles(words[first[r]:first[r + 1]])
                out.append((i + r, c, _key_list(own, c).view(np.int64), own.view(np.int64)))
            if out:
                rows = pa.array([o[0] for o in out], pa.int64())
                yield pa.RecordBatch.from_arrays([
                    _uids(len(out), seen), batch.column("item_id").take(rows), pa.array([o[1] for o in out], pa.int32()),
                    pa.array([o[2] for o in out], pa.list_(pa.int64())),
                    pa.array([o[3] for o in out], pa.list_(pa.int64()))],
                    ["item", "item_id", "class", "keys", "shingles"])
                seen += len(out)


def _search(shared, classes: list[int]):
    def run(batches):
        bits = shared.value
        seen = 0
        for batch in batches:
            data, off = text_bytes(batch.column("text"))
            for i, j in blocks(off):
                words, first = word_hashes(data[off[i]:off[j]], off[i:j + 1] - off[i], ALNUM)
                sh, at = shingle_hashes(words, first, SHINGLE)
                count = np.diff(at)
                docs, keys = [], []
                short_docs, short = [], []
                cuts = {}
                for c in classes:
                    if c < 0:
                        run, doc = _short(words, first, -c)
                        own = keys_of(run, 0, c)
                        hit = bloom_hits(bits, own)
                        docs.append(doc[hit])
                        keys.append(own[hit])
                        short_docs.append(doc[hit])
                        short.append(run[hit])
                        continue
                    u = stride(c)
                    n_seg = -(-count // u)
                    doc = np.repeat(np.arange(j - i), n_seg)
                    begin = np.zeros(j - i + 1, np.int64)
                    np.cumsum(n_seg, out=begin[1:])
                    start = at[doc] + (np.arange(len(doc)) - begin[doc]) * u
                    # a window is a segment and the next one of the same text
                    pair = np.flatnonzero(doc[1:] == doc[:-1]) if len(doc) else np.zeros(0, np.int64)
                    cuts[c] = doc, start, pair
                for k in range(HASHES if len(sh) else 0):
                    value = sh * _MULT[k]
                    for c, (doc, start, pair) in cuts.items():
                        least = np.minimum.reduceat(value, start)
                        wide = least.copy()
                        wide[pair] = np.minimum(least[pair], least[pair + 1])
                        own = keys_of(wide, k, c)
                        hit = bloom_hits(bits, own)
                        docs.append(doc[hit])
                        keys.append(own[hit])
                if not docs:
                    continue
                docs, keys = np.concatenate(docs), np.concatenate(keys)
                short_docs = np.concatenate([np.zeros(0, np.int64), *short_docs])
                short = np.concatenate([np.zeros(0, U64), *short])[np.argsort(short_docs, kind="stable")]
                short_docs.sort()
                rows = np.unique(docs)
                low, high = (np.searchsorted(short_docs, rows, side) for side in ("left", "right"))
                if len(rows) == 0:
                    continue
                yield pa.RecordBatch.from_arrays([
                    _uids(len(rows), seen), batch.column("doc_id").take(pa.array(i + rows)),
                    batch.column("tk").take(pa.array(i + rows)),
                    pa.array([np.unique(keys[docs == r]).view(np.int64) for r in rows], pa.list_(pa.int64())),
                    pa.array([np.unique(np.concatenate([sh[at[r]:at[r + 1]], short[p:q]])).tobytes()
                              for r, p, q in zip(rows, low, high, strict=True)], pa.binary())],
                    ["doc", "doc_id", "tk", "keys", "shingles"])
                seen += len(rows)

    return run


def _contained(batches):
    """Shares of item shingles in the document's shingles."""
    for batch in batches:
        inside = batch.column("item_shingles").to_pylist()
        n = np.zeros(batch.num_rows, np.int64)
        for r, (have, want) in enumerate(zip(batch.column("shingles").to_pylist(), inside, strict=True)):
            have, want = np.frombuffer(have, U64), np.array(want, np.int64).view(U64)
            at = np.searchsorted(have, want)
            n[r] = (have[np.minimum(at, len(have) - 1)] == want).sum()
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("tk"), batch.column("item_id"),
             pa.array([len(w) for w in inside], pa.int64()), pa.array(n)],
            ["doc_id", "tk", "item_id", "n_item", "n_shared"])


def _leaks(docs, items, threshold, id_col, text_col, item_id_col, item_text_col):
    spark = docs.sparkSession
    item_type = items.schema[item_id_col].dataType.simpleString()
    id_type = docs.schema[id_col].dataType.simpleString()
    index = cut(items.select(F.col(item_id_col).alias("item_id"), F.col(item_text_col).alias("text"))
                .transform(map_arrow, _items, f"item long, item_id {item_type}, class int, keys array<long>, "
                                    "shingles array<long>"), "items")
    # at most twice the logarithm of the longest item
    classes = sorted(r[0] for r in index.select("class").distinct().collect())
    by_key = index.select("item", F.explode("keys").alias("key"))
    shared = spark.sparkContext.broadcast(bloom(by_key.select("key")))
    found = cut(docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("tk"),
                            F.col(text_col).alias("text"))
                .transform(map_arrow, _search(shared, classes), f"doc long, doc_id {id_type}, tk long, keys array<long>, "
                                                      "shingles binary"), "windows")
    pairs = found.select("doc", F.explode("keys").alias("key")).join(by_key, "key").select("doc", "item").distinct()
    checked = (pairs.join(found.select("doc", "doc_id", "tk", "shingles"), "doc")
               .join(index.select("item", "item_id", F.col("shingles").alias("item_shingles")), "item")
               .select("doc_id", "tk", "item_id", "shingles", "item_shingles")
               .transform(map_arrow, _contained, f"doc_id {id_type}, tk long, item_id {item_type}, n_item long, n_shared long"))
    return (checked.withColumn("containment", F.col("n_shared") / F.col("n_item"))
            .filter(F.col("containment") >= F.lit(threshold)))


def leaks(docs: DataFrame, items: DataFrame, *, threshold: float = THRESHOLD, id_col: str = "doc_id",
          text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, n_item, n_shared, containment) of every document that
    contains at least ``threshold`` of an item's shingles."""
    return _leaks(docs, items, threshold, id_col, text_col, item_id_col, item_text_col).drop("tk")


def clean(docs: DataFrame, items: DataFrame, *, threshold: float = THRESHOLD, id_col: str = "doc_id",
          text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with their own columns, that contain no item."""
    bad = (_leaks(docs, items, threshold, id_col, text_col, item_id_col, item_text_col)
           .select(F.col("doc_id").alias("_id"), F.col("tk").alias("_tk")).distinct())
    return docs.join(bad, F.col(id_col).eqNullSafe(F.col("_id")) & (F.xxhash64(text_col) == F.col("_tk")), "left_anti")
