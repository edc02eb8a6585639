"""Ranked lexical search: Block-Max MaxScore over a sharded block index.

``build_index`` makes one row for each term of each segment (a stretch of an
input partition of at most ``SEGMENT_BYTES`` of text): its postings in blocks
of ``BLOCK`` documents, the document numbers packed as 16-bit distances from the
block's first, and for each block its corners, the least document length for
each term frequency in it. As a score falls with the length and rises with the
frequency, the corners give the block's exact maximum whatever the corpus's
mean length turns out to be, so that the texts are read only once.

``search`` computes the global statistics from the index rows (documents,
terms, document frequencies of the terms asked for) and joins the items' terms
to their lists, items in blocks of bounded size. A task gets the lists of one
segment for one block of items, and for each item:

* orders the lists by their bound (weight times largest block maximum). Lists
  are essential as long as the bounds of the rest, summed, may still reach the
  10th best score found so far; essential lists are read whole;
* for the documents found there, sums the maxima of the blocks of the remaining
  lists that could hold them. Who can't reach the 10th best score is rejected
  before any of those blocks is unpacked;
* unpacks, list by list, only the blocks that surviving candidates fall into.

Each segment gives its 10 best of an item; a window merges them. Documents of a
segment are numbered in the order of doc_id, so ties fall to the smallest one;
scores are 64-bit integers, hence the same in any order of summing.

Defined cases: terms are the maximal runs of letters, digits and non-ASCII
characters, A-Z lowered; null and empty texts have none and are in no count;
every row is a document or item of its own, also with a repeated or null id
(null ids last among ties); an item without a known term has no rows; empty
tables give an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mercato.llm.common import _LOWER, ALNUM, blocks, cut, map_arrow, text_bytes, word_spans
from mercato.llm.words import span_ids
from mercato.session import ship

SEGMENT_BYTES = 24_000_000
SEGMENT_DOCS = 1 << 16  # distances within a segment fit 16 bits
BLOCK = 128
ITEMS_IN_BLOCK = 512
ITEM_CHARS_IN_BLOCK = 2_000_000
TOP = 10
#: Terms of a text, as a pattern over lower-cased text.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

_LISTS = "segment long, term string, df long, total long, base binary, docs binary, tf binary, tf_bytes int, corners binary"
_CORNER = np.dtype([("block", np.int32), ("tf", np.int32), ("n", np.int64)])


# ------------------------------------------------------------------ the index
class _Segment:
    """Postings of one segment while its texts are read."""

    def __init__(self):
        self.terms: list[pa.Array] = []  # distinct terms of each block of texts
        self.term: list[np.ndarray] = []
        self.doc: list[np.ndarray] = []
        self.tf: list[np.ndarray] = []
        self.ids: list[pa.Array] = []
        self.n: list[np.ndarray] = []
        self.n_docs = self.n_terms = self.size = 0

    def add(self, ids: pa.Array, data: np.ndarray, off: np.ndarray) -> None:
        low = _LOWER[data]
        starts, ends, first = word_spans(low, off, ALNUM)
        word = span_ids(low, starts, ends)
        n = np.diff(first)
        doc = np.repeat(np.arange(len(n)), n)
        key, tf = np.unique(word * len(n) + doc, return_counts=True)
        if len(word):
            _, at = np.unique(word, return_index=True)
            raw = low.tobytes()
            self.terms.append(pa.array([raw[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist(), strict=True)],
                                       pa.binary()))
            self.term.append(key // len(n) + self.n_terms)
            self.n_terms += len(at)
            self.doc.append(key % len(n) + self.n_docs)
            self.tf.append(tf)
        self.ids.append(ids)
        self.n.append(n)
        self.n_docs += len(n)
        self.size += len(data)

    def rows(self, segment: int, id_type: pa.DataType):
        """Record batches: one row of the documents, then one a term."""
        ids, n = pa.concat_arrays(self.ids), np.concatenate(self.n)
        order = pc.sort_indices(pa.table({"i": ids}), sort_keys=[("i", "ascending")], null_placement="at_end").to_numpy()
        number = np.empty(len(order), np.int64)
        number[order] = np.arange(len(order))  # by id, so that ties fall to the smaller number
        n = n[order]
        names = ["segment", "term", "df", "total", "base", "docs", "tf", "tf_bytes", "corners", "ids"]
        listed = pa.list_(id_type)
        yield pa.RecordBatch.from_arrays(
            [pa.array([segment]), pa.nulls(1, pa.string()), pa.array([int((n > 0).sum())]), pa.array([int(n.sum())]),
             pa.nulls(1, pa.binary()), pa.array([n.astype(np.int64).tobytes()], pa.binary()), pa.nulls(1, pa.binary()),
             pa.nulls(1, pa.int32()), pa.nulls(1, pa.binary()),
             pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids.take(pa.array(order))).cast(listed)], names)
        if not self.terms:
            return
        coded = pa.concat_arrays(self.terms).dictionary_encode()
        term = coded.indices.to_numpy().astype(np.int64)[np.concatenate(self.term)]
        doc, tf = number[np.concatenate(self.doc)], np.concatenate(self.tf)
        by = np.argsort(term * len(n) + doc, kind="stable")
        term, doc, tf = term[by], doc[by], tf[by]
        size = np.bincount(term, minlength=len(coded.dictionary))
        begin = np.concatenate([[0], np.cumsum(size)])
        inner = np.arange(len(term)) - begin[term]
        opens = np.flatnonzero(inner % BLOCK == 0)  # first posting of each block
        block = np.cumsum(inner % BLOCK == 0) - 1
        near = (doc - doc[opens][block]).astype(np.uint16)
        corner = np.lexsort((n[doc], tf, block))
        lead = np.ones(len(corner), bool)
        lead[1:] = (block[corner][1:] != block[corner][:-1]) | (tf[corner][1:] != tf[corner][:-1])
        corner = corner[lead]
        corners = np.empty(len(corner), _CORNER)
        corners["block"], corners["tf"], corners["n"] = inner[corner] // BLOCK, tf[corner], n[doc[corner]]
        width = 1 if tf.max() < 1 << 8 else 2 if tf.max() < 1 << 16 else 4
        rows = len(size)

        def binary(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
            values = np.ascontiguousarray(values)
            return pa.Array.from_buffers(pa.binary(), rows, [None, pa.py_buffer((bounds * values.itemsize).astype(np.int32)),
                                                             pa.py_buffer(values)])

        lists = pa.RecordBatch.from_arrays(
            [pa.array(np.full(rows, segment)), coded.dictionary.cast(pa.string()), pa.array(size.astype(np.int64)),
             pa.array(np.add.reduceat(tf, begin[:-1]).astype(np.int64)),
             binary(doc[opens].astype(np.int32), np.searchsorted(opens, begin)), binary(near, begin),
             binary(tf.astype(f"u{width}"), begin), pa.array(np.full(rows, width, np.int32)),
             binary(corners, np.searchsorted(term[corner], np.arange(rows + 1))), pa.nulls(rows, listed)], names)
        for a in range(0, rows, 20_000):
            yield lists.slice(a, 20_000)


def build_index(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """The written index of all texts: (segment, term, df, total, packed lists);
    the row without a term has the segment's ids and lengths."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        number, open_ = TaskContext.get().partitionId() << 24, _Segment()
        kind = None
        for batch in batches:
            kind = batch.column("doc_id").type
            data, off = text_bytes(batch.column("text"))
            for i, j in blocks(off):
                if open_.n_docs and (open_.size + off[j] - off[i] > segment_bytes or open_.n_docs + j - i > SEGMENT_DOCS):
                    yield from open_.rows(number, kind)
                    number, open_ = number + 1, _Segment()
                for a in range(i, j, SEGMENT_DOCS):  # a block of very many empty texts
                    b = min(j, a + SEGMENT_DOCS)
                    if open_.n_docs + b - a > SEGMENT_DOCS:
                        yield from open_.rows(number, kind)
                        number, open_ = number + 1, _Segment()
                    open_.add(batch.column("doc_id").slice(a, b - a), data[off[a]:off[b]], off[a:b + 1] - off[a])
        if open_.n_docs:
            yield from open_.rows(number, kind)

    return cut(rows.transform(map_arrow, run, f"{_LISTS}, ids array<{id_type}>"), "search-index")


# ----------------------------------------------------------------- the search
class _List:
    """One posting list: packed blocks, and the maximum of each."""

    def __init__(self, base, docs, tf, width, corners, m_of):
        self.base = np.frombuffer(base, np.int32)
        self.near = np.frombuffer(docs, np.uint16)
        self.tf = np.frombuffer(tf, f"u{width}")
        c = np.frombuffer(corners, _CORNER)
        self.most = np.zeros(len(self.base), np.int64)
        np.maximum.at(self.most, c["block"], impact(c["tf"].astype(np.int64), m_of(c["n"])))
        self.unpacked = 0

    def unpack(self, which: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(documents, impacts) of the given blocks, in rising order."""
        self.unpacked += len(which)
        if len(which) == len(self.base):
            at = np.arange(len(self.near))
        else:
            at = (which[:, None] * BLOCK + np.arange(BLOCK)).ravel()
            at = at[at < len(self.near)]
        doc = self.base[at // BLOCK].astype(np.int64) + self.near[at]
        return doc, impact(self.tf[at].astype(np.int64), m[doc])


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """The part of a term's score that its weight multiplies."""
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def length_norm(n, n_docs: int, n_terms: int):
    """A document's m: 25 and three quarters of its relative length, in hundredths."""
    return 100 - 75 + (75 * n * n_docs) // n_terms


def _tenth(scores: np.ndarray, top: int) -> int:
    """The score that the result's last place has so far; 1 while places are free."""
    return max(1, int(np.partition(scores, len(scores) - top)[len(scores) - top])) if len(scores) >= top else 1


def best_of_segment(lists: list[tuple[int, _List]], m: np.ndarray, top: int, acc: np.ndarray):
    """(documents, scores) of the best ``top`` documents of one item.

    ``lists`` are (weight times repeats, list); ``acc`` is a zeroed array of the
    segment's documents and is zero again on return.
    """
    lists = sorted(((c, x, c * int(x.most.max())) for c, x in lists if c > 0), key=lambda t: -t[2])
    rest = np.append(np.cumsum([b for _, _, b in lists][::-1])[::-1], 0)
    floor, found, k = 1, np.zeros(0, np.int64), 0
    while k < len(lists) and rest[k] >= floor:  # essential: a document in none before may still get in
        c, x, _ = lists[k]
        doc, q = x.unpack(np.arange(len(x.base)), m)
        found = np.concatenate([found, doc[(acc[doc] == 0) & (q > 0)]])
        acc[doc] += c * q
        k += 1
        floor = max(floor, _tenth(acc[found], top))
    score = acc[found]
    acc[found] = 0
    alive = score + rest[k] >= floor
    found, score = found[alive], score[alive]
    tail = lists[k:]
    if tail and len(found):
        by = np.argsort(found)
        found, score = found[by], score[by]
        at = np.stack([np.searchsorted(x.base, found, "right") - 1 for _, x, _ in tail])
        most = np.stack([np.where(b >= 0, c * x.most[np.maximum(b, 0)], 0) for (c, x, _), b in zip(tail, at, strict=True)])
        upper = score + most.sum(0)
        for t, (c, x, _) in enumerate(tail):
            alive = upper >= floor
            if not alive.all():
                found, score, upper, at, most = found[alive], score[alive], upper[alive], at[:, alive], most[:, alive]
            which = np.unique(at[t][at[t] >= 0])
            if len(which):
                doc, q = x.unpack(which, m)
                place = np.minimum(np.searchsorted(doc, found), len(doc) - 1)
                gain = np.where(doc[place] == found, c * q[place], 0)
                score = score + gain
                upper = upper - most[t] + gain
                floor = max(floor, _tenth(score, top))
            else:
                upper = upper - most[t]
    by = np.lexsort((found, -score))[:top]
    return found[by], score[by]


def search(index: DataFrame, items: DataFrame, *, item_id: str = "item_id", text_col: str = "text", top: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents of each item."""
    spark = index.sparkSession
    ship(spark)
    doc_type = index.schema["ids"].dataType.elementType.simpleString()
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    text = F.translate(F.coalesce(F.col(text_col), F.lit("")), upper, upper.lower())
    asked = cut(items.select(F.col(item_id).alias("item_id"), F.monotonically_increasing_id().alias("item"),
                             F.regexp_extract_all(text, F.lit(TERM), F.lit(0)).alias("terms")), "search-items")
    n_docs, n_terms = index.filter("term is null").agg(F.sum("df"), F.sum("total")).first()
    n_items, chars = asked.agg(F.count(F.lit(1)), F.sum(F.length(F.array_join("terms", " ")))).first()
    n_blocks = max(1, -(-n_items // ITEMS_IN_BLOCK), -(-int(chars or 0) // ITEM_CHARS_IN_BLOCK))
    n_docs, n_terms = int(n_docs or 0), int(n_terms or 0)

    # who uses a term, by block of items; a block bounds the length of the list
    uses = (asked.select(F.pmod(F.xxhash64("item"), F.lit(n_blocks)).alias("items"), "item", F.explode("terms").alias("term"))
            .groupBy("items", "term", "item").agg(F.count(F.lit(1)).alias("repeats"))
            .groupBy("items", "term").agg(F.collect_list(F.struct("item", "repeats")).alias("uses")))
    lists = index.filter("term is not null").join(uses.select("term").distinct(), "term", "left_semi")
    weight = (lists.groupBy("term").agg(F.sum("df").alias("all_df"))
              .withColumn("weight", F.floor(F.lit(1000) * F.log(F.lit(2.0 * n_docs + 2) / (2 * F.col("all_df") + 1)))))
    wanted = uses.join(weight.filter("weight > 0"), "term")
    parts = (lists.join(wanted, "term")
             .select("segment", "items", "df", "base", "docs", "tf", "tf_bytes", "corners", "weight", "uses",
                     F.lit(None).cast(f"array<{doc_type}>").alias("ids")))
    segments = (index.filter("term is null")
                .select("segment", F.explode(F.expr(f"sequence(0L, {n_blocks - 1}L)")).alias("items"), "df",
                        "base", "docs", "tf", "tf_bytes", "corners", F.lit(None).cast("bigint").alias("weight"),
                        F.lit(None).cast(wanted.schema["uses"].dataType).alias("uses"), "ids"))

    def run(table: pa.Table) -> pa.Table:
        own = pc.is_valid(table.column("ids"))
        head = table.filter(own)
        rows = table.filter(pc.invert(own)).combine_chunks()
        ids = head.column("ids").combine_chunks()
        ids = ids.chunk(0) if isinstance(ids, pa.ChunkedArray) else ids
        ids = ids.flatten()
        m = length_norm(np.frombuffer(head.column("docs")[0].as_py(), np.int64), n_docs, n_terms) if n_terms else np.zeros(0)
        by_item: dict[int, list[tuple[int, _List]]] = {}
        cols = [rows.column(c).to_pylist() for c in ("base", "docs", "tf", "tf_bytes", "corners", "weight", "uses")]
        for base, docs, tf, width, corners, weight, uses in zip(*cols, strict=True):
            x = _List(base, docs, tf, width, corners, lambda n: length_norm(n, n_docs, n_terms))
            for u in uses:
                by_item.setdefault(u["item"], []).append((u["repeats"] * weight, x))
        acc = np.zeros(len(ids), np.int64)
        item, doc, score = [], [], []
        for k in sorted(by_item):
            d, s = best_of_segment(by_item[k], m, top, acc)
            item.append(np.full(len(d), k))
            doc.append(d)
            score.append(s)
        flat = [np.concatenate(v) if v else np.zeros(0, np.int64) for v in (item, doc, score)]
        return pa.table([pa.array(flat[0], pa.int64()), ids.take(pa.array(flat[1], pa.int64())), pa.array(flat[2], pa.int64()),
                         pa.array(flat[1], pa.int64()), pa.array(np.full(len(flat[0]), table.column("segment")[0].as_py()), pa.int64())],
                        names=["item", "doc_id", "score", "number", "segment"])

    heaps = (parts.unionByName(segments).groupBy("segment", "items")
             .applyInArrow(run, f"item long, doc_id {doc_type}, score long, number long, segment long"))
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "segment", "number")
    return (heaps.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
            .join(asked.select("item", "item_id"), "item")
            .select("item_id", "rank", "doc_id", "score"))
