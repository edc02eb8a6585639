"""Exact duplicates through an extendible-hash index on shared files.

Two texts are equal when they are identical after lower-casing A-Z. The index
maps the 64-bit hash of a normalised text to its entries:

* the texts are read once for their hash and SHA-256, which are written as
  (doc_id, key, text_sha256);
* the directory starts with one bucket and doubles: while a bucket holds more
  than ``capacity`` different hashes, it is split by the next bit of the hash.
  All doublings come from one histogram over hash prefixes, in DataFrame
  operations; how many bits they may use follows from the number of hashes;
* texts are routed through the directory and merged by bucket, hash and the
  bytes of the text itself: this is where bytes are compared. The aggregate
  combines copies before anything is shuffled, so a text that a third of all
  rows share is one entry a task;
* every bucket belongs to one owner task, which chains texts that differ but
  collide in the hash (``chain`` numbers them within a key) and writes the
  bucket's entries as files in the shared folder, sorted by key;
* documents find their bucket through the directory and their entry by bucket,
  key and SHA-256; no text is shuffled a second time.

Only DataFrame functions run here, no Python on the executors.

Defined cases: a null text counts as empty, and all empty texts are one
group; a null id is never the largest while another exists, and a group of
null ids keeps null; rows repeated with the same id and text are all marked
kept in ``groups`` and become one row in ``deduplicate``; an empty table gives
an empty result; other columns pass through ``deduplicate`` untouched.
"""

from __future__ import annotations

import math
import string
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercato.llm.common import cut

CAPACITY = 50_000
#: Bits of the directory at most: it is broadcast, with 2^MAX_DEPTH rows of 16 bytes (16 MB) at most.
#: Beyond MAX_DEPTH's share of hashes the capacity grows with their number.
MAX_DEPTH = 20
#: Bits beyond those that equally full buckets need.
SPARE = 4


def normalised(text: Column) -> Column:
    return F.coalesce(F.translate(text, string.ascii_uppercase, string.ascii_lowercase), F.lit(""))


def directory(histogram: DataFrame, capacity: int, max_depth: int) -> DataFrame:
    """(cell, n) counts by the first ``max_depth`` hash bits -> (cell, depth,
    bucket): the leaf of the doubled directory that each cell belongs to.

    A prefix of d bits is a leaf if it fits ``capacity`` (or no bits are left)
    and no shorter prefix of it does. A bucket's number is its prefix behind a one.
    """
    depths = F.explode(F.sequence(F.lit(0), F.lit(max_depth))).alias("depth")
    prefix = F.expr(f"shiftright(cell, {max_depth} - depth)").alias("prefix")
    by_prefix = (histogram.select("cell", "n", depths).select("cell", "n", "depth", prefix))
    filled = by_prefix.groupBy("depth", "prefix").agg(F.sum("n").alias("filled"))
    fits = filled.filter((F.col("filled") <= capacity) | (F.col("depth") == max_depth))
    return (by_prefix.join(fits, ["depth", "prefix"])
            .groupBy("cell").agg(F.min(F.struct("depth", "prefix")).alias("leaf"))
            .select("cell", F.col("leaf.depth").alias("depth"),
                    F.expr("shiftleft(1L, leaf.depth) + leaf.prefix").alias("bucket")))


def cell_of(key: str, bits: int) -> Column:
    """The first ``bits`` bits of a hash."""
    return F.expr(f"shiftrightunsigned({key}, {64 - bits})") if bits else F.lit(0).cast("long")


@dataclass
class Index:
    """A written index: its directory (cell -> bucket), its entries, and the rows that it was built from."""

    bits: int
    leaves: DataFrame  # cell, depth, bucket
    entries: DataFrame  # bucket, depth, key, chain, text_sha256, n_bytes, keep_id, group_size
    rows: DataFrame  # doc_id, key, text_sha256

    def routed(self, rows: DataFrame) -> DataFrame:
        """``rows`` (with ``key``) and the bucket that the directory gives them."""
        return (rows.withColumn("cell", cell_of("key", self.bits))
                .join(F.broadcast(self.leaves.select("cell", "bucket")), "cell").drop("cell"))

    def lookup(self) -> DataFrame:
        """(doc_id, key, text_sha256, keep_id, group_size) of every row that the index was built from."""
        entries = self.entries.select("bucket", "key", "text_sha256", "keep_id", "group_size")
        return self.routed(self.rows).join(entries, ["bucket", "key", "text_sha256"]).drop("bucket")


def build_index(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                key: Callable[[Column], Column] = F.xxhash64, capacity: int = CAPACITY,
                max_depth: int = MAX_DEPTH) -> Index:
    """Write the index; ``entries`` has one row per different text."""
    norm = docs.select(F.col(id_col).alias("doc_id"), normalised(F.col(text_col)).alias("norm"))
    rows = cut(norm.select("doc_id", key(F.col("norm")).alias("key"), F.sha2("norm", 256).alias("text_sha256")),
               "dedup-rows")
    # counters of hash prefixes: 2^max_depth at most, whatever the input
    cells = cut(rows.select("key").distinct().groupBy(cell_of("key", max_depth).alias("cell"))
                .agg(F.count(F.lit(1)).alias("n")), "dedup-cells")
    n = cells.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    bits = min(max_depth, math.ceil(math.log2(max(n / capacity, 1))) + SPARE)
    capacity = max(capacity, math.ceil(n * 2**SPARE / 2**max_depth))
    histogram = (cells.groupBy(F.expr(f"shiftright(cell, {max_depth - bits})").alias("cell"))
                 .agg(F.sum("n").alias("n")))
    index = Index(bits, cut(directory(histogram, capacity, bits), "dedup-directory"), None, rows)

    merged = (index.routed(norm.withColumn("key", key(F.col("norm"))))
              .groupBy("bucket", "key", "norm").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
              .select("bucket", "key", F.sha2("norm", 256).alias("text_sha256"), F.octet_length("norm").alias("n_bytes"),
                      "keep_id", "group_size"))
    chain = F.row_number().over(Window.partitionBy("bucket", "key").orderBy("text_sha256", "n_bytes"))
    depth = F.expr("length(bin(bucket)) - 1")
    index.entries = cut(merged.repartition("bucket").withColumn("chain", chain)
                        .sortWithinPartitions("bucket", "key", "chain")
                        .select("bucket", depth.alias("depth"), "key", "chain", "text_sha256", "n_bytes", "keep_id",
                                "group_size"), "dedup-index")
    return index


def groups(docs: DataFrame, **options) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    return build_index(docs, **options).lookup().select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def deduplicate(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                key: Callable[[Column], Column] = F.xxhash64, **options) -> DataFrame:
    """The rows of ``docs`` that stay, with their own columns."""
    index = build_index(docs, id_col=id_col, text_col=text_col, key=key, **options).entries
    stay = index.select(F.col("keep_id").alias("_keep_id"), F.col("text_sha256").alias("_sha"))
    mine = docs.withColumn("_own_sha", F.sha2(normalised(F.col(text_col)), 256))
    one = Window.partitionBy("_sha", "_keep_id").orderBy(F.lit(1))
    return (mine.join(stay, F.col(id_col).eqNullSafe(F.col("_keep_id")) & (F.col("_own_sha") == F.col("_sha")))
            .withColumn("_row", F.row_number().over(one)).filter("_row = 1")
            .select(*docs.columns))
