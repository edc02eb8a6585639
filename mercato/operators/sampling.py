"""Skew-safe per-group generation and limiting.

* ``explode_range``: one row per integer in ``[start, stop]`` per input
  row, generated in chunks spread over tasks by a shuffle of the (small)
  chunk descriptors -- a group needing a third of all draws does not sit in
  one task.
* ``limit_per_group``: keep the rows ranked ``<= k`` (``k`` a column, may
  differ per group) by a 64-bit order key, exactly, without one window over
  a whole group: rows are bucketed by the key's top bits (monotone),
  bucket counts give a per-group cumulative count, buckets wholly below the
  limit pass, and only the single boundary bucket is ranked row by row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercato.operators.indexing import dense_index


def explode_range(df: DataFrame, start: Column, stop: Column, out: str, chunk: int = 100_000,
                  partitions: int | None = None) -> DataFrame:
    n = (stop - start + 1)
    chunks = df.withColumn("_s0", start).withColumn("_s1", stop).withColumn(
        "_c", F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(n / F.lit(float(chunk))) - 1, F.lit(0)).cast("int"))))
    parts = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = chunks.where(F.col("_s1") >= F.col("_s0")).repartition(parts, "_c", *[c for c in df.columns[:1]])
    lo = F.col("_s0") + F.col("_c") * chunk
    hi = F.least(F.col("_s1"), lo + chunk - 1)
    return chunks.withColumn(out, F.explode(F.sequence(lo, hi))).drop("_s0", "_s1", "_c")


def limit_per_group(df: DataFrame, group: list[str], k: str, order: list[Column], bucket: Column) -> DataFrame:
    """Rows of ``df`` whose rank within ``group`` by ``order`` is ``<= df[k]``
    (``k`` constant within a group). ``bucket`` must be a coarse version of
    the order (non-decreasing along it) with a bounded number of values per
    group, e.g. the top bits of a hash key."""
    d = df.withColumn("_bk", bucket)
    counts = d.groupBy(*group, "_bk").agg(F.count(F.lit(1)).alias("_cnt"), F.first(k).alias("_k"))
    w = Window.partitionBy(*group).orderBy("_bk").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = counts.withColumn("_cum", F.sum("_cnt").over(w)).withColumn("_before", F.col("_cum") - F.col("_cnt"))
    full = counts.where(F.col("_cum") <= F.col("_k")).select(*group, "_bk")
    edge = counts.where((F.col("_before") < F.col("_k")) & (F.col("_cum") > F.col("_k"))).select(
        *group, "_bk", (F.col("_k") - F.col("_before")).alias("_rest"))
    keep_full = d.join(full, [*group, "_bk"], "left_semi")
    e = d.join(edge, [*group, "_bk"])
    we = Window.partitionBy(*group, "_bk").orderBy(*order)
    keep_edge = e.withColumn("_o", F.row_number().over(we)).where(F.col("_o") <= F.col("_rest")).drop("_o", "_rest")
    return keep_full.unionByName(keep_edge).drop("_bk")


def hash_bucket(key: Column, bits: int = 10) -> Column:
    """Top ``bits`` bits of a signed 64-bit key: monotone in the key."""
    return F.shiftright(key, 64 - bits).cast("int")


def with_id_bucket(df: DataFrame, col: str, out: str, size: int = 4096) -> DataFrame:
    """Coarse monotone bucket of an id column of any type: ``size`` neighbouring
    ids each, by their dense position, so that ids with a common prefix or a
    gap in their range don't share a bucket."""
    place = dense_index(df, col, "_place")
    return df.join(place, col, "left").withColumn(out, F.floor(F.col("_place") / size).cast("int")).drop("_place")
