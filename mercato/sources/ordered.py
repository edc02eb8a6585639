"""Ordered writes (W6): a table whose files, read by name, are in global order.

Rows are range-partitioned by the order, sorted inside their partition and
written one partition after the other by name, so no task sees more than its
range. Rows that tie in the order are spread by a hash of the row, so a value
that a third of the rows share fills several files. A manifest has one row a
file: its place, its rows, how many rows lie before it, and the first and last key.

``read_ordered`` gives every row its place in the global order from the
manifest and the row's index in its file, without a sort; ``read_range`` reads only
the files whose key range meets the one asked for.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Folder of the manifest inside the table's; readers of the table skip names with an underscore.
MANIFEST = "_manifest"


def _order(order: Sequence[str | tuple[str, bool]]) -> list[tuple[str, bool]]:
    return [(o, True) if isinstance(o, str) else o for o in order]


def _sort_columns(order: Sequence[tuple[str, bool]]) -> list[Column]:
    return [F.asc_nulls_last(c) if up else F.desc_nulls_last(c) for c, up in order]


def write_ordered(df: DataFrame, path: str, order: Sequence[str | tuple[str, bool]], files: int | None = None) -> None:
    """Write ``df`` as Parquet in the order of ``order``: column names, or
    ``(name, ascending)`` pairs; nulls last. Rows equal in all of these follow each
    other in any order. Replaces what ``path`` held."""
    spark = df.sparkSession
    order = _order(order)
    n = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    tie = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    by = [*_sort_columns(order), F.asc("_tie")]
    rows = df.withColumn("_tie", tie).repartitionByRange(n, *by).sortWithinPartitions(*by).drop("_tie")
    rows.write.mode("overwrite").parquet(path)
    key = F.struct(*[F.col(f"`{c}`") for c, _ in order])
    found = (spark.read.schema(df.schema).parquet(path)
             .select(key.alias("key"), F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("at"))
             .groupBy("file").agg(F.count(F.lit(1)).alias("rows"), F.min_by("key", "at").alias("first"), F.max_by("key", "at").alias("last")))
    # one row a file: the only window without partitions here
    before = F.sum("rows").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("rows")
    manifest = found.withColumn("before", before).withColumn("place", F.row_number().over(Window.orderBy("file")) - 1)
    manifest.coalesce(1).write.mode("overwrite").parquet(f"{path}/{MANIFEST}")


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """``(file, rows, first, last, before, place)``, a row a file."""
    return spark.read.parquet(f"{path}/{MANIFEST}")


def read_ordered(spark: SparkSession, path: str, position: str = "position") -> DataFrame:
    """The table with each row's place in the global order, from 0."""
    rows = spark.read.parquet(path).withColumn("_file", F.col("_metadata.file_name")).withColumn("_at", F.col("_metadata.row_index"))
    offsets = manifest(spark, path).select(F.col("file").alias("_file"), "before")
    return rows.join(offsets, "_file").withColumn(position, F.col("before") + F.col("_at")).drop("_file", "_at", "before")


def read_range(spark: SparkSession, path: str, column: str, low, high) -> DataFrame:
    """Rows with ``low <= column <= high`` for the first column of an
    ascending order, from the files that can hold any."""
    ends = manifest(spark, path).select("file", F.col(f"first.`{column}`").alias("lo"), F.col(f"last.`{column}`").alias("hi"))
    # a file that ends in nulls, which come last, has its largest value somewhere before
    hit = (F.col("lo") <= F.lit(high)) & (F.col("hi").isNull() | (F.col("hi") >= F.lit(low)))
    names = [r.file for r in ends.where(hit).select("file").collect()]  # one name a file
    whole = spark.read.parquet(path)
    rows = spark.read.schema(whole.schema).parquet(*[f"{path}/{n}" for n in names]) if names else whole.limit(0)
    return rows.where(F.col(column).between(low, high))
