"""Keyed tables (K1, K2): idempotent loads that touch few files, and joins
without an exchange.

A table is clustered into a fixed number of buckets by one column, and each
bucket is a partition of its own (column ``bucket``, the same hash). So a load
reads and replaces only the buckets that its new keys fall into (dynamic partition
overwrite), while two tables clustered alike join bucket by bucket where they lie.

Loading a batch again changes nothing: rows whose key is there already stay as
they are, or with ``replace`` take the batch's values, which a second load
repeats. A load that dies is loaded again.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from mercato.operators import keep_first
from mercato.session import cut_at, drop_cut, ensure_checkpoint_dir


@dataclass
class KeyedTable:
    spark: SparkSession
    name: str
    key: list[str]
    cluster: str
    buckets: int

    @classmethod
    def open(cls, spark: SparkSession, name: str, path: str, schema: StructType, key: Sequence[str], cluster: str | None = None,
             buckets: int = 16) -> KeyedTable:
        """The table at ``path``, made if there is none, known to the session's
        catalog as ``name``. ``cluster`` (default: the first key) and ``buckets`` must stay what they were."""
        key = list(key)
        cluster = cluster or key[0]
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        spark.sql(f"DROP TABLE IF EXISTS `{name}`")  # an external table: the files stay
        spark.sql(f"CREATE TABLE `{name}` ({columns}, `bucket` int) USING parquet PARTITIONED BY (`bucket`) "
                  f"CLUSTERED BY (`{cluster}`) SORTED BY (`{cluster}`) INTO {buckets} BUCKETS LOCATION '{path}'")
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(folder)
        spark.sql(f"ALTER TABLE `{name}` RECOVER PARTITIONS")
        ensure_checkpoint_dir(spark)
        return cls(spark, name, key, cluster, buckets)

    def rows(self) -> DataFrame:
        return self.spark.table(f"`{self.name}`").drop("bucket")

    def _part(self, buckets: list[int]) -> DataFrame:
        """The rows of some buckets; their partitions are all that is read."""
        return self.spark.table(f"`{self.name}`").where(F.col("bucket").isin(buckets))

    def upsert(self, batch: DataFrame, order: Sequence[str] = (), replace: bool = False) -> list[int]:
        """Load ``batch``: the first row of each key by ``order``; rows with a
        null in the key are left out. Returns the buckets that were written."""
        made: list[str] = []
        try:
            return self._load(batch, order, replace, made)
        finally:
            for path in made:  # all of it is in the table, or the load has failed and is done again
                drop_cut(self.spark, path)

    def _load(self, batch: DataFrame, order: Sequence[str], replace: bool, made: list[str]) -> list[int]:
        spark = self.spark

        def written(df: DataFrame) -> DataFrame:
            df, path = cut_at(df)
            made.append(path)
            return df

        columns = self.rows().columns
        ok = F.lit(True)
        for k in [*self.key, self.cluster]:
            ok = ok & F.col(k).isNotNull()
        bucket = F.pmod(F.hash(self.cluster), F.lit(self.buckets))  # as the writer of buckets hashes
        new = written(keep_first(batch.select(*columns).where(ok), self.key, list(order)).withColumn("bucket", bucket))
        met = sorted(r.bucket for r in new.select("bucket").distinct().collect())  # at most one number a bucket
        if not met:
            return []
        on = ["bucket", *self.key]
        there = {r.partition for r in spark.sql(f"SHOW PARTITIONS `{self.name}`").collect()}  # at most one a bucket
        if not there & {f"bucket={b}" for b in met}:
            self._write(new)
            return met
        if replace:
            changed, old = new, self._part(met).join(new.select(*on), on, "left_anti")
        else:
            changed = written(new.join(self._part(met).select(*on), on, "left_anti"))
            drop_cut(spark, made.pop(0))  # the rows that are new are all that is used from here on
            met = sorted(r.bucket for r in changed.select("bucket").distinct().collect())
            if not met:
                return []
            old = self._part(met)
        merged = written(old.unionByName(changed).select(*columns, "bucket"))  # what is read here is replaced below
        drop_cut(spark, made.pop(0))
        self._write(merged)
        return met

    def _write(self, rows: DataFrame) -> None:
        """Replace the buckets that ``rows`` has, and no others."""
        spark = self.spark
        before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        try:
            rows.select(*self.rows().columns, "bucket").repartition(self.buckets, self.cluster).write.insertInto(f"`{self.name}`", overwrite=True)
        finally:
            spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)
        spark.catalog.refreshTable(f"`{self.name}`")
