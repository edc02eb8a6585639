"""Dense 0..n-1 integer ids for a key column (R4), without a single-task
window: range-partition the distinct keys, count each partition (one row
per partition), turn the counts into offsets, number rows inside their own
partition. The distinct keys are checkpointed first (reliable checkpoint in
``spark.checkpoint.dir``) so partition contents and ids stay fixed when an
executor is lost and stages are recomputed."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mercato.session import ensure_checkpoint_dir


def dense_index(df: DataFrame, key: str, idx: str, partitions: int | None = None) -> DataFrame:
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = (df.select(key).where(F.col(key).isNotNull()).distinct()
            .repartitionByRange(n, key).sortWithinPartitions(key)
            .withColumn("_p", F.spark_partition_id()))
    keys = keys.checkpoint(eager=True)
    counts = keys.groupBy("_p").agg(F.count(F.lit(1)).alias("_c"))
    offsets = counts.select("_p", (F.sum("_c").over(Window.orderBy("_p")) - F.col("_c")).alias("_off"))
    local = F.row_number().over(Window.partitionBy("_p").orderBy(key)) - 1
    return (keys.withColumn("_r", local)
            .join(F.broadcast(offsets), "_p")
            .select(key, (F.col("_off") + F.col("_r")).cast("int").alias(idx)))
