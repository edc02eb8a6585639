"""Idempotent keyed append (K1 load semantics) as a Structured Streaming
``foreachBatch`` job: each micro-batch is de-duplicated on the key (keep
first by an explicit order) and only keys absent from the target are
appended. Replaying a batch after a failure therefore adds nothing twice;
the stream's own checkpoint tracks progress."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from mercato.operators import keep_first


def _batch_writer(target: str, key: list[str], order: list[str],
                  transform: Callable[[DataFrame], DataFrame] | None):
    def write(batch: DataFrame, _epoch: int) -> None:
        spark = batch.sparkSession
        b = transform(batch) if transform else batch
        b = keep_first(b, key, order)
        # only a target that isn't there yet is a first batch; any read error rises
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
        if p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
            b = b.join(spark.read.parquet(target).select(*key), key, "left_anti")
        b.write.mode("append").parquet(target)
    return write


def start_keyed_append(spark: SparkSession, source: str, schema, key: list[str], target: str, checkpoint: str,
                       order: list[str] = (), fmt: str = "parquet",
                       transform: Callable[[DataFrame], DataFrame] | None = None,
                       available_now: bool = True) -> StreamingQuery:
    """Start the stream from files under ``source``; ``available_now``
    processes what is there and stops (batch-style catch-up)."""
    reader = spark.readStream.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    stream = reader.format(fmt).load(source)
    w = (stream.writeStream.foreachBatch(_batch_writer(target, list(key), list(order), transform))
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()
