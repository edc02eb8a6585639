"""Model and artefact persistence (R25): ML writers for the models,
Parquet for the dimension tables; loading mirrors it."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame, SparkSession


def save(path: str, als_model: ALSModel | None = None, ranker: PipelineModel | None = None,
         tables: dict[str, DataFrame] | None = None) -> dict[str, str]:
    """Write everything under ``path`` (a shared, durable location)."""
    out = {}
    if als_model is not None:
        als_model.write().overwrite().save(f"{path}/als")
        out["als"] = f"{path}/als"
    if ranker is not None:
        ranker.write().overwrite().save(f"{path}/ranker")
        out["ranker"] = f"{path}/ranker"
    for name, df in (tables or {}).items():
        df.write.mode("overwrite").parquet(f"{path}/{name}")
        out[name] = f"{path}/{name}"
    return out


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def load(spark: SparkSession, path: str, names: list[str] = ()) -> dict:
    """What ``save`` wrote: a model that was not saved is absent, one that
    can't be read is an error."""
    got = {}
    for name, cls in (("als", ALSModel), ("ranker", PipelineModel)):
        if _exists(spark, f"{path}/{name}"):
            got[name] = cls.load(f"{path}/{name}")
    for n in names:
        got[n] = spark.read.parquet(f"{path}/{n}")
    return got
