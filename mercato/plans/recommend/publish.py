"""Published artefacts (R25): models, codes and id maps as one version that
readers see whole or not at all.

A version is written aside, into a folder of its own, and ends with a manifest
that names every artefact, the ranker's feature columns in their order, and the
rows and schema of every table. Only then does a pointer file change, by a
rename that replaces it in one step. A job that dies before leaves an orphan folder
and the old version in force; a reader that has the old version keeps reading its
files, since versions never change.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.plans.recommend.hybrid import FEATURES, FeatureTables

POINTER, MANIFEST = "CURRENT", "manifest.json"
_MODELS = {"als": ALSModel, "ranker": PipelineModel}


@dataclass
class Published:
    version: str
    features: list[str]
    models: dict = field(default_factory=dict)
    tables: dict[str, DataFrame] = field(default_factory=dict)

    def feature_tables(self) -> FeatureTables:
        """What the ranker needs to score: encoded features and the codes behind them."""
        codes = {n.removeprefix("codes_"): t for n, t in self.tables.items() if n.startswith("codes_")}
        return FeatureTables(self.tables["customer_features"], self.tables["product_features"], codes)


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    p, fs = _fs(spark, path)
    out = fs.create(p, True)
    out.write(text.encode())
    out.close()


def _read_text(spark: SparkSession, path: str) -> str | None:
    p, fs = _fs(spark, path)
    if not fs.exists(p):
        return None
    return bytes(spark.read.format("binaryFile").load(path).first()["content"]).decode()


def _point(spark: SparkSession, root: str, version: str) -> None:
    """Replace the pointer in one step."""
    jvm = spark.sparkContext._jvm
    aside = f"{root}/.{POINTER}-{version}"
    _write_text(spark, aside, version)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(_fs(spark, aside)[1].getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    mode = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    mode[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(jvm.org.apache.hadoop.fs.Path(aside), jvm.org.apache.hadoop.fs.Path(f"{root}/{POINTER}"), mode)


def publish(spark: SparkSession, root: str, models: dict, tables: dict[str, DataFrame], features: list[str] | None = None,
            before_pointer: Callable[[], None] | None = None) -> str:
    """Write a version under ``root`` (shared storage) and point to it; its name.

    ``models``: ``als`` and ``ranker``, any of them; ``tables`` by name.
    ``before_pointer`` runs when all is written and nothing is visible yet (checks that may refuse)."""
    version = uuid.uuid4().hex
    base = f"{root}/versions/{version}"
    for name, model in models.items():
        if name not in _MODELS:
            raise ValueError(f"unknown model {name}")
        model.write().save(f"{base}/{name}")
    kinds = {}
    for name, df in tables.items():
        df.write.parquet(f"{base}/{name}")
        back = spark.read.schema(df.schema).parquet(f"{base}/{name}")
        kinds[name] = {"rows": back.agg(F.count(F.lit(1))).first()[0], "schema": json.loads(df.schema.json())}
    _write_text(spark, f"{base}/{MANIFEST}", json.dumps(
        {"version": version, "models": sorted(models), "tables": kinds, "features": list(features or FEATURES)}, indent=1))
    if before_pointer:
        before_pointer()
    _point(spark, root, version)
    return version


def current(spark: SparkSession, root: str) -> Published:
    """The version in force: every artefact of its manifest, or an error."""
    from pyspark.sql.types import StructType
    version = _read_text(spark, f"{root}/{POINTER}")
    if version is None:
        raise FileNotFoundError(f"nothing is published under {root}")
    base = f"{root}/versions/{version}"
    text = _read_text(spark, f"{base}/{MANIFEST}")
    if text is None:
        raise FileNotFoundError(f"version {version} has no manifest")
    m = json.loads(text)
    models = {n: _MODELS[n].load(f"{base}/{n}") for n in m["models"]}
    tables = {n: spark.read.schema(StructType.fromJson(t["schema"])).parquet(f"{base}/{n}") for n, t in m["tables"].items()}
    return Published(version, m["features"], models, tables)
