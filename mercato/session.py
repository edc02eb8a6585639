"""Spark session helpers.

The builder only fills settings the cluster has not already set: on a real
cluster ``spark.checkpoint.dir`` and shuffle sizing come from the
deployment, and the session is taken as it is.
"""

from __future__ import annotations

import contextlib
import io
import os
import tempfile
import threading
import uuid
import zipfile
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

# Shuffle files go when their query has ended, not when the driver happens to collect garbage.
_SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Settings we rely on for correct results and bounded disk; applied only where unset.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    _SHUFFLE_CLEANUP: "true",
}


def get_session(master: str | None = None, app: str = "mercato",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Return the active session, or build a local one for tests/bench."""
    active = SparkSession.getActiveSession()
    if active is not None:
        ensure_checkpoint_dir(active)
        return active
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in _DEFAULTS.items():
        b = b.config(k, v)
    b = b.config("spark.driver.memory", os.environ.get("MERCATO_DRIVER_MEMORY", "8g"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use ``spark.checkpoint.dir`` from the session; set a scratch one only
    when it is unset in local mode; on a cluster that is an error. Reliable checkpoints are what cut
    lineage here -- never ``localCheckpoint``."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="mercato-ckpt-", dir="/tmp")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def prepare(spark: SparkSession) -> SparkSession:
    """Settings our results depend on, applied to a session we did not
    build: day arithmetic on ``timestamp_ntz`` goes through the session time
    zone, so it is pinned to UTC (no DST shifts in whole-day counts)."""
    if spark.conf.get("spark.sql.session.timeZone", "UTC") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    if spark.conf.get(_SHUFFLE_CLEANUP, None) is None:
        spark.conf.set(_SHUFFLE_CLEANUP, "true")
    ensure_checkpoint_dir(spark)
    return spark


#: Seconds between two collections of the driver's garbage in ``collecting``.
COLLECT_EVERY = 2.0


@contextlib.contextmanager
def collecting(spark: SparkSession) -> Iterator[None]:
    """While the block runs, the driver's garbage is collected every few seconds.

    A fit of ``pyspark.ml`` runs many jobs in one call; Spark removes the shuffle
    files of its earlier rounds once the driver has collected the objects that
    name them, and a driver with a large heap may not do so before the disks are full."""
    done = threading.Event()

    def run() -> None:
        while not done.wait(COLLECT_EVERY):
            spark._jvm.System.gc()

    thread = threading.Thread(target=run, daemon=True)
    thread.start()
    try:
        yield
    finally:
        done.set()
        thread.join()
        spark._jvm.System.gc()


def cut(df: DataFrame) -> DataFrame:
    """``df`` written once, as Parquet in the folder that ``spark.checkpoint.dir``
    names, and read again: every later use reads just the columns it needs, and
    the planner knows the size."""
    return cut_at(df)[0]


def cut_at(df: DataFrame) -> tuple[DataFrame, str]:
    """``cut``, and the folder of its files."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def drop_cut(spark: SparkSession, path: str | None) -> None:
    """Remove the files of a ``cut_at`` that nothing reads any more."""
    if path:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python, once an application, as
    ``--py-files`` would: tasks import its functions by name."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    top = os.path.dirname(os.path.abspath(__file__))
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as z:
        for folder, _, names in os.walk(top):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    # in the shared folder, like everything else that is written
    path = sc._jvm.org.apache.hadoop.fs.Path(f"{ensure_checkpoint_dir(spark)}/{os.path.basename(top)}.zip")
    out = path.getFileSystem(sc._jsc.hadoopConfiguration()).create(path, True)
    out.write(packed.getvalue())
    out.close()
    sc.addPyFile(path.toString())
    _shipped.add(sc.applicationId)
