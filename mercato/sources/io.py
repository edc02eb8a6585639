"""Layer IO (S1-S5): CSV/Parquet readers with explicit schemas, the
UTF-8 -> Latin-1 fallback, layer listing and writing.

CSV follows the common dialect: quoted fields may hold commas, line breaks and
doubled quotes. A file with quoted line breaks can't be split, so a big table
should be many files, each read by one task.

Spark's CSV reader never raises on bad bytes; it substitutes U+FFFD. The
fallback is decided per file and from the bytes: files with a line that isn't
valid UTF-8 are read as ISO-8859-1, the others (which may well hold a U+FFFD
of their own) as UTF-8. The test is a plain scan of lines, without parsing.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def _csv(spark: SparkSession, path: str | list[str], schema: StructType | None, encoding: str) -> DataFrame:
    r = (spark.read.option("header", True).option("encoding", encoding).option("multiLine", True)
         .option("quote", '"').option("escape", '"'))
    r = r.schema(schema) if schema is not None else r.option("inferSchema", False)
    return r.csv(path)


def _trimmed(df: DataFrame) -> DataFrame:
    """S3: header names trimmed (the source carries a BOM / stray blanks)."""
    return df.toDF(*[c.strip().lstrip("\ufeff").strip() for c in df.columns])


def read_table(spark: SparkSession, path: str, schema: StructType | None = None, fmt: str | None = None) -> DataFrame:
    """Read one table, a file or a folder of files. CSV files are read as
    UTF-8, those with undecodable bytes as Latin-1."""
    fmt = fmt or ("csv" if path.endswith(".csv") else "parquet")
    if fmt == "parquet":
        df = spark.read.parquet(path)
        return df if schema is None else df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
    # at most one row a file; lines come as they are, undecoded
    files = sorted(r[0] for r in spark.read.text(path).where(~F.is_valid_utf8("value")).select(F.col("_metadata.file_path"))
                   .distinct().collect())
    df = _csv(spark, path, schema, "UTF-8")
    if not files:
        return _trimmed(df)
    good = _trimmed(df.where(~F.col("_metadata.file_path").isin(files)))
    again = _trimmed(_csv(spark, files, schema, "ISO-8859-1"))
    return good.unionByName(again) if set(good.columns) == set(again.columns) else good.union(again)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None) -> None:
    """Write a layer table (Parquet by default)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).option("escape", '"').csv(path)
    else:
        w.format(fmt).save(path)


def _listing(spark: SparkSession, path: str) -> dict[str, str]:
    """Table name -> path of every file or folder under ``path``."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        raise FileNotFoundError(path)
    out = {}
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if name.startswith(("_", ".")):
            continue
        out[name.rsplit(".", 1)[0] if not st.isDirectory() and "." in name else name] = f"{path}/{name}"
    return out


def list_tables(spark: SparkSession, path: str) -> list[str]:
    """Sorted table names (files or directories) under a layer path;
    a missing path is an error."""
    return sorted(_listing(spark, path))


def load_layer(spark: SparkSession, path: str, fmt: str = "parquet", schemas: dict[str, StructType] | None = None,
               names: dict[str, str] | None = None, expected: Iterable[str] | None = None) -> dict[str, DataFrame]:
    """One lazily read DataFrame per table of the layer.

    ``names`` maps file (or folder) names to table names. With ``expected``,
    a missing table and a file that maps to no expected table are errors.
    """
    found = {(names or {}).get(n, n): full for n, full in _listing(spark, path).items()}
    if expected is not None:
        missing, unknown = sorted(set(expected) - set(found)), sorted(set(found) - set(expected))
        if missing or unknown:
            raise ValueError(f"{path}: missing tables {missing}, unknown tables {unknown}")
    return {n: read_table(spark, full, (schemas or {}).get(n), fmt) for n, full in sorted(found.items())}


def head(df: DataFrame, key: list[str], n: int = 5) -> DataFrame:
    """A reproducible preview: first n rows by key."""
    return df.orderBy(*key).limit(n)
