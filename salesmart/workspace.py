"""Where intermediate tables are written: the shared folder that ``spark.checkpoint.dir`` names."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

SHARED_DIR = "spark.checkpoint.dir"

#: Folders settled inside each open ``scratch``, the innermost last.
_OPEN: list[list[str]] = []


def shared_root(spark: SparkSession) -> str:
    root = spark.conf.get(SHARED_DIR, None)
    if not root:
        raise ValueError(f"set {SHARED_DIR} to a folder that the driver and every executor can reach")
    return root.rstrip("/")


def run_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder for one run; nothing is ever written twice into it."""
    return f"{shared_root(spark)}/{purpose}-{uuid.uuid4().hex}"


def settle(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` once and read it back, which cuts the lineage safely."""
    path = run_dir(df.sparkSession, purpose)
    if _OPEN:
        _OPEN[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def files(spark: SparkSession, path: str):
    """The file system of a path, and the path in its terms."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[list[str]]:
    """Tables settled inside are deleted at the end; nothing read from them may be used after it."""
    _OPEN.append([])
    try:
        yield _OPEN[-1]
    finally:
        for path in _OPEN.pop():
            fs, where = files(spark, path)
            fs.delete(where, True)
