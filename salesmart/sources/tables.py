"""Parquet tables: scans, replace, append, delete, update by rewrite."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.contracts import CONTRACTS, conform
from salesmart.operators.scalar import beside
from salesmart.sources.generators import literal
from salesmart.workspace import files, settle


VERSIONS, VERSION = "_versions", "v-"


class Conflict(OSError):
    """Another job published meanwhile; nothing of this one is visible."""


def _pointers(spark: SparkSession, path: str) -> list[str]:
    fs, where = files(spark, f"{path}/{VERSIONS}")
    return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []


def versions(spark: SparkSession, path: str) -> list[str]:
    """Names of the published versions of a folder, the latest first."""
    return [name.split(".", 1)[1] for name in reversed(_pointers(spark, path)) if "." in name]


def latest_number(spark: SparkSession, path: str) -> int:
    """Number of the latest version, or of an attempt to publish one; 0 if there is none."""
    return max((int(name.split(".", 1)[0]) for name in _pointers(spark, path)), default=0)


def current(spark: SparkSession, path: str) -> str:
    """The folder of the latest version; a folder without versions is its own."""
    known = versions(spark, path)
    return f"{path}/{known[0]}" if known else path


def publish(spark: SparkSession, path: str, version: str, expected: int | None = None) -> None:
    """Make a written version the current one, if ``expected`` still is the latest number.

    The next number is claimed by creating an empty file of that name, which
    one writer alone can do; a second file names the version.  Who reads the
    same latest number and comes second gets ``Conflict``.  A claim whose
    writer died names no version, and the next writer goes on behind it.  The
    store must create files atomically if they do not exist, as HDFS does; on
    an object store without that, publish through one job at a time.

    The version before stays for readers that still use it; older ones are removed.
    """
    fs, where = files(spark, f"{path}/{VERSIONS}")
    fs.mkdirs(where)
    before = _pointers(spark, path)
    latest = max((int(name.split(".", 1)[0]) for name in before), default=0)
    expected = latest if expected is None else expected
    claim = f"{path}/{VERSIONS}/{expected + 1:012d}"
    if latest != expected or not _created(spark, claim) or latest_number(spark, path) != expected + 1:
        raise Conflict(f"{path}: a version after number {expected} was published by another job")
    _created(spark, f"{claim}.{version}")
    named = [name for name in before if "." in name]
    in_use = {version, named[-1].split(".", 1)[1] if named else version}
    for name in before:
        if name not in named[-1:]:
            folder = name.split(".", 1)[1] if "." in name else None
            if folder and folder not in in_use:
                fs.delete(files(spark, f"{path}/{folder}")[1], True)
            fs.delete(files(spark, f"{path}/{VERSIONS}/{name}")[1], False)
    spark.catalog.refreshByPath(path)


def _created(spark: SparkSession, path: str) -> bool:
    fs, where = files(spark, path)
    if fs.getUri().getScheme() == "file":  # Hadoop's local file system looks first and creates then
        return spark.sparkContext._jvm.java.io.File(where.toUri().getPath()).createNewFile()
    try:
        return fs.createNewFile(where)
    except Py4JJavaError:
        if fs.exists(where):  # another writer was faster between the look and the creation
            return False
        raise


def new_version() -> str:
    return f"{VERSION}{uuid.uuid4().hex}"


def scan(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(current(spark, path))


def scan_tree(spark: SparkSession, path: str) -> DataFrame:
    """Every Parquet file below a folder; folder names are not read as partitions."""
    return spark.read.option("recursiveFileLookup", True).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    """Is there a published version, or data written straight into the folder?"""
    if versions(spark, path):
        return True
    fs, where = files(spark, path)
    return fs.exists(where) and any(not s.getPath().getName().startswith(("_", VERSION)) for s in fs.listStatus(where))


def replace(df: DataFrame, path: str, partition_by: list[str] | None = None, expected: int | None = None) -> DataFrame:
    """Write a new version and publish it; until then, and after a failure, readers see the old one.

    If another job publishes while this one writes, ``Conflict`` is raised.  A
    job whose rows come from the table itself passes as ``expected`` the
    ``latest_number`` from before it read.
    """
    spark, version = df.sparkSession, new_version()
    expected = latest_number(spark, path) if expected is None else expected
    _writer(df, partition_by).parquet(f"{path}/{version}")
    publish(spark, path, version, expected)
    return spark.read.schema(df.schema).parquet(f"{path}/{version}")


def append(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    spark = df.sparkSession
    if not versions(spark, path):
        return replace(df, path, partition_by)
    where = current(spark, path)
    _writer(df, partition_by, "append").parquet(where)
    spark.catalog.refreshByPath(where)
    return spark.read.schema(df.schema).parquet(where)


def _writer(df: DataFrame, partition_by: list[str] | None, mode: str = "errorifexists"):
    if not partition_by:
        return df.write.mode(mode)
    # Rebalancing gathers each partition value into few files and still splits a heavy one.
    return df.hint("rebalance", *partition_by).write.mode(mode).partitionBy(*partition_by)


def create(spark: SparkSession, table: str, path: str) -> DataFrame:
    """An empty table with the contract's columns; an old one is dropped."""
    return replace(literal(spark, [], CONTRACTS[table]), path)


def clear(spark: SparkSession, path: str) -> DataFrame:
    """Delete all rows and keep the schema."""
    expected = latest_number(spark, path)
    schema = scan(spark, path).schema
    return replace(literal(spark, [], schema), path, expected=expected)


def delete_where(spark: SparkSession, path: str, condition: Column, partition: str | None = None) -> DataFrame:
    """Rows for which the condition is true go; false and unknown stay.

    Of a partitioned table only the partitions that hold such rows are
    rewritten, from a settled copy, in the live version: that spares the rest
    of a large table, but a crash between two partitions leaves the later ones
    as they were (run it again), and readers of a touched partition should wait.
    """
    expected, path_now = latest_number(spark, path), current(spark, path)
    rows = scan(spark, path)
    gone = F.coalesce(condition, F.lit(False))
    if partition is None:
        return replace(rows.filter(~gone), path, expected=expected)
    key = F.col(partition)
    touched = [r[0] for r in rows.filter(gone).select(partition).distinct().collect()]
    if touched:
        kept = settle(rows.filter(key.isin(*touched) & ~gone), "kept")
        left = {r[0] for r in kept.select(partition).distinct().collect()}
        if left:
            kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path_now)
        for value in set(touched) - left:
            fs, where = files(spark, f"{path_now}/{partition}={value}")
            fs.delete(where, True)
        spark.catalog.refreshByPath(path_now)
    return spark.read.schema(rows.schema).parquet(path_now)


def mapped(df: DataFrame, mapping: dict[str, str], table: str | None = None) -> DataFrame:
    """Source to sink columns by name; unmapped columns are dropped, types follow the contract."""
    out = df.select(*(F.col(src).alias(dst) for src, dst in mapping.items()))
    return out if table is None else conform(out, table)


def update_control(control: DataFrame, process: str, values: DataFrame) -> DataFrame:
    """Rebuild the small control table with one process's row changed from a one-row frame."""
    names = values.columns
    joined = beside(control, values.select(*(F.col(n).alias(f"new_{n}") for n in names)))
    mine = F.col("ProcessName") == F.lit(process)
    return joined.select(
        *(F.when(mine, F.col(f"new_{c}")).otherwise(F.col(c)).alias(c) if c in names else F.col(c)
          for c in control.columns)
    )


def with_defaults(df: DataFrame, number: float = 0, text: str = "Unknown", keep: tuple[str, ...] = ()) -> DataFrame:
    """Missing numbers become ``number`` and missing text ``text`` before an export."""
    numbers = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in keep]
    texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType) and f.name not in keep]
    return df.fillna(number, subset=numbers).fillna(text, subset=texts)
