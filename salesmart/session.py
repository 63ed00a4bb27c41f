"""Session settings used by the tests, the bench and local runs."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

from salesmart.workspace import SHARED_DIR


def _session(cores: int | str, app: str, **more: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.files.openCostInBytes", str(1 << 20))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
    )
    return builder.config(map=more).getOrCreate()


def local_session(cores: int | str = 8, app: str = "salesmart") -> SparkSession:
    """A local session; on a cluster the submitter's own session is used instead.

    The shared folder can only be set before a session starts, so one that
    turns out to have none is started again with a folder of its own.
    """
    spark = _session(cores, app)
    if not spark.conf.get(SHARED_DIR, None):
        spark.stop()
        spark = _session(cores, app, **{SHARED_DIR: tempfile.mkdtemp(prefix="salesmart-")})
    return spark
