"""Incremental load behind a stored high-water mark."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.contracts import conform
from salesmart.functions.dates import to_second
from salesmart.operators.filters import INSERT_REQUIRED, above_mark, above_pair, complete
from salesmart.operators.grouping import last_row
from salesmart.operators.lookups import new_rows

PROCESS = "Load_FactSales"
FIRST = dt.datetime(1900, 1, 1)


def mark_row(control: DataFrame, process: str = PROCESS) -> DataFrame:
    """The control row of one process: the last loaded timestamp and id."""
    return control.filter(F.col("ProcessName") == F.lit(process)).select("LastSourceSaleDateTime", "LastSaleID")


def last_sale_id(control: DataFrame, process: str = PROCESS) -> int:
    row = mark_row(control, process).select(F.coalesce("LastSaleID", F.lit(0)).alias("id")).first()
    return row.id if row else 0


@dataclass(frozen=True)
class Mark:
    """What has been loaded, and how rows are held against it.

    By id alone, or (``composite``) by timestamp and then id, which also lets
    in late ids with later timestamps.
    """

    last_id: int
    last_ts: dt.datetime | None = None
    composite: bool = False

    def above(self, ts: Column, key: Column) -> Column:
        if not self.composite:
            return above_mark(key, self.last_id)
        last = F.lit(self.last_ts or FIRST).cast("timestamp_ntz")
        return above_pair(ts, key, last, F.lit(self.last_id))


def read_mark(control: DataFrame, composite: bool = False, process: str = PROCESS) -> Mark:
    row = mark_row(control, process).first()
    return Mark(row.LastSaleID or 0, row.LastSourceSaleDateTime, composite) if row else Mark(0, None, composite)


def stage(facts: DataFrame, mark: Mark | int) -> DataFrame:
    """Rows above the mark in the staging table's shape."""
    mark = Mark(mark) if isinstance(mark, int) else mark
    above = mark.above(F.col("SourceSaleDateTime"), F.col("PK_SaleID"))
    rows = facts.filter(above).withColumnRenamed("PK_SaleID", "SaleID")
    stamps = {c: to_second(F.col(c)) for c in ("SourceSaleDateTime", "LoadDateTime")}
    return conform(rows.withColumns(stamps), "FactSales_IncrementalBatch")


def rows_to_insert(staged: DataFrame, facts: DataFrame, mark: Mark | int | None = None) -> DataFrame:
    """Staged rows above the mark (if there is one), complete, and not in the facts yet."""
    if mark is not None:
        mark = Mark(mark) if isinstance(mark, int) else mark
        staged = staged.filter(mark.above(F.col("SourceSaleDateTime"), F.col("SaleID")))
    ready = complete(staged, INSERT_REQUIRED)
    fresh = new_rows(ready, facts, "SaleID", "PK_SaleID")
    return conform(
        fresh.withColumnRenamed("SaleID", "PK_SaleID").withColumn("LoadDateTime", F.localtimestamp()), "FactSales"
    )


def within_batch(staged: DataFrame, facts: DataFrame) -> DataFrame:
    """Facts inside the batch's id range: all that can collide, and a range the scan can skip by."""
    span = staged.agg(F.min("SaleID").alias("lo"), F.max("SaleID").alias("hi")).first()
    if span.lo is None:
        return facts.limit(0)
    return facts.filter(F.col("PK_SaleID").between(F.lit(span.lo), F.lit(span.hi)))


def next_mark(loaded: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """The latest sale by timestamp, then id, as a one-row frame for the control table.

    ``loaded`` are the rows a load has just put in; with the ``stored`` mark
    beside them the facts need not be read again.
    """
    seen = loaded.select(F.col("SourceSaleDateTime").alias("ts"), F.col("PK_SaleID").alias("id"))
    if stored is not None:
        old = stored.select(F.col("LastSourceSaleDateTime").alias("ts"), F.col("LastSaleID").alias("id"))
        seen = seen.unionByName(old.filter(F.col("ts").isNotNull() & F.col("id").isNotNull()))
    latest = seen.agg(last_row(F.col("ts"), F.col("id")).alias("r"))
    return latest.select(
        F.col("r.ts").alias("LastSourceSaleDateTime"), F.col("r.id").alias("LastSaleID"),
        F.localtimestamp().alias("LastSuccessfulRun"), F.localtimestamp().alias("UpdatedAt"),
    )


def log_line(
    run: str, job: str, step: str, table: str | None, rows: int | None, started: dt.datetime,
    status: str = "Succeeded", error: str | None = None,
) -> tuple:
    """A row of the run log."""
    return (run, job, step, table, rows, 0, status, error, started, dt.datetime.now())
