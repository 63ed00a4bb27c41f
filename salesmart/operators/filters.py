"""Row filters."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.functions.text import has_text

FACT_REQUIRED = (
    "SaleID", "SourceSaleDateTime", "FK_Pharmacy", "FK_POS", "FK_Location", "FK_Operator", "Qty", "Amount",
)
INSERT_REQUIRED = (
    "SaleID", "FK_Date", "FK_Time", "FK_Product", "FK_Pharmacy", "FK_Location", "FK_Operator", "FK_POS",
)


def keyed_and_named(df: DataFrame, key: str, name: str) -> DataFrame:
    return df.filter(F.col(key).isNotNull() & has_text(F.col(name)))


def complete(df: DataFrame, columns: tuple[str, ...] = FACT_REQUIRED) -> DataFrame:
    return df.dropna(subset=list(columns))


def filter_computed(df: DataFrame, condition: Callable[[Callable[[str], Column]], Column]) -> DataFrame:
    """Filter on columns that were costly to compute.

    A plain filter would be pushed below the computation and repeat it inside
    the condition.  Here each row is computed once and then kept or left out.
    """
    rows = df.select(F.struct(*df.columns).alias("_row"))
    kept = F.when(condition(lambda name: F.col("_row")[name]), F.array("_row"))
    return rows.select(F.inline(kept))


def computed(df: DataFrame) -> DataFrame:
    """Columns evaluated once per row, however often they are used afterwards."""
    return df.select(F.struct(*df.columns).alias("_row")).select(F.inline(F.array("_row")))


def complete_computed(df: DataFrame, columns: tuple[str, ...] = FACT_REQUIRED) -> DataFrame:
    return filter_computed(df, lambda c: reduce(and_, (c(name).isNotNull() for name in columns)))


def analytical_valid(c: Callable[[str], Column] = F.col) -> Column:
    """Sales the segmentation may use: keys and values present, something sold, nothing negative."""
    present = reduce(
        and_, (c(name).isNotNull() for name in ("SaleID", "PharmacyID", "CNP", "Datetime", "Qty", "Amount"))
    )
    return F.coalesce(present & (c("Qty") > 0) & (c("Amount") >= 0), F.lit(False))


def above_mark(key: Column, last: Column | int) -> Column:
    return key > (last if isinstance(last, Column) else F.lit(last))


def above_pair(ts: Column, key: Column, last_ts: Column, last_key: Column) -> Column:
    """Later than the mark, or at the mark's instant with a higher id."""
    return (ts > last_ts) | ((ts == last_ts) & (key > last_key))


def not_in(c: Column, *values) -> Column:
    """Exclusion that keeps nulls."""
    return c.isNull() | ~c.isin(*values)


def half_open(d: Column, first: dt.date, end: dt.date) -> Column:
    return (d >= F.lit(first)) & (d < F.lit(end))


def after_except(d: Column, after: dt.date, *excluded: dt.date) -> Column:
    keep = d > F.lit(after)
    return keep & ~d.isin(*excluded) if excluded else keep
