"""Values of a one-row frame next to the rows of another."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def beside(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Add the columns of a one-row frame as a scalar subquery: run once, and an error if it has more rows."""
    values = one_row.select(F.struct(*one_row.columns)).scalar()
    return df.withColumn("_one", values).select(*df.columns, "_one.*")
