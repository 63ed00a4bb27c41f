"""Calendar days, minutes of the day, and small literal tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.contracts import CONTRACTS
from salesmart.functions.labels import UNKNOWN, UNKNOWN_KEY

MINUTES_PER_DAY = 24 * 60

# National holidays 2020-2023.
HOLIDAYS = (
    dt.date(2020, 1, 1),
    dt.date(2020, 4, 10),
    dt.date(2020, 4, 12),
    dt.date(2020, 4, 25),
    dt.date(2020, 5, 1),
    dt.date(2020, 6, 10),
    dt.date(2020, 6, 11),
    dt.date(2020, 8, 15),
    dt.date(2020, 10, 5),
    dt.date(2020, 11, 1),
    dt.date(2020, 12, 1),
    dt.date(2020, 12, 8),
    dt.date(2020, 12, 25),
    dt.date(2021, 1, 1),
    dt.date(2021, 4, 2),
    dt.date(2021, 4, 4),
    dt.date(2021, 4, 25),
    dt.date(2021, 5, 1),
    dt.date(2021, 6, 3),
    dt.date(2021, 6, 10),
    dt.date(2021, 8, 15),
    dt.date(2021, 10, 5),
    dt.date(2021, 11, 1),
    dt.date(2021, 12, 1),
    dt.date(2021, 12, 8),
    dt.date(2021, 12, 25),
    dt.date(2022, 1, 1),
    dt.date(2022, 4, 15),
    dt.date(2022, 4, 17),
    dt.date(2022, 4, 25),
    dt.date(2022, 5, 1),
    dt.date(2022, 6, 10),
    dt.date(2022, 6, 16),
    dt.date(2022, 8, 15),
    dt.date(2022, 10, 5),
    dt.date(2022, 11, 1),
    dt.date(2022, 12, 1),
    dt.date(2022, 12, 8),
    dt.date(2022, 12, 25),
    dt.date(2023, 1, 1),
    dt.date(2023, 4, 7),
    dt.date(2023, 4, 9),
    dt.date(2023, 4, 25),
    dt.date(2023, 5, 1),
    dt.date(2023, 6, 8),
    dt.date(2023, 6, 10),
    dt.date(2023, 8, 15),
    dt.date(2023, 10, 5),
    dt.date(2023, 11, 1),
    dt.date(2023, 12, 1),
    dt.date(2023, 12, 8),
    dt.date(2023, 12, 25),
)


def date_bounds(df: DataFrame, column: Column) -> DataFrame:
    """One row with the first and last date of a column."""
    day = column.cast("date")
    return df.agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"))


def fixed_bounds(spark: SparkSession, first: dt.date, last: dt.date) -> DataFrame:
    return spark.range(1, numPartitions=1).select(F.lit(first).alias("first_day"), F.lit(last).alias("last_day"))


def every_day(bounds: DataFrame) -> DataFrame:
    """One row per day from first to last, both included; keeps ``last_day`` beside it."""
    days = F.sequence("first_day", "last_day", F.expr("interval 1 day"))
    return bounds.select(F.explode(days).alias("FullDate"), "last_day")


def every_minute(spark: SparkSession) -> DataFrame:
    return spark.range(0, MINUTES_PER_DAY, 1, 1).select(F.col("id").cast("int").alias("minute_of_day"))


def is_holiday(d: Column, holidays: tuple[dt.date, ...] = HOLIDAYS) -> Column:
    return d.isin(*holidays) if holidays else F.lit(False)


def literal(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """A few given rows, built as constants in the plan."""
    typed = [
        F.struct(*(F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, schema))) for row in rows
    ]
    if not typed:
        return spark.range(0).select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in schema))
    return spark.range(1, numPartitions=1).select(F.inline(F.array(*typed)))


def unknown_product(spark: SparkSession) -> DataFrame:
    """The row facts point to when their product is not in the master data."""
    row = (UNKNOWN_KEY, UNKNOWN_KEY, "Unknown Product", UNKNOWN, UNKNOWN, UNKNOWN, False, UNKNOWN)
    return literal(spark, [row], CONTRACTS["DimProduct"])


def first_watermark(spark: SparkSession, process: str) -> DataFrame:
    """Seed row of the control table: nothing loaded yet."""
    return spark.range(1, numPartitions=1).select(
        F.lit(process).alias("ProcessName"),
        F.lit(dt.datetime(1900, 1, 1)).cast("timestamp_ntz").alias("LastSourceSaleDateTime"),
        F.lit(0).cast("bigint").alias("LastSaleID"),
        F.lit(None).cast("timestamp_ntz").alias("LastSuccessfulRun"),
        F.localtimestamp().alias("UpdatedAt"),
    )
