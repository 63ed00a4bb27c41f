"""Numbering, ranking, exact quantiles, z-scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.operators.quantiles import PROBS, grouped_quantiles
from salesmart.operators.scalar import beside
from salesmart.workspace import settle


def _settled_in_order(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows sorted across all tasks and written once, each with its range and its place in it.

    ``_place`` holds the range in its upper bits and the position in the lower 33.
    """
    ordered = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return settle(ordered.withColumn("_place", F.monotonically_increasing_id()), "ordered")


def _range_of(place: Column) -> Column:
    return F.shiftright(place, 33)


def _position_of(place: Column) -> Column:
    return place.bitwiseAND(F.lit((1 << 33) - 1))


def sequential_key(df: DataFrame, order: str, out: str, start: int = 1) -> DataFrame:
    """Number rows from ``start`` in the order of a unique column, in parallel.

    Rows are sorted into ranges, one task each, and a row's number is its place
    in its range plus the size of the ranges before it.
    """
    ranged = _settled_in_order(df, [order])
    sizes = ranged.groupBy(_range_of(F.col("_place")).alias("_range")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # One row per sort task, so a single window task and a broadcast are safe here.
    offsets = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    number = F.col("_before") + _position_of(F.col("_place")) + F.lit(start)
    return (
        ranged.join(F.broadcast(offsets), _range_of(F.col("_place")) == F.col("_range"))
        .withColumn(out, number.cast("bigint"))
        .select(out, *df.columns)
    )


def exact_quantiles(df: DataFrame, columns: list[str], probs: tuple[float, ...] = PROBS) -> DataFrame:
    """Exact quantiles with linear interpolation, one row per column.

    Columns are groups of one long table, which is never sorted: see
    ``quantiles``.
    """
    items = F.array(*(F.struct(F.lit(c).alias("Feature"), F.col(c).cast("double").alias("value")) for c in columns))
    return grouped_quantiles(df.select(F.inline(items)), ["Feature"], "value", probs)


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles, one row per column."""
    aggregates = []
    for c in columns:
        x = F.col(c).cast("double")
        aggregates += [
            F.count(x).alias(f"{c}|n"), F.avg(x).alias(f"{c}|mean"), F.stddev_samp(x).alias(f"{c}|std"),
            F.min(x).alias(f"{c}|min"), F.max(x).alias(f"{c}|max"),
        ]
    wide = df.agg(*aggregates)
    rows = ", ".join(f"'{c}', `{c}|n`, `{c}|mean`, `{c}|std`, `{c}|min`, `{c}|max`" for c in columns)
    moments = wide.select(F.expr(f"stack({len(columns)}, {rows}) as (Feature, Count, Mean, Std, Min, Max)"))
    return moments.join(exact_quantiles(df, columns), "Feature", "left")


def top_children(df: DataFrame, parent: list[str], measure: str, n: int, ties: list[str]) -> DataFrame:
    """The ``n`` largest rows under each parent, with their rank."""
    w = Window.partitionBy(*parent).orderBy(F.desc(measure), *ties)
    return df.withColumn("Rank", F.row_number().over(w)).filter(F.col("Rank") <= n)


def z_scores(df: DataFrame, columns: list[str], suffix: str = "") -> DataFrame:
    """Mean 0 and population deviation 1 per column; a constant column becomes 0."""
    moments = df.agg(
        *(F.avg(F.col(c).cast("double")).alias(f"_m{i}") for i, c in enumerate(columns)),
        *(F.stddev_pop(F.col(c).cast("double")).alias(f"_s{i}") for i, c in enumerate(columns)),
    )
    scored = beside(df, moments).withColumns(
        {
            f"{c}{suffix}": F.coalesce(F.try_divide(F.col(c).cast("double") - F.col(f"_m{i}"), F.col(f"_s{i}")), F.lit(0.0))
            for i, c in enumerate(columns)
        }
    )
    return scored.drop(*(f"_{k}{i}" for k in "ms" for i in range(len(columns))))
