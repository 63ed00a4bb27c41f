"""Exact quantiles per group, found by a sketch and settled inside its bracket.

1. One pass makes a quantile sketch per group, which merges on the map side.
   For each probability it names two values that the quantile lies between for
   sure, as the sketch's error has a bound.
2. A second pass counts, per group and probability, the rows below and above
   this bracket, and the rows of each value inside it.  Counts merge on the map
   side; a group's rows meet its bracket in ``SALTS`` tasks.
3. A bracket that still holds very many values is cut into equal parts, of
   which only those with the wanted ranks are kept, until few enough are left.
4. Only these are put in order.

So no task sees all rows of a group, however many it has, and no more than
``MOST`` values of one are sorted.  Missing values do not count; a null key is
a group of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.operators.lookups import salted_join
from salesmart.workspace import settle

PROBS = (0.25, 0.5, 0.75)
#: Ranks of the sketch are off by at most one in ACCURACY of a group's rows.
ACCURACY = 10_000
#: Values of one group and probability that a task sorts, and parts that a bracket is cut into.
MOST = 1_000_000
PARTS = 1024


def _brackets(rows: DataFrame, keys: list[str], probs: tuple[float, ...], accuracy: int) -> DataFrame:
    reach = 3 / accuracy
    ends = [q for p in probs for q in (max(0.0, p - reach), min(1.0, p + reach))]
    sketched = rows.groupBy(*keys).agg(F.percentile_approx("_v", ends, accuracy).alias("_ends"))
    each = [
        F.struct(F.lit(p).alias("_p"), F.col("_ends")[2 * i].alias("_lo"), F.col("_ends")[2 * i + 1].alias("_hi"))
        for i, p in enumerate(probs)
    ]
    return settle(sketched.select(*keys, F.array(*each).alias("_each")), "brackets")


def _counted(rows: DataFrame, group: list[str], side: Column, value: Column, n: Column) -> DataFrame:
    """Per group, how many rows lie below (-1) and above (1), with the nearest of them, and how many have each value inside (0)."""
    return settle(
        rows.select(*group, side.cast("int").alias("_side"), value.alias("_v"), n.alias("_n"))
        .groupBy(*group, "_side", F.when(F.col("_side") == 0, F.col("_v")).alias("_inside"))
        .agg(F.sum("_n").alias("_n"), F.when(F.col("_side") < 0, F.max("_v")).otherwise(F.min("_v")).alias("_v")).drop("_inside"),
        "cells",
    )


def _ranked(cells: DataFrame, group: list[str]) -> DataFrame:
    """Per group: rows in all, and the two ranks from 0 that the quantile lies between."""
    totals = cells.groupBy(*group).agg(
        F.sum("_n").alias("_total"), F.sum(F.when(F.col("_side") < 0, F.col("_n")).otherwise(0)).alias("_below"),
        F.min(F.when(F.col("_side") == 0, F.col("_v"))).alias("_first"), F.max(F.when(F.col("_side") == 0, F.col("_v"))).alias("_last"),
    )
    rank = F.col("_p") * (F.col("_total") - 1)
    return totals.withColumns({"_low": F.floor(rank), "_high": F.ceil(rank), "_part": rank - F.floor(rank)})


def _narrowed(cells: DataFrame, group: list[str], parts: int) -> DataFrame:
    """The same cells with a smaller bracket: parts of it without a wanted rank go below or above."""
    ranked = settle(_ranked(cells, group), "ranks")
    width = F.col("_last") - F.col("_first")
    part = F.when(width > 0, F.floor((F.col("_v") - F.col("_first")) / width * (parts - 1))).otherwise(F.lit(0))
    met = salted_join(cells, ranked, group, ["_v"]).withColumn("_place", F.when(F.col("_side") == 0, part))
    sums = met.filter("_side = 0").groupBy(*group, "_place").agg(
        F.sum("_n").alias("_n"), *(F.first(c).alias(c) for c in ("_below", "_low", "_high"))
    )
    # At most ``parts`` rows of a group are put in order here.
    upto = F.col("_below") + F.sum("_n").over(Window.partitionBy(*group).orderBy("_place"))
    held = sums.withColumn("_upto", upto).filter((F.col("_upto") > F.col("_low")) & (F.col("_upto") - F.col("_n") <= F.col("_high")))
    wanted = settle(held.groupBy(*group).agg(F.min("_place").alias("_from"), F.max("_place").alias("_to")), "parts")
    kept = salted_join(met.select(*group, "_side", "_v", "_n", "_place"), wanted, group, ["_v"], how="left")
    side = (
        F.when(F.col("_side") != 0, F.col("_side")).when(F.col("_place") < F.col("_from"), -1)
        .when(F.col("_place") > F.col("_to"), 1).otherwise(0)
    )
    return _counted(kept, group, side, F.col("_v"), F.col("_n"))


def grouped_quantiles(
    df: DataFrame, keys: list[str], value: str, probs: tuple[float, ...] = PROBS, *, accuracy: int = ACCURACY, most: int = MOST,
    parts: int = PARTS,
) -> DataFrame:
    """Quantiles with linear interpolation, one row per group: its keys and P25, P50, ..."""
    rows = df.select(*keys, F.col(value).cast("double").alias("_v")).filter(F.col("_v").isNotNull())
    group = [*keys, "_p"]
    met = salted_join(rows, _brackets(rows, keys, probs, accuracy), keys, ["_v"]).select(*keys, "_v", F.inline("_each"))
    side = F.when(F.col("_v") < F.col("_lo"), -1).when(F.col("_v") > F.col("_hi"), 1).otherwise(0)
    cells = _counted(met, group, side, F.col("_v"), F.lit(1))
    while True:
        values = cells.filter("_side = 0").groupBy(*group).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("_v").alias("d"))
        if (values.agg(F.max("d")).first()[0] or 0) <= most:
            break
        cells = _narrowed(cells, group, parts)
    ordered = Window.partitionBy(*group).orderBy("_side", "_v")
    placed = cells.withColumn("_upto", F.sum("_n").over(ordered)).join(
        _ranked(cells, group).select(*(F.col(k).alias(f"_of_{k}") for k in group), "_low", "_high", "_part"),
        _same(group), "inner",
    )

    def at(rank: str) -> Column:
        """The value of one rank; of the rows outside the bracket only the nearest is known."""
        since = F.col("_upto") - F.col("_n")
        known = (F.col("_side") == 0) | F.when(F.col("_side") < 0, F.col(rank) == F.col("_upto") - 1).otherwise(F.col(rank) == since)
        here = (F.col(rank) >= since) & (F.col(rank) < F.col("_upto"))
        return F.max(F.when(here & known, F.col("_v")).when(here, F.raise_error(F.lit("the sketch's bracket misses a quantile"))))

    each = placed.groupBy(*group).agg((at("_low") + (at("_high") - at("_low")) * F.max("_part")).alias("_q"))
    return each.groupBy(*keys).agg(*(F.max(F.when(F.col("_p") == p, F.col("_q"))).alias(f"P{round(p * 100)}") for p in probs))


def _same(keys: list[str]) -> Column:
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_of_{k}"))
    return on


# ---- outliers ----------------------------------------------------------------------------


def outlier_limits(df: DataFrame, keys: list[str], value: str, k: float) -> DataFrame:
    """Per group, the value above which a row is an outlier: median + k x interquartile range."""
    quartiles = grouped_quantiles(df, keys, value)
    limit = F.col("P50") + (F.col("P75") - F.col("P25")) * F.lit(float(k))
    return settle(quartiles.select(*keys, F.round(limit, 6).alias("OutlierLimit")), "limits")


def with_outlier_flag(df: DataFrame, keys: list[str], value: str, k: float) -> DataFrame:
    """``df`` with ``OutlierLimit`` and ``IsOutlier``; a missing value is none."""
    limits = outlier_limits(df, keys, value, k)
    flagged = F.coalesce(F.col(value).cast("double") > F.col("OutlierLimit"), F.lit(False))
    return salted_join(df, limits, keys, [value], how="left").withColumn("IsOutlier", flagged)


def without_outliers(df: DataFrame, keys: list[str], value: str, k: float) -> DataFrame:
    return with_outlier_flag(df, keys, value, k).filter(~F.col("IsOutlier")).select(*df.columns)
