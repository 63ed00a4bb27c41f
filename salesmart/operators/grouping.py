"""Aggregations.  All of them combine on the map side, so a hot key stays cheap; ``dealt`` is for keys that hardly repeat."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.operators.scalar import beside


#: Rows that a task of ``dealt`` gets, and the most tasks: the driver keeps a size for each pair of tasks.
DEALT = 1 << 18
MOST_DEALT = 1 << 15


def dealt(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """Rows laid out for a grouping by ``keys`` that leaves nearly as many rows as there are.

    Combining these on the map side only fills a task's memory with all the
    rows of its part of the input; here a task groups about ``DEALT`` of the
    ``rows``, whatever the size of the input.  Of a key with many rows the one
    task that reads them keeps a single entry.
    """
    return df.repartition(min(1 + rows // DEALT, MOST_DEALT), *keys)


def single_value(c: Column, default: Column | None = None) -> Column:
    """The group's value when it has just one, a null counting as a value of its own."""
    alone = (F.min(c) == F.max(c)) & (F.count(c) == F.count(F.lit(1)))
    found = F.when(alone, F.min(c))
    return found if default is None else found.otherwise(default)


def first_known(c: Column, order: Column) -> Column:
    """First non-null value by an explicit order."""
    return F.min_by(c, F.when(c.isNotNull(), order))


def first_row(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One whole row per key, the first by ``order``; ``order`` should settle every tie."""
    rest = [c for c in df.columns if c not in keys]
    chosen = F.min_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(chosen).select(*keys, "_row.*").select(*df.columns)


def last_row(ts: Column, key: Column) -> Column:
    """(timestamp, id) of the latest row in one pass, without a sort."""
    return F.max(F.struct(ts.alias("ts"), key.alias("id")))


def word_of(number: Column) -> Column:
    """Which run of 64 numbers a whole number lies in; with ``bit_of`` distinct numbers are counted by ``bit_or``."""
    return F.shiftright(number.cast("bigint"), 6)


def bit_of(number: Column) -> Column:
    """A whole number as the one bit of its place among 64."""
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), number.cast("bigint").bitwiseAND(F.lit(63)).cast("int"))


def sum_if(condition: Column, c: Column) -> Column:
    return F.sum(F.when(condition, c).otherwise(F.lit(0)))


def drill(df: DataFrame, levels: list[str], measures: list[Column]) -> DataFrame:
    """Totals at every level of a hierarchy; ``Level`` counts the levels that are set."""
    n = len(levels)
    set_levels = sum((1 - F.grouping(c).cast("int") for c in levels), F.lit(0))
    return df.rollup(*levels).agg(set_levels.cast("int").alias("Level"), *measures) if n else df.agg(*measures)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One wide row with the row count of each table."""
    wide = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias(f"{name}Rows"))
        wide = one if wide is None else beside(wide, one)
    return wide


def long_form(one_row: DataFrame, labels: dict[str, str], name: str, value: str) -> DataFrame:
    """Turn the columns of a one-row frame into labelled rows."""
    pairs = ", ".join(f"'{label}', cast(`{c}` as bigint)" for c, label in labels.items())
    return one_row.select(F.expr(f"stack({len(labels)}, {pairs}) as (`{name}`, `{value}`)"))
