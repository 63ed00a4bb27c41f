"""Joins that look something up.

Dimension sides carry no broadcast hint: their size follows the data, so Spark
decides from the sizes it measures.  Only frames with a fixed bound are
broadcast by hand.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.functions.labels import UNKNOWN_KEY
from salesmart.functions.text import match_key
from salesmart.operators.grouping import single_value
from salesmart.workspace import settle

LOWEST = -(2**63)
SPREAD = 4096
SALTS = 32
#: Most keys that are looked up by broadcast, and most rows of a side for them.
MOST_HOT = 256
HOT_ROWS = 4096


def unique_map(df: DataFrame, key: str, value: str, fold: bool = False) -> DataFrame:
    """Key to value, for keys that have exactly one value; rows with a null are left out."""
    name = match_key(F.col(key)) if fold else F.col(key)
    return (
        df.dropna(subset=[key, value])
        .groupBy(name.alias(key))
        .agg(single_value(F.col(value)).alias(value))
        .filter(F.col(value).isNotNull())
    )


def surrogate(df: DataFrame, code: str, dim: DataFrame, natural: str, key: str, out: str) -> DataFrame:
    """Surrogate key of a natural code; no code or no match gives the unknown member.

    Rows without a code may be many.  They get probes that no code has and that
    spread them over all tasks, instead of meeting on one value.
    """
    side = dim.select(F.col(natural).alias("_natural"), F.col(key).alias("_key"))
    nowhere = F.lit(LOWEST) + F.pmod(F.xxhash64(*df.columns), F.lit(SPREAD))
    probe = F.when(F.col(code).isNull(), nowhere).otherwise(F.col(code))
    return (
        df.withColumn("_probe", probe)
        .join(side, F.col("_probe") == F.col("_natural"), "left")
        .withColumn(out, F.coalesce(F.col("_key"), F.lit(UNKNOWN_KEY)).cast("bigint"))
        .drop("_probe", "_natural", "_key")
    )


def new_rows(batch: DataFrame, loaded: DataFrame, batch_key: str, loaded_key: str) -> DataFrame:
    """Batch rows whose key is not loaded yet.

    The loaded table is first cut down to the batch's keys.  When the batch is
    small Spark broadcasts it, and the big table is scanned but never shuffled.
    """
    keys = batch.select(F.col(batch_key).alias("_key"))
    hits = loaded.select(F.col(loaded_key).alias("_hit")).join(keys, F.col("_hit") == F.col("_key"), "left_semi")
    return batch.join(hits, F.col(batch_key) == F.col("_hit"), "left_anti")


def orphans(df: DataFrame, fk: str, dim: DataFrame, key: str) -> DataFrame:
    return df.join(dim.select(F.col(key).alias("_key")), F.col(fk) == F.col("_key"), "left_anti")


def orphan_report(facts: DataFrame, links: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows and keys without a parent, for every foreign key, from one scan of the facts.

    Facts shrink to one row per (foreign key, value) before they are shuffled.
    """
    pairs = ", ".join(f"'{fk}', cast({fk} as bigint)" for fk in links)
    seen = (
        facts.select(F.expr(f"stack({len(links)}, {pairs}) as (ForeignKey, KeyValue)"))
        .groupBy("ForeignKey", "KeyValue")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    parents = reduce(
        lambda a, b: a.unionByName(b),
        (
            dim.select(F.lit(fk).alias("ForeignKey"), F.col(key).cast("bigint").alias("KeyValue"))
            for fk, (dim, key) in links.items()
        ),
    ).withColumn("has_parent", F.lit(True))
    missing = F.col("has_parent").isNull()
    return (
        seen.join(parents, ["ForeignKey", "KeyValue"], "left")
        .groupBy("ForeignKey")
        .agg(
            F.coalesce(F.sum(F.when(missing, F.col("n"))), F.lit(0)).alias("OrphanRows"),
            F.count_if(missing).alias("OrphanKeys"),
        )
    )


def frequent_keys(df: DataFrame, key: str, most: int = MOST_HOT) -> list:
    """Values that at least one in ``most`` rows has, by a sketch that merges on the map side; no more than ``most``."""
    found = df.agg(F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(`{key}`, {most}, {most * 40})").alias("top")).first()
    return [t["item"] for t in found.top or () if t["item"] is not None and t["count"] * most >= found.n]


def enrich(df: DataFrame, side: DataFrame, on: str, defaults: dict[str, object] | None = None) -> DataFrame:
    """Left join on one name, with a default per column for rows that found nothing.

    Keys that very many rows have are found by a sketch; their few rows of the
    side are broadcast and give these rows their columns where they lie.  The
    others meet the rest of the side by a shuffle, in which rows that are done,
    and rows without a key, are spread evenly.
    """
    names = [c for c in side.columns if c != on]
    hot = frequent_keys(df, on)
    chosen = F.col(on).isin(*hot) if hot else F.lit(False)
    known = side.filter(chosen).select(F.col(on).alias("_hot"), F.struct(*names).alias("_here"))
    if hot:
        known = settle(known, "hot")
        if known.count() > HOT_ROWS:  # the side has many rows for a key
            hot, chosen, known = [], F.lit(False), known.filter(F.lit(False))
    # Always 0, but not seen to be: a constant would not count as a key of the join.
    lane = F.pmod(F.xxhash64(on), F.lit(1))
    rest = side.filter(~F.coalesce(chosen, F.lit(False))).select(F.col(on).alias("_rest"), F.struct(*names).alias("_there"), lane.alias("_lane"))
    met = df.join(F.broadcast(known), F.col(on) == F.col("_hot"), "left") if hot else df.withColumns(
        {"_hot": F.lit(None).cast(df.schema[on].dataType), "_here": F.lit(None).cast(known.schema["_here"].dataType)}
    )
    done = F.col("_hot").isNotNull() | F.col(on).isNull()
    met = met.withColumns(
        {
            "_probe": F.when(~done, F.col(on)),
            "_spread": F.when(done, F.pmod(F.xxhash64(*df.columns), F.lit(SPREAD))).otherwise(F.lit(0)),
        }
    )
    joined = met.join(rest, (F.col("_probe") == F.col("_rest")) & (F.col("_spread") == F.col("_lane")), "left")
    found = [F.when(F.col("_hot").isNotNull(), F.col("_here").getField(c)).otherwise(F.col("_there").getField(c)).alias(c) for c in names]
    out = joined.select(on, *(c for c in df.columns if c != on), *found)
    return out.fillna(defaults) if defaults else out


def salted_join(df: DataFrame, side: DataFrame, keys: list[str], by: list[str], how: str = "inner", salts: int = SALTS) -> DataFrame:
    """Join one row per key to rows of which one key may have very many.

    The rows of a key are dealt over ``salts`` tasks by the hash of ``by``, and
    the side, which has a row per key, is laid out once for each.  If it is
    small Spark broadcasts it instead.  Null keys match each other.
    """
    deal = F.pmod(F.xxhash64(*by), F.lit(salts))
    everywhere = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    names = [c for c in side.columns if c not in keys]
    laid = side.select(*(F.col(k).alias(f"_of_{k}") for k in keys), *names, everywhere.alias("_dealt"))
    on = F.col("_deal") == F.col("_dealt").cast("bigint")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_of_{k}"))
    return df.withColumn("_deal", deal).join(laid, on, how).select(*df.columns, *names)


def members_of(dim: DataFrame, key: str, selected: DataFrame, selected_key: str) -> DataFrame:
    """Dimension rows that a selection on a linked table leaves visible."""
    return dim.join(
        selected.select(F.col(selected_key).alias("_key")), F.col(key) == F.col("_key"), "left_semi"
    )


def matches(name: Column, values: tuple) -> Column:
    return name.isin(*values)
