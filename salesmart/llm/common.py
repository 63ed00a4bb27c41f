"""Small helpers shared by the text operators."""

from __future__ import annotations

import math
import os
import re
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.workspace import settle

#: The white space of all contracts: space and the control characters 9 to 13.
WHITE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def col(name: str) -> Column:
    """A column by its exact name, whatever characters are in it."""
    return F.col("`" + name.replace("`", "``") + "`")


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(name: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(col(name).cast("string"), F.lit(""))


def on_worker(function: Callable, **parameters) -> Callable:
    """``function(batches, **parameters)`` for ``mapInPandas`` and its kin.

    The function is looked up by name where it runs, so what its module keeps
    (a loaded tokenizer, say) serves all tasks of a worker.
    """
    module, name, root = function.__module__, function.__name__, ROOT

    def run(batches):
        import importlib
        import sys

        if root not in sys.path:
            sys.path.append(root)
        return getattr(importlib.import_module(module), name)(batches, **parameters)

    return run


_HELD: dict[str, dict] = {}


def holdings(owner: str) -> dict:
    """What an operator keeps in a worker between tasks; what others kept there is dropped."""
    for name in [n for n in _HELD if n != owner]:
        del _HELD[name]
    return _HELD.setdefault(owner, {})


def give_back() -> None:
    """Return freed memory to the system, as workers live on between tasks beside an executor's heap."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def bitmap_of(keys: DataFrame, key: str, bits: int) -> DataFrame:
    """Which of ``2**bits`` hash places the keys take: at most ``2**bits / 32768 + 1`` rows of 4 KB."""
    place = F.pmod(F.xxhash64(key), F.lit(1 << bits))
    return (
        keys.select(place.alias("place"))
        .groupBy(F.bitmap_bucket_number("place").alias("bitmap_part"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bitmap"))
    )


def with_flag(rows: DataFrame, bitmap: DataFrame, key: str, bits: int, out: str) -> DataFrame:
    """Add ``out``: is the place of ``key`` taken?  Never false for a key that was put in.

    The broadcast side is bounded by ``bits``, whatever the number of keys.
    """
    place = F.pmod(F.xxhash64(key), F.lit(1 << bits))
    marked = rows.withColumn("bitmap_place", place).withColumn("bitmap_part", F.bitmap_bucket_number("bitmap_place"))
    byte = F.expr(
        "cast(conv(hex(substring(bitmap, cast(bitmap_bit_position(bitmap_place) div 8 as int) + 1, 1)), 16, 10) as int)"
    )
    bit = F.expr("cast(bitmap_bit_position(bitmap_place) % 8 as int)")
    return (
        marked.join(F.broadcast(bitmap), "bitmap_part", "left")
        .withColumn("bitmap_byte", byte)
        .withColumn(out, F.coalesce(F.getbit("bitmap_byte", bit) == 1, F.lit(False)))
        .drop("bitmap_part", "bitmap_place", "bitmap", "bitmap_byte")
    )


def running(
    rows: DataFrame, group: list[str], order: list[str], values: dict[str, str | Column], spread: int = 1, bucket: Column | None = None
) -> DataFrame:
    """Running totals before each row, per group, without a task that holds a whole group.

    Rows of a group are ordered by ``bucket`` (by default the hash of ``order``
    modulo ``spread``) and, inside it, by ``order``.  Totals of buckets are added up first (a row for each), then rows inside each bucket.  ``values`` maps the name of a new
    column to what it adds up.  ``rows`` is read twice and so should be a
    written table; group columns must not be null.
    """
    bucketed = rows.withColumn("run_bucket", F.pmod(F.xxhash64(*order), F.lit(spread)) if bucket is None else bucket)
    keys = [*group, "run_bucket"]
    sums = {f"run_{n}": F.sum(v) for n, v in values.items()}
    before = Window.partitionBy(*group).orderBy("run_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = bucketed.groupBy(*keys).agg(*(v.alias(n) for n, v in sums.items()))
    offsets = offsets.select(*keys, *(F.coalesce(F.sum(n).over(before), F.lit(0)).alias(n) for n in sums))
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    summed = bucketed.withColumns({n: F.coalesce(F.sum(v).over(inside), F.lit(0)) for n, v in values.items()})
    return (
        summed.join(offsets, keys)
        .withColumns({n: (F.col(n) + F.col(f"run_{n}")).cast("bigint") for n in values})
        .drop("run_bucket", *sums)
    )


#: Most tasks of a shuffle that is laid out by size: the driver keeps a size for each pair of tasks.
TASKS = 1 << 15


def tasks_for(total: int, each: int) -> int:
    """Tasks of about ``each`` units; beyond ``TASKS`` of them tasks grow instead, and spill to disk where they must."""
    return min(1 + int(total) // each, TASKS)


def spread_for(rows: int) -> int:
    """Hash buckets for ``running``: as many as rows in one, so that neither step has a long window."""
    return 1 + math.isqrt(rows)


SPACE = re.compile(rb"[\x20\x09-\x0D]")


def word_blocks(data: bytes, size: int = 1 << 22) -> Iterator[list[bytes]]:
    """The words of a text, some megabytes at a time, so that a huge text needs little memory."""
    start = 0
    while start < len(data):
        found = SPACE.search(data, start + size) if start + size < len(data) else None
        end = found.start() if found else len(data)
        yield data[start:end].split()
        start = end


def without(rows: DataFrame, ids: DataFrame, id_col: str, bits: int = 23) -> DataFrame:
    """``rows`` whose id is not among ``ids`` (one column of the same name); a null id stays.

    A bitmap of fixed size lets most rows pass where they are; only those that
    it cannot clear are moved to be matched exactly.
    """
    gone = settle(ids.select(col(id_col).alias("gone_id")).distinct(), "gone")
    packed = rows.select(F.struct(*map(col, rows.columns)).alias("row"))
    packed = packed.withColumn("gone_id", F.col("row").getField(id_col))
    flagged = with_flag(packed, settle(bitmap_of(gone, "gone_id", bits), "bitmap"), "gone_id", bits, "suspect")
    kept = flagged.filter("suspect").join(gone, "gone_id", "left_anti")
    return flagged.filter("not suspect").select("row").unionByName(kept.select("row")).select("row.*")
