"""Exact deduplication by progressive refinement, with DataFrame functions only.

1. One pass takes the byte length and the hash of the first characters of each
   normalised text.  Rows are grouped by both; a row that is alone in its
   length is alone here too, so the first two refinements are one grouping.
2. Groups of two or more go into a bitmap of fixed size, which is all that is
   broadcast.  A second pass tests each row against it and computes the full
   hash for survivors only; the bitmap lets some lone rows through and never
   loses a row.
3. Survivors are grouped by length, prefix hash and full hash.

Text never moves in ``mark``.  A group of copies sends one row per task, and
the result of a group is joined back from a written table, so Spark can split
a large group over tasks.

Null text counts as empty.  Empty tables give empty results.  Of rows that
share id and text one stays.  A null id sorts before all others.  Other
columns, whatever their names, are ignored by ``mark`` and kept by ``distinct``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import bitmap_of, col, text_of, with_flag
from salesmart.workspace import settle

#: Characters of the prefix, and the bitmap's size as a power of two (1 MB).
PREFIX = 64
BITS = 23

#: Only runs that are not one plain space already are touched.
UNEVEN = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"
KEYS = ["n_bytes", "prefix"]


def normalised(text: Column) -> Column:
    """Each run of white space as one space."""
    return F.regexp_replace(text, UNEVEN, " ")


def _outlined(rows: DataFrame, prefix: int) -> DataFrame:
    return rows.withColumns(
        {"n_bytes": F.octet_length("norm"), "prefix": F.xxhash64(F.substring("norm", 1, prefix))}
    ).withColumn("outline", F.struct(*KEYS))


def _refined(rows: DataFrame, prefix: int, bits: int) -> DataFrame:
    """``rows`` (with the text as ``norm``) with their outline and whether it may be shared (``alive``)."""
    outlined = _outlined(rows, prefix)
    shared = outlined.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    bitmap = settle(bitmap_of(shared.select(F.struct(*KEYS).alias("outline")), "outline", bits), "outlines")
    return with_flag(outlined, bitmap, "outline", bits, "alive").drop("outline")


def mark(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, hash_all: bool = False, prefix: int = PREFIX, bits: int = BITS
) -> DataFrame:
    """One row per row of ``docs``: its id, the id that stays, size of its group, is it the one that stays, full hash.

    The hash is null for rows that needed none, unless ``hash_all``.
    """
    rows = docs.select(col(id_col).alias("doc_id"), normalised(text_of(text_col)).alias("norm"))
    needed = F.lit(True) if hash_all else F.col("alive")
    found = settle(
        _refined(rows, prefix, bits).select(
            "doc_id", *KEYS, "alive", F.when(needed, F.sha2("norm", 256)).alias("text_sha256"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "hashes",
    )
    full = [*KEYS, "text_sha256"]
    groups = settle(
        found.filter("alive").groupBy(*full)
        .agg(F.min(F.struct("doc_id", "row")).alias("first"), F.count(F.lit(1)).alias("group_size")).filter("group_size > 1"),
        "copies",
    )
    alone = found.filter("not alive").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"), F.lit(True).alias("kept"), "text_sha256"
    )
    met = found.filter("alive").join(groups, full, "left").select(
        "doc_id", F.when(F.col("first").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("bigint")).alias("group_size"),
        F.coalesce(F.col("first.row") == F.col("row"), F.lit(True)).alias("kept"), "text_sha256",
    )
    return alone.unionByName(met)


def distinct(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, prefix: int = PREFIX, bits: int = BITS) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Lone rows go straight through; only survivors of the refinement are moved,
    and copies meet already on the map side.
    """
    rows = docs.select(F.struct(*(col(c) for c in docs.columns)).alias("row")).withColumn(
        "norm", normalised(F.coalesce(F.col("row").getField(text_col).cast("string"), F.lit("")))
    )
    refined = _refined(rows, prefix, bits)
    first = (
        refined.filter("alive").withColumn("text_sha256", F.sha2("norm", 256)).groupBy(*KEYS, "text_sha256")
        .agg(F.min_by("row", F.struct(F.col("row").getField(id_col))).alias("row"))
    )
    return refined.filter("not alive").select("row").unionByName(first.select("row")).select("row.*")
