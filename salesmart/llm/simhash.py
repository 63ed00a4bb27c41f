"""SimHash near-duplicates through an inverted index over byte positions.

Fingerprints of 64 bits that differ in at most d bits differ in at most d of
their 8 bytes, so a pair shares at least 8 - d positional bytes, and one half
of the fingerprint holds at least half of these.  The index lists distinct
fingerprints under each combination of that many bytes of one half (for d = 3
three of four bytes: 8 keys each).  Lists under single bytes would hold 1/256
of all fingerprints and tallying them would touch nearly all pairs.

Inside a list the shared positional bytes of each pair are tallied, pairs
below 8 - d are dropped, the rest are verified by bit distance.  What leaves
the list is a spanning forest of its links, never its pairs.

A list of more than ``crowd`` fingerprints is not compared in one task.  Two
fingerprints within d bits have a point that is at most d // 2 bits from one
and d - d // 2 from the other.  Each member of such a list names all points
that near; all members at a point are linked to one anchor.  Every such link
is a true one, none is lost, and the rows grow in proportion to the members.

Null and empty texts have fingerprint zero and are linked like any other.
Repeated rows come back as often as they came.  An empty table gives an empty
result.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import col, on_worker, text_of, word_blocks
from salesmart.llm.components import components
from salesmart.workspace import settle

WIDTH = 3
MAX_BITS = 3
CROWD = 4096
SEED = 42

def hashes(data: bytes, width: int) -> Iterator[np.ndarray]:
    """XXH64 of all shingles of the text, in blocks."""
    held: list[bytes] = []
    seen = False
    for words in word_blocks(data.lower()):
        words = held + words
        n = len(words) - width + 1
        if n > 0:
            seen = True
            shingles = map(b" ".join, zip(*(words[k : k + n] for k in range(width)), strict=True))
            yield np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, n)
        held = words[max(0, n) :]
    if held and not seen:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(held), SEED)], np.uint64)


def fingerprint(data: bytes, width: int = WIDTH) -> int:
    """Bit i is set if it is set in over half of the shingles' hashes; as a signed 64-bit number."""
    total, ones = 0, np.zeros(64, np.int64)
    for block in hashes(data, width):
        total += len(block)
        for part in range(0, len(block), 1 << 16):
            bits = block[part : part + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
            ones += np.unpackbits(bits, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > total, bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprint_batches(batches, width):
    for batch in batches:
        texts = batch.column(1).cast(pa.binary())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([fingerprint(t.as_py(), width) for t in texts], pa.int64())], ["doc_id", "fp"]
        )


class Forest:
    """Union of links among ``n`` numbered items; the smallest number is the root."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        a, b = self.root[a], self.root[b]
        while len(a):
            apart = a != b
            a, b = a[apart], b[apart]
            np.minimum.at(self.root, np.maximum(a, b), np.minimum(a, b))
            while not np.array_equal(self.root, higher := self.root[self.root]):
                self.root = higher
            a, b = self.root[a], self.root[b]


def linked(keys: np.ndarray, prints: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that span what is within ``max_bits`` inside each run of equal keys."""
    values, place = np.unique(prints, return_inverse=True)
    forest = Forest(len(values))
    left, lag = np.arange(len(keys)), 1
    while len(left := left[left + lag < len(keys)]) and len(left := left[keys[left] == keys[left + lag]]):
        apart = prints[left] ^ prints[left + lag]
        shared = (apart.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
        counted = shared >= 8 - max_bits
        near = left[counted][np.bitwise_count(apart[counted].view(np.uint64)) <= max_bits]
        forest.add(place[near], place[near + lag])
        lag += 1
    below = np.flatnonzero(forest.root != np.arange(len(values)))
    return values[below], values[forest.root[below]]


def link_batches(batches, max_bits):
    """Over rows sorted by key; a list that reaches into the next batch waits for it."""
    keys = prints = np.empty(0, np.int64)
    for batch in chain(batches, [None]):
        if batch is None:
            ready = len(keys)
        else:
            keys = np.concatenate([keys, batch.column(0).to_numpy(zero_copy_only=False)])
            prints = np.concatenate([prints, batch.column(1).to_numpy(zero_copy_only=False)])
            ready = np.searchsorted(keys, keys[-1]) if len(keys) else 0
        a, b = linked(keys[:ready], prints[:ready], max_bits)
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])
        keys, prints = keys[ready:], prints[ready:]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def masks(max_bits: int) -> list[int]:
    """Which bytes are compared under each key of the index."""
    take = (8 - max_bits + 1) // 2
    return [
        _signed(sum(0xFF << 8 * byte for byte in bytes_))
        for half in (range(4), range(4, 8))
        for bytes_ in combinations(half, take)
    ]


def _ball(members: DataFrame, radius: int) -> DataFrame:
    """(fp, point) for all points within ``radius`` bits of each fingerprint."""
    shell = members.select("fp", F.col("fp").alias("point"), F.lit(-1).alias("last"))
    ball = shell
    for _ in range(radius):
        bit = F.explode(F.sequence(F.col("last") + 1, F.lit(63))).alias("last")
        shell = shell.filter("last < 63").select("fp", "point", bit)
        shell = shell.withColumn("point", F.expr("point ^ shiftleft(1L, last)"))
        ball = ball.unionByName(shell)
    return ball.select("fp", "point")


def links(prints: DataFrame, max_bits: int = MAX_BITS, crowd: int = CROWD) -> DataFrame:
    """Links (a, b) that connect exactly the fingerprints of ``prints`` (column fp, distinct) which ``max_bits`` connect."""
    if not 0 <= max_bits <= 7:
        raise ValueError("max_bits is 0 to 7")
    keys = F.array(*(F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(m))) for i, m in enumerate(masks(max_bits))))
    index = settle(prints.select(F.explode(keys).alias("key"), "fp"), "index")
    crowded = settle(index.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > crowd).select("key"), "crowded")
    lists = index.join(crowded, "key", "left_anti")
    found = (
        lists.repartition("key").sortWithinPartitions("key")
        .mapInArrow(on_worker(link_batches, max_bits=max_bits), "a long, b long")
    )
    members = settle(index.join(crowded, "key", "left_semi").select("fp").distinct(), "members")
    anchors = _ball(members, max_bits // 2).groupBy("point").agg(F.min("fp").alias("anchor"))
    around = _ball(members, max_bits - max_bits // 2).join(anchors, "point").filter("fp != anchor")
    return found.unionByName(around.select(F.col("fp").alias("a"), F.col("anchor").alias("b")))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, width: int = WIDTH, max_bits: int = MAX_BITS, crowd: int = CROWD
) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (hexadecimal), component_id (smallest id reachable over links)."""
    rows = docs.select(col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    marked = settle(rows.mapInArrow(on_worker(fingerprint_batches, width=width), f"doc_id {kind}, fp long"), "fingerprints")
    prints = settle(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "prints")
    roots = components(links(prints.select("fp"), max_bits, crowd))
    placed = settle(
        prints.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root")),
        "placed",
    )
    least = settle(placed.groupBy("root").agg(F.min("first_id").alias("component_id")), "least")
    classes = settle(placed.join(least, "root").select("fp", "component_id"), "classes")
    return marked.join(classes, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
