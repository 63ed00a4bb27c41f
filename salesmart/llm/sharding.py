"""Sharding by best-fit-decreasing bin packing of indivisible groups.

Rows with equal texts are one group and stay together.  Groups of at least
1/``FINE`` of an even shard are packed one by one.  Smaller ones are gathered
into parcels by their hash, and a parcel is indivisible too.  Parcels come in
``LEVELS`` sizes, each about half of the one before, so that big ones set the
fill and small ones even it out.  Groups and parcels together are at most
``shards x FINE + PARCELS x LEVELS`` items, whatever the input, so one task
packs them and their places may be broadcast.

Items by decreasing size enter the bin with the tightest room that still takes
them, found in a balanced tree of bins by room.  With a ``capacity`` this gives
few shards.  With a number of ``shards``, each group above the even share of
what is left gets a shard of its own, as it cannot be split; for the others the
smallest capacity that needs no more than the other shards is sought, which
makes their sizes nearly equal.  Shards stay empty only where there are fewer
groups than shards.

Null text has no bytes and is grouped with empty text.  Repeated rows are rows
of one group.  An empty table gives an empty result.  Other columns, whatever
their names, are ignored.
"""

from __future__ import annotations

import random

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import col, on_worker, running, spread_for, text_of
from salesmart.workspace import settle

SHARDS = 16
FINE = 256
PARCELS = 128
LEVELS = 6
#: Relative precision of the capacity that is sought.
PRECISION = 1e-4


class Rooms:
    """A balanced search tree (treap) of (room, bin)."""

    def __init__(self, seed: int = 3):
        self.root, self.random = None, random.Random(seed)

    def add(self, key: tuple[int, int]) -> None:
        low, high = self._split(self.root, key)
        self.root = self._join(self._join(low, [key, self.random.random(), None, None]), high)

    def tightest(self, size: int) -> tuple[int, int] | None:
        """The smallest room of at least ``size``, taken out of the tree."""
        node, best = self.root, None
        while node:
            if node[0] >= (size, -1):
                best, node = node[0], node[2]
            else:
                node = node[3]
        if best is not None:
            low, rest = self._split(self.root, best)
            _, high = self._split(rest, (best[0], best[1] + 1))
            self.root = self._join(low, high)
        return best

    def _split(self, node, key):
        """Nodes below ``key``, and the others."""
        if node is None:
            return None, None
        if node[0] < key:
            node[3], high = self._split(node[3], key)
            return node, high
        low, node[2] = self._split(node[2], key)
        return low, node

    def _join(self, low, high):
        if low is None or high is None:
            return low or high
        if low[1] > high[1]:
            low[3] = self._join(low[3], high)
            return low
        high[2] = self._join(low, high[2])
        return high


def best_fit_decreasing(sizes: list[int], capacity: int) -> list[int]:
    """The bin of each item; an item above the capacity gets a bin of its own."""
    rooms, place, bins = Rooms(), [0] * len(sizes), 0
    for item in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        found = rooms.tightest(sizes[item])
        if found is None:
            found, bins = (capacity, bins), bins + 1
        place[item] = found[1]
        if found[0] > sizes[item]:
            rooms.add((found[0] - sizes[item], found[1]))
    return place


def above_even(sizes: list[int], total: int, shards: int) -> tuple[int, int]:
    """How many of ``sizes`` (decreasing) exceed the even share of what is left, and the total without them."""
    own = 0
    while own < min(len(sizes), shards - 1) and sizes[own] * (shards - own) > total:
        total, own = total - sizes[own], own + 1
    return own, total


def fewest_bytes(sizes: list[int], shards: int, precision: float = PRECISION) -> list[int]:
    """Groups above the even share of what is left get a bin each; the others share the other bins evenly."""
    order = sorted(range(len(sizes)), key=lambda i: (-sizes[i], i))
    own, _ = above_even([sizes[i] for i in order[:shards]], sum(sizes), shards)
    place = [0] * len(sizes)
    for number, i in enumerate(order[:own]):
        place[i] = number
    rest = order[own:]
    for i, b in zip(rest, smallest_capacity([sizes[i] for i in rest], shards - own, precision), strict=True):
        place[i] = own + b
    return place


def smallest_capacity(sizes: list[int], shards: int, precision: float = PRECISION) -> list[int]:
    """Best fit with the smallest capacity found that needs at most ``shards`` bins; with enough items no bin is empty."""
    low = max([-(-sum(sizes) // shards), *sizes])
    high, step = low, max(1, int(low * precision))
    best = best_fit_decreasing(sizes, high)
    while max(best, default=0) >= shards:  # double the slack until it fits
        low, high = high + 1, high + step
        step *= 2
        best = best_fit_decreasing(sizes, high)
    while high - low > max(1, int(high * precision)):
        middle = (low + high) // 2
        place = best_fit_decreasing(sizes, middle)
        if max(place, default=0) < shards:
            best, high = place, middle
        else:
            low = middle + 1
    return all_used(sizes, best, shards)


def all_used(sizes: list[int], place: list[int], shards: int) -> list[int]:
    """Halve the fullest bin of several items for each empty one, which few and coarse items may leave."""
    held = [[] for _ in range(shards)]
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        held[place[i]].append(i)
    for empty in (b for b in range(shards) if not held[b]):
        full = max((b for b in range(shards) if len(held[b]) > 1), key=lambda b: sum(sizes[i] for i in held[b]), default=None)
        if full is None:
            break
        halves, fill = ([], []), [0, 0]
        for i in held[full]:
            side = int(fill[1] < fill[0])
            halves[side].append(i)
            fill[side] += sizes[i]
        held[full], held[empty] = halves
    place = place.copy()
    for b, items in enumerate(held):
        for i in items:
            place[i] = b
    return place


def place_items(items, shards, capacity):
    """The shard of each item of one packer, whose number fills the upper bits."""
    items = items.sort_values("item", ignore_index=True)
    sizes = items["size"].tolist()
    places = best_fit_decreasing(sizes, capacity) if capacity else fewest_bytes(sizes, shards)
    return pd.DataFrame({"item": items["item"], "shard": items["packer"] * (1 << 20) + places})


def shard(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, shards: int = SHARDS, capacity: int | None = None
) -> DataFrame:
    """One row per row of ``docs``: doc_id, size (bytes and one), text_crc32, shard, slot (gapless from 0 in its shard)."""
    text = text_of(text_col)
    rows = settle(
        docs.select(
            col(id_col).alias("doc_id"), (F.octet_length(text) + 1).cast("bigint").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"), F.sha2(text, 256).alias("text_key"),
        ),
        "rows",
    )
    groups = settle(rows.groupBy("text_key").agg(F.sum("size").alias("group_size")), "groups")
    total = groups.agg(F.sum("group_size")).first()[0] or 0
    even = capacity
    if not capacity:
        largest = groups.select("group_size").orderBy(F.desc("group_size")).limit(shards)  # at most so many get a shard of their own
        alone, rest = above_even([r[0] for r in largest.collect()], total, shards)
        even = max(1, rest // (shards - alone))
    own = F.col("group_size") * FINE >= F.lit(even)
    # A parcel's level is the number of leading zeros of a hash: each level gets half of what is left.
    chance = F.pmod(F.xxhash64(F.lit("level"), F.col("text_key")), F.lit(1 << 30)) + 1
    level = F.least(F.floor(F.lit(30) - F.log2(chance)), F.lit(LEVELS - 1))
    parcel = F.concat_ws("-", level.cast("string"), F.pmod(F.xxhash64("text_key"), F.lit(PARCELS)).cast("string"))
    packers = -(-total // (even * SHARDS)) if capacity else 1
    packer = F.pmod(F.xxhash64(F.lit("packer"), F.col("text_key")), F.lit(max(1, packers)))
    parcel = F.concat_ws("-", packer.cast("string"), parcel)
    named = groups.select("text_key", "group_size", packer.alias("packer"), F.when(own, F.col("text_key")).otherwise(parcel).alias("item"))
    items = named.groupBy("item", "packer").agg(F.sum("group_size").alias("size"))
    places = settle(
        items.groupBy("packer").applyInPandas(on_worker(place_items, shards=shards, capacity=capacity), "item string, shard long"), "places"
    )
    placed = settle(named.join(places, "item").select("text_key", F.col("shard").cast("bigint" if capacity else "int").alias("shard")), "placed")
    dealt = settle(rows.join(placed, "text_key").drop("text_key"), "dealt")
    return running(dealt, ["shard"], ["doc_id", "text_crc32", "size"], {"slot": F.lit(1)}, spread_for(dealt.count() // shards))
