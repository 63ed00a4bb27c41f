"""K-means from many starts at once.

All starts are seeded (k-means++) and moved together, so an iteration is one
pass over the vectors and not one job per start.  Vectors are whole multiples
of 1/SCALE: sums of them are exact, whatever the order, and so centres, costs
and the choice of the best start do not depend on the partitions.  Per pass a
task sends one row per start and centre; vectors stay where they are.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.workspace import settle

#: Steps of one unit; a z-score of 1,000 and ten million rows a task still sum up in 64 bits.
SCALE = 1 << 24
#: Rows that are looked at together, and rows of a task.
BLOCK = 4096
TASK = 250_000
#: Up to so many tasks may send their row per start and centre straight to the driver; those of more are added up first.
FEW = 64


@dataclass(frozen=True)
class Centres:
    """The best start's centres and the sum of squared distances to them."""

    points: np.ndarray
    cost: float

    def assign(self, df: DataFrame, columns: list[str], out: str) -> DataFrame:
        """Number of the nearest centre, the first of equals, from the columns that the vector was made of."""
        distances = [sum(((F.col(c) - F.lit(float(x))) ** 2 for c, x in zip(columns, p, strict=True)), F.lit(0.0)) for p in self.points]
        nearest = F.least(*distances) if len(distances) > 1 else distances[0]
        number: Column = F.coalesce(*(F.when(d == nearest, F.lit(k)) for k, d in enumerate(distances)))
        return df.withColumn(out, number.cast("bigint"))


def _reader(size: int = BLOCK):
    """Reads batches of (key, vector), some rows at a time.

    It and the passes are closures, which travel by value: workers need not find this module.
    """

    def blocks(batches):
        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            rows = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(len(keys), -1)
            for at in range(0, len(keys), size):
                yield keys[at : at + size], rows[at : at + size]

    return blocks


def _seed_pass(chosen: np.ndarray, seed: int, scale: int, blocks: Callable):
    """For each start the next centre: a row drawn with a chance in proportion to its squared distance to those it has.

    Each row draws a time from its key; with a rate of its weight the first to
    arrive is a weighted draw, and the first of all tasks is the first of each.
    """
    starts, have = chosen.shape[:2]

    def run(batches):
        least: list = [None] * starts
        for keys, rows in blocks(batches):
            for s in range(starts):
                mixed = keys ^ np.uint64((seed * 1_000_003 + s * 8191 + have * 127 + 1) * 0x9E3779B97F4A7C15 % 2**64)
                for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
                    mixed = (mixed ^ (mixed >> np.uint64(shift))) * np.uint64(factor)
                mixed ^= mixed >> np.uint64(31)
                time = -np.log(((mixed >> np.uint64(11)).astype(np.float64) + 0.5) / 2**53)
                if have:
                    away = ((rows[:, None, :] - chosen[s][None]) / scale) ** 2
                    weight = away.sum(axis=2).min(axis=1)
                    time = np.where(weight > 0, time / np.maximum(weight, 1e-300), np.inf)
                first = int(np.lexsort((keys, time))[0])
                found = (float(time[first]), int(keys[first].view(np.int64)), rows[first].tolist())
                if least[s] is None or found[:2] < least[s][:2]:
                    least[s] = found
        met = [(s, *f) for s, f in enumerate(least) if f]
        yield pa.RecordBatch.from_arrays(
            [pa.array([m[k] for m in met], t) for k, t in enumerate((pa.int32(), pa.float64(), pa.int64(), pa.list_(pa.int64())))],
            ["start", "time", "key", "v"],
        )

    return run


def _move_pass(points: np.ndarray, scale: int, blocks: Callable):
    """Per start and centre: how many rows are nearest to it, their sums, and their squared distances in 2^-20."""
    starts, k, size = points.shape

    def run(batches):
        n, cost, sums = np.zeros((starts, k), np.int64), np.zeros((starts, k), np.int64), np.zeros((starts, k, size), np.int64)
        for _, rows in blocks(batches):
            exact = rows / scale
            for s in range(starts):
                away = ((exact[:, None, :] - points[s][None]) ** 2).sum(axis=2)
                own = away.argmin(axis=1)
                near = np.rint(away[np.arange(len(own)), own] * 2**20).astype(np.int64)
                n[s] += np.bincount(own, minlength=k)
                np.add.at(cost[s], own, near)
                np.add.at(sums[s], own, rows)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(np.arange(starts, dtype=np.int32), k)), pa.array(np.tile(np.arange(k, dtype=np.int32), starts)),
                pa.array(n.ravel()), pa.array(cost.ravel()), pa.array(sums.reshape(-1, size).tolist(), pa.list_(pa.int64())),
            ],
            ["start", "centre", "n", "cost", "sums"],
        )

    return run


def _seeded(rows: DataFrame, few: bool, k: int, starts: int, seed: int) -> np.ndarray:
    """starts x k x size centres in whole steps."""
    chosen = np.zeros((starts, 0, 0), np.int64)
    for have in range(k):
        met = rows.mapInArrow(_seed_pass(chosen, seed, SCALE, _reader()), "start int, time double, key long, v array<long>")
        if not few:
            met = met.groupBy("start").agg(F.min_by(F.struct(*met.columns), F.struct("time", "key")).alias("m")).select("m.*")
        first: dict[int, tuple] = {}
        for r in met.collect():
            first[r.start] = min(first.get(r.start, (r.time, r.key, r.v)), (r.time, r.key, r.v))
        points = np.array([first[s][2] for s in range(starts)], np.int64)[:, None, :]
        chosen = points if have == 0 else np.concatenate([chosen, points], axis=1)
    return chosen


def _moved(rows: DataFrame, few: bool, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """New centres of some starts, and the cost of the old ones."""
    sums = rows.mapInArrow(_move_pass(points, SCALE, _reader()), "start int, centre int, n long, cost long, sums array<long>")
    if not few:
        wide = T.DecimalType(38, 0)
        every = [F.sum(F.col("sums")[k].cast(wide)).alias(f"s{k}") for k in range(points.shape[2])]
        added = sums.groupBy("start", "centre").agg(F.sum("n").alias("n"), F.sum(F.col("cost").cast(wide)).alias("cost"), *every)
        sums = added.select("start", "centre", "n", "cost", F.array(*(f"s{k}" for k in range(points.shape[2]))).alias("sums"))
    n, cost = np.zeros(points.shape[:2], object), np.zeros(len(points), object)
    total = np.zeros(points.shape, object)  # whole numbers of any size
    for r in sums.collect():
        n[r.start, r.centre] += r.n
        cost[r.start] += int(r.cost)
        total[r.start, r.centre] += np.array([int(x) for x in r.sums], object)
    moved = points.copy()
    for s, c in zip(*np.nonzero(n), strict=True):
        moved[s, c] = [int(x) / int(n[s, c]) / SCALE for x in total[s, c]]
    return moved, np.array([int(c) / 2**20 for c in cost])


def best_of_starts(z: DataFrame, key: str, vector: str, k: int, starts: int, seed: int, rounds: int = 300) -> Centres:
    """The centres of the start with the lowest cost, the first of equals."""
    steps = F.transform(vector_to_array(F.col(vector)), lambda x: F.rint(x * SCALE).cast("bigint"))
    rows = settle(z.select(F.xxhash64(key).alias("key"), steps.alias("v")), "steps")
    # A pass over few rows is all overhead, so they share tasks.
    tasks = 1 + rows.count() // TASK
    rows, few = rows.coalesce(tasks), tasks <= FEW
    points = _seeded(rows, few, k, starts, seed) / SCALE
    open_, costs = np.arange(starts), np.zeros(starts)
    for _ in range(rounds):
        # Starts whose centres stand still are done and leave the pass.
        moved, costs[open_] = _moved(rows, few, points[open_])
        still = (moved == points[open_]).all(axis=(1, 2))
        points[open_] = moved
        open_ = open_[~still]
        if not len(open_):
            break
    best = int(costs.argmin())
    return Centres(points[best], float(costs[best]))
