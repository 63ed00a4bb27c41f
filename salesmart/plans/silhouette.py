"""Euclidean silhouette from the distances of all pairs of rows.

No partner is left out, so the work grows with the square of the rows.  They
are dealt into blocks, and a task takes two blocks: it measures each pair once,
for both of its rows, and sends a row's sums of distances by cluster.  Blocks
are bounded, so a task's memory is too; a row travels once per block.  Distances
come from a product of matrices; the close ones, where its rounding would show,
from differences.  Rows are told apart by a number of their own, so rows with
equal keys or equal vectors each count.

A caller may name a ``sample`` instead: then each row's mean distance to a
larger cluster is taken to that many of its members, those with the smallest
hashes, which are dealt into ``GROUPS``; the spread of the groups' silhouettes
gives the standard error.  Nothing here asks for it.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import sqrt

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.operators.grouping import MOST_DEALT, dealt
from salesmart.workspace import settle

#: Most rows of a block; fewer rows make up to so many blocks, while these have so many rows.
BLOCK = 1 << 16
SPREAD = 16
LEAST = 2048
#: Rows by rows whose distances are held at once, which fit a core's cache.
SIDE = 256
#: Squared distances below this share of the squared lengths are taken from differences.
CLOSE = 1e-4
#: Groups of a sample for the standard error.
GROUPS = 8
#: Stores that a task reads or, against a sample, measures.
TASK = 20_000


@dataclass(frozen=True)
class Silhouette:
    value: float
    standard_error: float
    stores: int
    clusters: int


def _pair_sums(blocks: int, clusters: int, side: int, close: float):
    """Rows of two blocks, or of one -> each row's sums of distances to the rows of the other block, or of its own, by cluster."""

    def read(table, block):
        """Numbers, clusters, a column per cluster of 0 or 1, vectors and their squared lengths, by which rows are ordered."""
        part = table.filter(pa.array(table.column("block").to_numpy() == block))
        number, place = part.column("id").to_numpy(), part.column("place").to_numpy()
        rows = pa.concat_arrays(part.column("v").chunks).flatten().to_numpy().reshape(len(number), -1) if len(number) else np.zeros((0, 1))
        length = (rows * rows).sum(axis=1)
        order = np.argsort(length, kind="stable")
        return number[order], place[order], np.eye(clusters)[place[order]], rows[order], length[order]

    def differences(x, y):
        square = np.zeros((len(x), len(y)))
        for k in range(x.shape[1]):
            square += np.subtract.outer(x[:, k], y[:, k]) ** 2
        return square

    def distances(x, y, x_length, y_length, left, right):
        square = left @ right
        near = square < close * (x_length[-1] + y_length[-1])
        met = np.count_nonzero(near)
        if met > near.size // 8:
            square = differences(x, y)
        elif met:
            i, j = np.nonzero(near)
            square[i, j] = ((x[i] - y[j]) ** 2).sum(axis=1)
        return np.sqrt(square, out=square)

    def run(table):
        low, high = divmod(table.column("pair")[0].as_py(), blocks)
        first = read(table, low)
        second = first if low == high else read(table, high)
        x, x_length, y, y_length = first[3], first[4], second[3], second[4]
        left = np.column_stack([x, x_length, np.ones(len(x))])
        right = np.column_stack([-2 * y, np.ones(len(y)), y_length]).T.copy()
        x_sums, y_sums = np.zeros((len(x), clusters)), np.zeros((len(y), clusters))
        for i in range(0, len(x), side):
            a = slice(i, i + side)
            for j in range(i if low == high else 0, len(y), side):
                b = slice(j, j + side)
                away = distances(x[a], y[b], x_length[a], y_length[b], left[a], right[:, b])
                x_sums[a] += away @ second[2][b]
                # Inside a block, rows that are met by themselves have both directions already.
                if low < high or i < j:
                    y_sums[b] += away.T @ first[2][a]
        if low == high:
            ends = [(first, x_sums + y_sums)]
        else:
            ends = [(first, x_sums), (second, y_sums)]
        return pa.table(
            {"id": np.concatenate([e[0] for e, _ in ends]), "place": np.concatenate([e[1] for e, _ in ends])}
            | {f"s{c}": np.concatenate([sums[:, c] for _, sums in ends]) for c in range(clusters)}
        )

    return run


def _exact(rows: DataFrame, sizes: list[int]) -> tuple[float, int]:
    """Sum of the silhouettes of rows of (id, place, v), and their number; ``sizes`` are those of the clusters."""
    n, clusters = sum(sizes), len(sizes)
    blocks = max(-(-n // BLOCK), min(SPREAD, -(-n // LEAST)))
    block, other = F.col("block"), F.col("other")
    pairs = (
        rows.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks).cast("bigint")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))))
        .select((F.least(block, other) * blocks + F.greatest(block, other)).alias("pair"), "block", "id", "place", "v")
        .repartition(min(blocks * (blocks + 1) // 2, MOST_DEALT), "pair")
    )
    names = [f"s{c}" for c in range(clusters)]
    schema = ", ".join(["id long", "place int", *(f"{s} double" for s in names)])
    sums = pairs.groupBy("pair").applyInArrow(_pair_sums(blocks, clusters, SIDE, CLOSE), schema)
    whole = dealt(sums, n * blocks, "id").groupBy("id", "place").agg(*(F.sum(s).alias(s) for s in names))

    def mean(c: int, own: bool) -> Column:
        """Null for a cluster's only member, which has no other to be measured to."""
        met = sizes[c] - own
        return F.when((F.col("place") == c) == F.lit(own), F.col(names[c]) / met) if met else F.lit(None).cast("double")

    inside = F.coalesce(*(mean(c, True) for c in range(clusters)))
    outside = F.least(*(mean(c, False) for c in range(clusters)))
    largest = F.greatest(inside, outside)
    # Alone in its cluster, or at one place with all others: 0, as it is defined.
    value = F.coalesce(F.when(largest > 0, (outside - inside) / largest), F.lit(0.0))
    total = whole.agg(F.sum(value).alias("value"), F.count(F.lit(1)).alias("n")).first()
    return total.value, total.n


def _measure(points: np.ndarray, keys: np.ndarray, cluster: np.ndarray, group: np.ndarray, sizes: np.ndarray, whole: np.ndarray, groups: int):
    """Rows of (key, cluster, vector) -> count, and sums of silhouettes: all references, then each group of them."""
    block = max(1, (1 << 21) // max(1, points.size))
    k = len(sizes)
    place = cluster * groups + group
    counts = np.bincount(place, minlength=k * groups).reshape(k, groups)
    order = np.argsort(keys, kind="stable")

    def mean(total, n):
        return np.where(n > 0, total / np.maximum(n, 1), np.nan)

    def silhouettes(sums, n, own):
        """From sums of distances to each cluster, numbers of references (both rows x clusters), and own clusters."""
        rows = np.arange(len(own))
        means = mean(sums, n)
        inside = means[rows, own]
        means[rows, own] = np.inf
        outside = np.fmin.reduce(means, axis=1)
        largest = np.maximum(inside, outside)
        with np.errstate(invalid="ignore", divide="ignore"):
            s = np.where(largest > 0, (outside - inside) / largest, 0.0)
        # Alone in its cluster, or no reference for it: 0, as it is defined.
        return np.where((sizes[own] == 1) | np.isnan(inside) | ~np.isfinite(outside), 0.0, s)

    def run(batches):
        n, sums = 0, np.zeros(1 + groups)
        for batch in batches:
            key = batch.column(0).to_numpy(zero_copy_only=False)
            label = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            rows = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(len(key), -1)
            for at in range(0, len(key), block):
                part = slice(at, at + block)
                away = np.sqrt(((rows[part, None, :] - points[None]) ** 2).sum(axis=2))
                own = label[part]
                by = np.zeros((len(own), k * groups))
                for j in np.unique(place):
                    by[:, j] = away[:, place == j].sum(axis=1)
                by = by.reshape(len(own), k, groups)
                met = np.broadcast_to(counts, by.shape).copy()
                # A store is no reference for itself; its distance to itself is 0 and only the number changes.
                found = np.minimum(np.searchsorted(keys[order], key[part]), len(keys) - 1)
                itself = order[found]
                is_there = keys[itself] == key[part]
                met[np.flatnonzero(is_there), own[is_there], group[itself[is_there]]] -= 1
                total, every = by.sum(axis=2), met.sum(axis=2)
                sums[0] += silhouettes(total, every, own).sum()
                for g in range(groups):
                    # A cluster that is there as a whole adds no error, so every group has all of it.
                    sums[1 + g] += silhouettes(np.where(whole, total, by[:, :, g]), np.where(whole, every, met[:, :, g]), own).sum()
                n += len(own)
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([sums.tolist()], pa.list_(pa.float64()))], ["n", "sums"])

    return run


def silhouette(clustered: DataFrame, key: str, vector: str, label: str, *, sample: int | None = None, groups: int = GROUPS) -> Silhouette:
    """Mean silhouette of all rows; exact, unless a ``sample`` is named that some cluster is larger than.

    For a sample ``key`` must tell the rows apart.
    """
    rows = settle(
        clustered.select(F.col(key).cast("string").alias("key"), F.col(label).alias("label"), vector_to_array(F.col(vector)).alias("v"))
        .select(F.monotonically_increasing_id().alias("id"), F.xxhash64("key", F.lit(1)).alias("hash"), "label", "v"),
        "silhouette",
    )
    # A row per cluster.
    sizes = {r.label: r.n for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 2:
        raise ValueError("a silhouette needs two clusters at least")
    names = sorted(sizes)
    rows = rows.coalesce(1 + sum(sizes.values()) // TASK)
    number = {name: k for k, name in enumerate(names)}
    place = F.coalesce(*(F.when(F.col("label") == F.lit(n), F.lit(k)) for n, k in number.items()))
    if sample is None or max(sizes.values()) <= sample:
        total, n = _exact(rows.select("id", place.alias("place"), "v"), [sizes[name] for name in names])
        return Silhouette(total / n, 0.0, n, len(names))
    first = F.row_number().over(Window.partitionBy("label").orderBy("hash"))
    # At most ``sample`` rows of each cluster.
    chosen = rows.withColumn("rank", first).filter(F.col("rank") <= sample).collect()
    measure = _measure(
        np.array([r.v for r in chosen], np.float64), np.array([r.hash for r in chosen], np.int64),
        np.array([number[r.label] for r in chosen], np.int64), np.array([r["rank"] % groups for r in chosen], np.int64),
        np.array([sizes[n] for n in names], np.int64), np.array([sizes[n] <= sample for n in names]), groups,
    )
    sums = rows.select("hash", place.alias("place"), "v").mapInArrow(measure, "n long, sums array<double>")
    totals = sums.agg(F.sum("n").alias("n"), *(F.sum(F.col("sums")[g]).alias(f"s{g}") for g in range(1 + groups))).first()
    values = np.array([totals[f"s{g}"] for g in range(1 + groups)]) / totals.n
    left_out = 1 - len(chosen) / totals.n
    error = float(values[1:].std(ddof=1)) / sqrt(groups) * sqrt(left_out)
    return Silhouette(float(values[0]), error, int(totals.n), len(names))
