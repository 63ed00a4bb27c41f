"""Centroid clustering in exact integers, by equal-average equal-variance search for the nearest centroid.

Vectors become integers, floor(scale * x) per component.  Centroids are kept in
the order of their component sums.  For each vector the search starts where its
own sum belongs and scans outward, nearer sum first.  With k components, sums
S and deviations V = sqrt(k * (sum of squares) - S * S), the squared distance d
of two vectors obeys k * d >= (S - S')^2 + (V - V')^2.  So a centroid is
rejected by both terms, and the first one alone ends the scan, as the sums that
are left only lie further away.  What remains is measured in integers.  The
rejections are computed in floating point, with a margin that keeps them on the
safe side.  Of centroids equally near the smaller number wins.

A vector is kept if it has exactly ``size`` components, none null, not finite
or so large (``largest``) that squared distances would pass 64 bits.  The start
is the ``k`` kept vectors with the smallest SHA-256 of ``<salt>:<id>``; with
fewer vectors there are fewer centroids.  A round assigns all vectors and
replaces each centroid that has some by the floor of their mean; others stay.

Vectors are read once and written as integers; a round is one pass over them in
numpy.  Tasks send one row of exact sums per centroid, so nothing is shuffled
by vector and a cluster with a third of all rows is as cheap as any.  Only
``k`` centroids and their sums come to the driver.

A null id has the digest of ``<salt>:``.  Rows with the same id are vectors of
their own (equal digests are put in the order of their components), and equal
vectors always share a cluster.  An empty table, or one without kept vectors,
gives an empty result.  Very long arrays are not kept unless ``size`` says so.
Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from hashlib import sha256
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.llm.common import col, on_worker
from salesmart.workspace import settle

SIZE = 64
SCALE = 64
CENTROIDS = 16
ROUNDS = 3
SALT = "1"
#: Vectors that are searched together.
BLOCK = 1 << 14


def largest(size: int) -> int:
    """Components below it in magnitude give squared distances that fit 64 bits; 2^27 for 64 components."""
    return isqrt((1 << 62) // size) // 2


# ---- search --------------------------------------------------------------------------------


class Nearest:
    """Centroids (numbered rows of integers) in the order of their sums."""

    def __init__(self, centroids: np.ndarray):
        centroids = np.asarray(centroids, np.int64)
        sums = centroids.sum(axis=1)
        self.numbers = np.argsort(sums, kind="stable")
        self.rows, self.sums = centroids[self.numbers], sums[self.numbers]
        self.size = centroids.shape[1]
        self.deviations = self._deviations(self.rows, self.sums)
        #: Distances measured and centroids met, to see what the rejections save.
        self.measured = self.met = 0

    def _deviations(self, rows: np.ndarray, sums: np.ndarray) -> np.ndarray:
        exact = rows.astype(np.float64)
        centred = exact - sums[:, None] / self.size
        return np.sqrt(self.size * np.einsum("ij,ij->i", centred, centred))

    def search(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest centroid of each vector and its squared distance."""
        vectors = np.asarray(vectors, np.int64)
        n, k = len(vectors), len(self.sums)
        sums = vectors.sum(axis=1)
        deviations = self._deviations(vectors, sums)
        best, number = np.full(n, np.iinfo(np.int64).max), np.full(n, k)
        high = np.searchsorted(self.sums, sums)
        low = high - 1
        active = np.arange(n)
        while len(active):
            below, above, own = low[active], high[active], sums[active]
            down = np.where(below >= 0, own - self.sums[np.maximum(below, 0)], np.inf)
            up = np.where(above < k, self.sums[np.minimum(above, k - 1)] - own, np.inf)
            goes_down = down <= up
            at, gap = np.where(goes_down, below, above), np.minimum(down, up)
            # Rounding never rejects a centroid: these terms are made a little smaller.
            limit = np.where(number[active] == k, np.inf, self.size * best[active].astype(np.float64)) + self.size
            inside = np.isfinite(gap) & (gap * gap * (1 - 1e-9) <= limit)  # else all that is left is as far or further
            active, at, gap, goes_down, limit = active[inside], at[inside], gap[inside], goes_down[inside], limit[inside]
            low[active[goes_down]] -= 1
            high[active[~goes_down]] += 1
            self.met += len(active)
            near = (gap**2 + (deviations[active] - self.deviations[at]) ** 2) * (1 - 1e-9) <= limit
            rows, at = active[near], at[near]
            self.measured += len(rows)
            difference = vectors[rows] - self.rows[at]
            distance = np.einsum("ij,ij->i", difference, difference)
            named = self.numbers[at]
            wins = (distance < best[rows]) | ((distance == best[rows]) & (named < number[rows]))
            best[rows[wins]], number[rows[wins]] = distance[wins], named[wins]
        return number, best


# ---- passes --------------------------------------------------------------------------------


def _blocks(column, size: int):
    """Integer rows of a list column without nulls, some at a time."""
    for first in range(0, len(column), BLOCK):
        part = column.slice(first, BLOCK)
        yield first, part.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, size)


def sum_batches(batches, centroids):
    """One row per centroid that has vectors here: number, how many, sums by component."""
    nearest = Nearest(centroids)
    k, size = centroids.shape
    counts, sums = np.zeros(k, np.int64), np.zeros((k, size), np.int64)
    for batch in batches:
        for _, rows in _blocks(batch.column(0), size):
            number, _ = nearest.search(rows)
            order = np.argsort(number, kind="stable")
            starts = np.searchsorted(number[order], np.arange(k + 1))
            for c in np.flatnonzero(np.diff(starts)):
                sums[c] += rows[order[starts[c] : starts[c + 1]]].sum(axis=0)
            counts += np.diff(starts)
    met = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays(
        [pa.array(met.astype(np.int32)), pa.array(counts[met]), pa.array(list(sums[met]), pa.list_(pa.int64()))], ["cluster", "n", "sums"]
    )


def assign_batches(batches, centroids):
    """id, vector -> id, number of the nearest centroid, squared distance."""
    nearest = Nearest(centroids)
    for batch in batches:
        for first, rows in _blocks(batch.column(1), centroids.shape[1]):
            number, distance = nearest.search(rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(first, len(rows)), pa.array(number.astype(np.int32)), pa.array(distance)], ["vec_id", "cluster", "distance"]
            )


# ---- all vectors ---------------------------------------------------------------------------


def integers(vectors: DataFrame, id_col: str, vector_col: str, size: int, scale: int) -> DataFrame:
    """vec_id, v of the kept vectors, written once."""
    raw = F.col("raw")
    good = F.forall(raw, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double") * scale) < largest(size) - 1))
    return settle(
        vectors.select(col(id_col).alias("vec_id"), col(vector_col).cast("array<double>").alias("raw"))
        .filter(raw.isNotNull() & (F.size(raw) == size) & good)
        .select("vec_id", F.transform(raw, lambda x: F.floor(x * scale).cast("int")).alias("v")),
        "integers",
    )


def first_centroids(kept: DataFrame, k: int, salt: str) -> np.ndarray:
    """The ``k`` vectors with the smallest digests; a limit after an order takes ``k`` rows of each task."""
    named = F.concat(F.lit(f"{salt}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    rows = kept.select(F.sha2(named, 256).alias("digest"), "v").orderBy("digest", "v").limit(k).collect()
    return np.array([r.v for r in rows], np.int64)


def moved(kept: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round."""
    sums = kept.select("v").mapInArrow(on_worker(sum_batches, centroids=centroids), "cluster int, n long, sums array<long>")
    wide = T.DecimalType(38, 0)  # sums of all vectors may pass 64 bits
    totals = (
        sums.select("cluster", "n", F.posexplode("sums").alias("place", "s")).groupBy("cluster", "place")
        .agg(F.sum("n").alias("n"), F.sum(F.col("s").cast(wide)).cast(wide).alias("s")).collect()
    )
    out = centroids.copy()
    for r in totals:
        out[r.cluster, r.place] = int(r.s) // r.n
    return out


def digest(centroid) -> str:
    return sha256(",".join(str(int(x)) for x in centroid).encode()).hexdigest()


def fit(kept: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, salt: str = SALT) -> np.ndarray:
    """Centroids of written integer vectors (``integers``) after some rounds."""
    centroids = first_centroids(kept, k, salt)
    for _ in range(rounds if len(centroids) else 0):
        centroids = moved(kept, centroids)
    return centroids


def assign(kept: DataFrame, centroids: np.ndarray) -> DataFrame:
    """vec_id, cluster, distance of written integer vectors."""
    kind = kept.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, cluster int, distance long"
    if not len(centroids):
        return kept.sparkSession.createDataFrame([], schema)
    return kept.mapInArrow(on_worker(assign_batches, centroids=centroids), schema)


def cluster(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", *, size: int = SIZE, scale: int = SCALE,
    k: int = CENTROIDS, rounds: int = ROUNDS, salt: str = SALT,
) -> DataFrame:
    """One row per kept vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256."""
    kept = integers(vectors, id_col, vector_col, size, scale)
    centroids = fit(kept, k, rounds, salt)
    found = settle(assign(kept, centroids), "assigned")
    sums = {r.cluster: int(r.s) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    rows = [(c, s, sum(sums.values()), digest(centroids[c])) for c, s in sums.items()]  # one row per centroid
    about = vectors.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(about), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
