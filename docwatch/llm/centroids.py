"""Centroid clustering of vectors, with equal-average equal-variance search.

Components become integers ``floor(scale * x)``, and everything after is exact.
Centroids are sorted by the sum of their components (their mean, times the
dimension). A vector starts at its own sum and scans outward, the nearer side
first; with ``s`` the sum, ``v`` the root of ``d * sum(x * x) - s * s`` (the
deviation, times the dimension) and ``best`` the squared distance found so far:

* ``(s_x - s_c) ** 2 > d * best`` ends the scan, as every centroid further out is
  further away still;
* ``(s_x - s_c) ** 2 + (v_x - v_c) ** 2 > d * best`` rejects one centroid;
* for the rest the distance is summed in integers, and the smaller number wins ties.

A task works on its own vectors and keeps sums per centroid only: a round shuffles
at most ``k * d`` numbers per task, and the centroids, the same bounded size, are
all that comes to the driver. Vectors are never grouped, so a vector that a third of
all rows hold costs what any other does.

Defined cases: a vector that is null, has another number of components, or a null or
non-finite component is left out; with fewer vectors than ``k`` each is a centroid;
an empty centroid stays where it is; a null ``vec_id`` comes last in the start;
repeated rows are vectors of their own; an empty table gives an empty one; a
component beyond ``limit(d)`` can't be summed exactly and raises; other columns
aren't read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docwatch.session import materialize


@dataclass(frozen=True)
class Clustering:
    """``dimension`` components are kept as ``floor(scale * x)``."""

    dimension: int = 64
    scale: int = 64
    k: int = 16
    rounds: int = 3
    seed: str = "1"


def limit(dimension: int) -> int:
    """The largest component whose bounds and distances stay within 64-bit integers."""
    return (1 << 30) // max(dimension, 1)


def integer_vectors(vectors: DataFrame, how: Clustering = Clustering()) -> DataFrame:
    """``vec_id, v``: the vectors that count, as integers; ``vectors`` is ``vec_id, embedding``."""
    whole = F.col("embedding")
    odd = F.exists(whole, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    kept = vectors.select("vec_id", "embedding").filter((F.size(whole) == how.dimension) & ~F.coalesce(odd, F.lit(True)))
    most = float(limit(how.dimension))
    far = F.exists(whole, lambda x: F.abs(F.floor(x.cast("double") * how.scale)) > most)
    checked = F.when(far, F.raise_error(F.lit(f"a component times {how.scale} exceeds {int(most)}"))).otherwise(whole)
    return kept.select("vec_id", F.transform(checked, lambda x: F.floor(x.cast("double") * how.scale).cast("int")).alias("v"))


def first_centroids(points: DataFrame, how: Clustering = Clustering()) -> np.ndarray:
    """The vectors whose ids have the lowest digests, in that order; ``k`` rows at most come to the driver."""
    digest = F.sha2(F.concat(F.lit(f"{how.seed}:"), F.col("vec_id").cast("string")), 256)
    lowest = points.select(digest.alias("h"), "v").orderBy(F.col("h").asc_nulls_last(), "v").limit(how.k).collect()
    return np.array([r.v for r in lowest], dtype=np.int64).reshape(len(lowest), how.dimension)


class Searcher:
    """Nearest centroids of many vectors at once."""

    def __init__(self, centroids: np.ndarray) -> None:
        self.d = centroids.shape[1]
        sums = centroids.sum(axis=1)
        self.number = np.argsort(sums, kind="stable")
        self.sums = sums[self.number]
        self.rows = centroids[self.number]
        self.spread = _spread(self.rows, self.sums)
        #: How many distances were summed, of how many there are.
        self.summed, self.possible = 0, 0

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of each vector's nearest centroid, and the squared distance."""
        n, k = len(vectors), len(self.rows)
        sums = vectors.sum(axis=1)
        spread = _spread(vectors, sums)
        up = np.searchsorted(self.sums, sums)
        down = up - 1
        best = np.full(n, np.iinfo(np.int64).max)
        label = np.full(n, k)
        active = np.arange(n)
        edge = np.iinfo(np.int64).max
        self.possible += n * k
        for _ in range(k):
            if not len(active):
                break
            above, below = up[active], down[active]
            mine = sums[active]
            gap_up = np.where(above < k, np.abs(self.sums[np.minimum(above, k - 1)] - mine), edge)
            gap_down = np.where(below >= 0, np.abs(self.sums[np.maximum(below, 0)] - mine), edge)
            rising = gap_up <= gap_down
            at = np.where(rising, above, below)
            gap = np.where(rising, gap_up, gap_down)
            known = best[active]
            reach = np.where(known < edge, known, 0) * self.d
            open_ = (known == edge) | (gap * gap <= reach)
            active, at, gap, rising, known, reach = (x[open_] for x in (active, at, gap, rising, known, reach))
            up[active] += rising
            down[active] -= ~rising
            # rounded down, so that a root's rounding never rejects
            wide = np.abs(spread[active] - self.spread[at])
            wide = np.maximum(wide - 1e-12 * (spread[active] + self.spread[at] + 1), 0.0)
            near = (known == edge) | (gap.astype(float) ** 2 * (1 - 1e-12) + wide**2 * (1 - 1e-12) <= reach)
            rows, at = active[near], at[near]
            self.summed += len(rows)
            apart = vectors[rows] - self.rows[at]
            found = np.einsum("ij,ij->i", apart, apart)
            name = self.number[at]
            better = (found < best[rows]) | ((found == best[rows]) & (name < label[rows]))
            best[rows[better]] = found[better]
            label[rows[better]] = name[better]
        return label, best


def _spread(rows: np.ndarray, sums: np.ndarray) -> np.ndarray:
    squares = np.einsum("ij,ij->i", rows, rows)
    return np.sqrt((rows.shape[1] * squares - sums * sums).astype(float))


def _matrix(batch: pa.RecordBatch, dimension: int) -> np.ndarray:
    return batch["v"].flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dimension)


def moved(points: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: floors of their vectors' means, empty ones as they were."""
    k, d = centroids.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Searcher(centroids)
        total, count = np.zeros((k, d), dtype=np.int64), np.zeros(k, dtype=np.int64)
        for batch in batches:
            vectors = _matrix(batch, d)
            label, _ = search.nearest(vectors)
            np.add.at(total, label, vectors)
            count += np.bincount(label, minlength=k)
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(used, d + 1).astype(np.int32)),
                pa.array(np.tile(np.arange(d + 1), len(used)).astype(np.int32)),
                pa.array(np.column_stack([total, count])[used].ravel()),
            ],
            names=["cluster", "component", "total"],
        )

    parts = points.select("v").mapInArrow(sums, "cluster int, component int, total long")
    rows = parts.groupBy("cluster", "component").agg(F.sum("total").alias("total")).collect()
    table = np.zeros((k, d + 1), dtype=object)
    for r in rows:
        table[r.cluster, r.component] = r.total
    return np.array(
        [[int(t) // row[d] for t in row[:d]] if row[d] else old.tolist() for row, old in zip(table, centroids)], dtype=np.int64
    ).reshape(k, d)


def train(points: DataFrame, how: Clustering = Clustering()) -> np.ndarray:
    """The centroids after all rounds; ``points`` as :func:`integer_vectors` gives them, written."""
    centroids = first_centroids(points, how)
    for _ in range(how.rounds if len(centroids) else 0):
        centroids = moved(points, centroids)
    return centroids


def assign(points: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``vec_id, cluster, distance`` of every vector."""
    id_type = points.schema["vec_id"].dataType.simpleString()
    k, d = centroids.shape

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Searcher(centroids)
        for batch in batches if k else ():
            found, distance = search.nearest(_matrix(batch, d))
            yield pa.RecordBatch.from_arrays(
                [batch["vec_id"], pa.array(found.astype(np.int32)), pa.array(distance)], names=["vec_id", "cluster", "distance"]
            )

    return points.mapInArrow(label, f"vec_id {id_type}, cluster int, distance long")


def digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def cluster_vectors(vectors: DataFrame, how: Clustering = Clustering()) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every vector that counts."""
    points = materialize(integer_vectors(vectors, how), "vectors")
    centroids = train(points, how)
    placed = materialize(assign(points, centroids), "placed")
    inertia = {r.cluster: r.n for r in placed.groupBy("cluster").agg(F.sum("distance").alias("n")).collect()}
    whole = sum(inertia.values())
    rows = [(c, inertia[c], whole, digest(centroids[c])) for c in sorted(inertia)]
    schema = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    # at most k rows
    about = F.broadcast(vectors.sparkSession.createDataFrame(rows, schema))
    return placed.join(about, "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
