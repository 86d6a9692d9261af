"""Centroid clustering in exact integers: Lloyd's rounds, centroids filtered by N-simplex projection.

A few of the first centroids are pivots. Each vector's exact squared distances to them are taken once and kept as the
apex of a simplex over the pivots: its coordinates in their hyperplane, and its height above it. The apexes of a vector
and a centroid give a lower and an upper Euclidean bound of their distance; a centroid whose lower bound lies above
another's upper bound, or above an exact distance already known, is out. All others are compared in exact integers. The
bounds are widened by what rounding can do to them, so that no nearest centroid and no tie is lost.

A round sends one row of sums per cluster and task; the driver holds the centroids alone.

Defined cases: vectors that are null, of another number of components, or with a null or non-finite one take no part, nor
do those with a component of limit(dim) / scale or more (2**27 / 256 as set here), whose distances might not fit 64 bits;
an inertia that does not fit is null; equal vectors are all clustered, each row for itself; rows that repeat an id start several centroids if their hash
is among the least, in the order of their components; a null id is hashed as an empty text; fewer vectors than centroids
give as many centroids; an empty table gives no rows; other columns, whatever their names, are not used.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow, written

CENTROIDS, ROUNDS, DIMENSIONS, SCALE, SEED = 40, 5, 64, 256, 2
PIVOTS = 40
#: A pivot stands at least this share of the farthest above the hyperplane of those before it.
LEAST_HEIGHT = 1e-3
#: Pairs of vector and centroid that are compared at once.
PAIRS = 16384


def limit(dim: int) -> float:
    """The integers that are clustered lie below this: as many squares of twice as much fit 62 bits."""
    return 2**30 / math.sqrt(max(dim, 1))


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of a and b, side by side."""
    return ((a.astype(np.int64) - b) ** 2).sum(-1)


class Simplex:
    """The simplex of the pivots, and apexes over it."""

    def __init__(self, points: np.ndarray, most: int):
        gaps = squared(points[:, None], points[None, :])
        gram = (gaps[0][:, None] + gaps[0][None, :] - gaps) / 2
        height, chosen, rows = np.diag(gram).astype(float), [0], []
        least = LEAST_HEIGHT**2 * max(float(gaps.max()), 1.0)
        while len(chosen) < min(most, len(points)) and height.max() > least:
            i = int(height.argmax())
            before = np.array(rows).reshape(len(rows), len(points))
            own = (gram[i] - before.T @ before[:, i]) / np.sqrt(height[i])
            rows.append(own)
            height = np.maximum(height - own**2, 0)
            height[[*chosen, i]] = 0
            chosen.append(i)
        self.pivots = points[chosen]
        self.from_first = gaps[0][chosen[1:]].astype(float)
        base = np.array(rows).reshape(len(rows), len(points))[:, chosen[1:]].T
        self.inverse = np.linalg.inv(base) if rows else np.zeros((0, 0))
        self.widest, self.spread = float(gaps.max()), float(np.linalg.norm(self.inverse)) if rows else 0.0

    def rounding(self, far: np.ndarray) -> np.ndarray:
        """How far rounding can move a product of apexes of points as far as this (squared) from the first pivot."""
        size = np.maximum(far, self.widest)
        return 256 * np.finfo(float).eps * (len(self.pivots) + 1) * size * (1 + np.sqrt(size) * self.spread)

    def apexes(self, x: np.ndarray) -> np.ndarray:
        """Of each row of integers: the squared distance to the first pivot, coordinates and height; rounded up, the last."""
        gaps = np.stack([squared(x, p) for p in self.pivots], 1).astype(float)
        first = gaps[:, 0]
        place = ((first[:, None] + self.from_first - gaps[:, 1:]) / 2) @ self.inverse.T
        height = np.sqrt(np.maximum(first - (place**2).sum(1), 0) + self.rounding(first))
        return np.column_stack([first, place, height])

    def bounds(self, own: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of the squared distances of two sets of apexes."""
        flat = own[:, :1] + others[:, 0] - 2 * own[:, 1:-1] @ others[:, 1:-1].T
        up = 2 * own[:, -1:] * others[:, -1]
        slack = self.rounding(np.maximum(own[:, :1], others[:, 0]))
        return flat - up - slack, flat + up + slack


def nearest(simplex: Simplex, x: np.ndarray, apexes: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The nearest centroid of each row, the exact squared distance, and the number of pairs that were compared exactly."""
    low, high = simplex.bounds(apexes, simplex.apexes(centroids))
    first = high.argmin(1)
    known = squared(x, centroids[first])
    open_ = low <= np.minimum(high.min(1), known.astype(float) * (1 + 1e-12))[:, None]
    open_[np.arange(len(x)), first] = False
    row, col = np.nonzero(open_)
    exact = np.full(low.shape, np.iinfo(np.int64).max)
    exact[np.arange(len(x)), first] = known
    for at in range(0, len(row), PAIRS):
        r, c = row[at : at + PAIRS], col[at : at + PAIRS]
        exact[r, c] = squared(x[r], centroids[c])
    best = exact.argmin(1)
    return best, exact[np.arange(len(x)), best], len(row) + len(x)


def placed(simplex: Simplex, scale: int) -> Callable:
    """Of each vector its integers and its apex."""
    kind = pa.struct([("ints", pa.binary()), ("apex", pa.binary())])

    def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for vectors in parts:
            x = vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), -1)
            x = np.floor(scale * x).astype(np.int32)
            apex = simplex.apexes(x)
            yield pa.array([{"ints": a.tobytes(), "apex": b.tobytes()} for a, b in zip(x, apex, strict=True)], kind)

    return run


def assigned(simplex: Simplex, centroids: np.ndarray, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    x = np.frombuffer(b"".join(batch["ints"].to_pylist()), np.int32).reshape(len(batch), -1)
    apexes = np.frombuffer(b"".join(batch["apex"].to_pylist()), float).reshape(len(batch), -1)
    return x, *nearest(simplex, x, apexes, centroids)[:2]


def sums(simplex: Simplex, centroids: np.ndarray) -> Callable:
    """A task's vectors and sums of components per cluster."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = np.zeros(len(centroids), np.int64), np.zeros(centroids.shape, np.int64)
        for batch in batches:
            if len(batch):
                x, cluster, _ = assigned(simplex, centroids, batch)
                order = np.argsort(cluster, kind="stable")
                met, at = np.unique(cluster[order], return_index=True)
                n += np.bincount(cluster, minlength=len(centroids))
                total[met] += np.add.reduceat(x[order].astype(np.int64), at, axis=0)
        met = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(met.astype(np.int32)), pa.array(n[met]), pa.array(total[met].tolist(), pa.list_(pa.int64()))], ["cluster", "n", "total"])

    return run


def distances(simplex: Simplex, centroids: np.ndarray) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                _, cluster, gap = assigned(simplex, centroids, batch)
                yield pa.RecordBatch.from_arrays([batch["id"], pa.array(cluster.astype(np.int32)), pa.array(gap)], ["id", "cluster", "distance"])

    return run


def moved(vectors: DataFrame, simplex: Simplex, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round. Sums meet in two steps, so that no task adds up one cluster's rows of all tasks."""
    each = vectors.select("ints", "apex").mapInArrow(sums(simplex, centroids), "cluster int, n bigint, total array<bigint>")
    dims = range(centroids.shape[1])
    each = each.select("cluster", "n", *(F.col("total")[i].alias(f"t{i}") for i in dims))
    added = [F.sum(c).alias(c) for c in ("n", *(f"t{i}" for i in dims))]
    salted = each.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(64))).groupBy("cluster", "salt").agg(*added)
    out = centroids.copy()
    for r in salted.groupBy("cluster").agg(*added).collect():
        out[r["cluster"]] = [r[f"t{i}"] // r["n"] for i in dims]
    return out


def kept_vectors(vectors: DataFrame, *, id_col: str, vector_col: str, dim: int, scale: int) -> DataFrame:
    x = F.col(vector_col).cast("array<double>")
    fits = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < limit(dim) / scale))
    return vectors.select(F.col(id_col).alias("id"), x.alias("x")).filter((F.size("x") == dim) & fits)


def cluster(
    vectors: DataFrame, *, k: int = CENTROIDS, rounds: int = ROUNDS, dim: int = DIMENSIONS, scale: int = SCALE, seed: int = SEED,
    pivots: int = PIVOTS, id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """id, cluster, distance, cluster_inertia, inertia, centroid, centroid_sha256: one row per vector that takes part."""
    kept = kept_vectors(vectors, id_col=id_col, vector_col=vector_col, dim=dim, scale=scale)
    ints = F.transform("x", lambda c: F.floor(c * float(scale)).cast("bigint"))
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    first = kept.select(name.alias("name"), ints.alias("ints")).orderBy("name", "ints").limit(k).collect()
    centroids = np.array([r["ints"] for r in first], np.int64).reshape(len(first), dim)
    schema = f"id {kept.schema['id'].dataType.simpleString()}, cluster int, distance bigint"
    if not first:
        none = kept.filter(F.lit(False)).select("id", F.lit(0).alias("cluster"), F.lit(0).cast("bigint").alias("distance"))
        return none.withColumns({"cluster_inertia": F.col("distance"), "inertia": F.col("distance"), "centroid": F.array(F.col("distance")), "centroid_sha256": F.lit("")})
    simplex = Simplex(centroids, pivots)
    cached = written(kept.select("id", arrow(placed(simplex, scale), "struct<ints:binary,apex:binary>")("x").alias("p")).select("id", "p.*"))
    for _ in range(rounds):
        centroids = moved(cached, simplex, centroids)
    near = written(cached.mapInArrow(distances(simplex, centroids), schema))
    per = near.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("all")).collect()
    per = {r["cluster"]: int(r["all"]) for r in per}
    fits = lambda n: n if n < 1 << 63 else None
    told = [
        (i, fits(per.get(i, 0)), fits(sum(per.values())), c, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest())
        for i, c in enumerate(centroids.tolist())
    ]
    columns = "cluster int, cluster_inertia bigint, inertia bigint, centroid array<bigint>, centroid_sha256 string"
    small = F.broadcast(vectors.sparkSession.createDataFrame(told, columns))  # a row per centroid
    return near.join(small, "cluster").select("id", "cluster", "distance", *small.columns[1:])
