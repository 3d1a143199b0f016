"""Clusters of integer vectors around centroids, most of which are ruled out in rotated coordinates.

The vectors' moments, summed by all tasks, give a rotation to the axes along which they vary most. Every
vector is kept with its first rotated coordinates and the length of the rest. For a vector and a centroid, the squared
distance of the first coordinates plus the squared difference of the two rests is never above the
squared distance. So only centroids whose bound, less a margin for rounding, is within the exact distance to the
most promising one can be nearest; these are compared in integers. The rotation thus decides how much is
ruled out, never the result.

A round moves a partial sum per task, cluster and component; vectors stay where they lie. The centroids, a number
that a parameter gives, are all that the driver holds.

Vectors of another length than asked for, null ones and those with a null or non-finite component are left out.
Rows that repeat an id or a vector are rows of their own. Rows without an id are clustered and never start a centroid. With
fewer vectors than centroids there are as many centroids as vectors with an id; with none there are no rows. Components
beyond 2 ** 27 (for 64) count as that. Only the named columns are read, so no other column can clash.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veriledger.llm.frames import quoted, stored
from veriledger.llm.vectors import integers, lists, matrix

DIMENSIONS = 64
SCALE = 64
CENTROIDS = 16
ROUNDS = 3

#: Rotated coordinates that are kept with a vector.
LEADING = 16

#: Part of the squared lengths that rounding to 32-bit numbers may add to a bound, ten times over.
MARGIN = 1e-5


class Rotation(NamedTuple):
    """The vectors' mean and the axes, as columns, of the leading coordinates."""

    mean: np.ndarray
    axes: np.ndarray

    def of(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Leading coordinates, length of the rest and squared length of each vector less the mean."""
        centred = vectors - self.mean
        leading = centred @ self.axes
        squares = np.einsum("ij,ij->i", centred, centred)
        rest = np.sqrt(np.maximum(squares - np.einsum("ij,ij->i", leading, leading), 0))
        return leading.astype(np.float32), rest.astype(np.float32), squares


def _quantised(batches, dimensions: int, scale: int):
    """The keys and vectors of each batch's usable rows."""
    for batch in batches:
        usable, lengths, values = integers(batch.column(1), scale)
        usable &= lengths == dimensions
        yield batch.column(0).filter(pa.array(usable)), values[np.repeat(usable, lengths)].reshape(-1, dimensions)


def rotation(slim: DataFrame, dimensions: int, scale: int, leading: int) -> Rotation | None:
    """The axes of most variance of all usable vectors; none if there are none."""

    def sums(batches):
        total = np.zeros((dimensions + 1, dimensions + 1))
        for _, vectors in _quantised(batches, dimensions, scale):
            extended = np.hstack([vectors, np.ones((len(vectors), 1))])
            total += extended.T @ extended
        if total[-1, -1]:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.reshape(-1))],
                                             names=["cell", "value"])

    # (dimensions + 1) ** 2 rows whatever the table's size
    cells = slim.mapInArrow(sums, "cell long, value double").groupBy("cell").agg(F.sum("value").alias("value")).collect()
    if not cells:
        return None
    total = np.zeros((dimensions + 1) ** 2)
    for r in cells:
        total[r["cell"]] = r["value"]
    total = total.reshape(dimensions + 1, dimensions + 1)
    mean = total[-1, :-1] / total[-1, -1]
    _, axes = np.linalg.eigh(total[:-1, :-1] / total[-1, -1] - np.outer(mean, mean))
    return Rotation(mean, np.ascontiguousarray(axes[:, ::-1][:, :leading]))


class Nearest:
    """The nearest of some centroids; ties go to the smaller number."""

    def __init__(self, centroids: np.ndarray, turned: Rotation):
        self.centroids = centroids
        self.leading, self.rest, self.squares = turned.of(centroids)

    def bounds(self, leading: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each vector and centroid a number below the squared distance but for rounding, and the margin
        that covers rounding."""
        leading, rest = leading.astype(np.float64), rest.astype(np.float64)
        own, theirs = self.leading.astype(np.float64), self.rest.astype(np.float64)
        lengths = np.einsum("ij,ij->i", leading, leading)
        near = (lengths[:, None] + np.einsum("ij,ij->i", own, own) - 2 * leading @ own.T
                + (rest[:, None] - theirs) ** 2)
        return near, MARGIN * ((lengths + rest ** 2)[:, None] + self.squares + 1)

    def of(self, vectors: np.ndarray, leading: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each vector's cluster and squared distance."""
        near, margin = self.bounds(leading, rest)
        cluster = near.argmin(1)
        distance = ((vectors - self.centroids[cluster]) ** 2).sum(1)
        survives = near - margin <= distance[:, None]
        survives[np.arange(len(vectors)), cluster] = False
        for number, centroid in enumerate(self.centroids):
            rows = np.flatnonzero(survives[:, number])
            if len(rows):
                exact = ((vectors[rows] - centroid) ** 2).sum(1)
                closer = (exact < distance[rows]) | (exact == distance[rows]) & (number < cluster[rows])
                cluster[rows[closer]], distance[rows[closer]] = number, exact[closer]
        return cluster, distance


def _columns(batch: pa.RecordBatch, dimensions: int, leading: int):
    return (matrix(batch.column(1), dimensions).astype(np.int64), matrix(batch.column(2), leading),
            batch.column(3).to_numpy(zero_copy_only=False))


def rotated(slim: DataFrame, turned: Rotation, dimensions: int, scale: int) -> DataFrame:
    """`key`, `vector`, `leading` and `rest` of the usable rows, stored."""

    def run(batches):
        for keys, vectors in _quantised(batches, dimensions, scale):
            leading, rest, _ = turned.of(vectors)
            yield pa.RecordBatch.from_arrays(
                [keys, lists(vectors, pa.int32()), lists(leading, pa.float32()), pa.array(rest)],
                names=["key", "vector", "leading", "rest"])

    schema = T.StructType([slim.schema["key"], T.StructField("vector", T.ArrayType(T.IntegerType())),
                           T.StructField("leading", T.ArrayType(T.FloatType())), T.StructField("rest", T.FloatType())])
    return stored(slim.mapInArrow(run, schema), "rotated")


def moved(rows: DataFrame, nearest: Nearest, dimensions: int, leading: int) -> np.ndarray:
    """The centroids after a round: the floor of each cluster's mean; empty clusters keep theirs."""
    centroids = nearest.centroids

    def sums(batches):
        total = np.zeros((len(centroids), dimensions), np.int64)
        count = np.zeros(len(centroids), np.int64)
        for batch in batches:
            vectors, first, rest = _columns(batch, dimensions, leading)
            cluster, _ = nearest.of(vectors, first, rest)
            by = np.argsort(cluster, kind="stable")
            starts = np.flatnonzero(np.diff(cluster[by], prepend=-1))
            if len(by):
                total[cluster[by][starts]] += np.add.reduceat(vectors[by], starts)
            count += np.bincount(cluster, minlength=len(centroids))
        filled = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(filled, dimensions)), pa.array(np.tile(np.arange(dimensions), len(filled))),
             pa.array(total[filled].reshape(-1)), pa.array(np.repeat(count[filled], dimensions))],
            names=["cluster", "component", "total", "rows"])

    whole = (rows.mapInArrow(sums, "cluster long, component long, total long, rows long")
             .groupBy("cluster", "component")
             .agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("rows").alias("rows")))
    centroids = centroids.copy()
    for r in whole.collect():  # a number per centroid and component
        centroids[r["cluster"], r["component"]] = int(r["total"]) // r["rows"]
    return centroids


def clusters(df: DataFrame, key: str = "vec_id", column: str = "embedding", dimensions: int = DIMENSIONS, scale: int = SCALE,
             count: int = CENTROIDS, rounds: int = ROUNDS, seed: str = "1:", leading: int = LEADING) -> DataFrame:
    """Per usable vector its `key`, `cluster`, squared `distance`, `cluster_inertia`, `inertia` (null if beyond a
    long) and `centroid_sha256`.

    The first centroids are the vectors with the smallest SHA-256 of the seed and their id, equal ones in the
    order of their components.
    """
    slim = df.select(quoted(key).alias("key"), quoted(column).alias("vector"))
    leading = min(leading, dimensions)
    turned = rotation(slim, dimensions, scale, leading)
    if turned is None:
        return slim.limit(0).selectExpr(
            "key", "0 cluster", "0L distance", "0L cluster_inertia", "0L inertia", "'' centroid_sha256")
    rows = rotated(slim, turned, dimensions, scale)
    first = (rows.filter("key is not null")
             .select(F.sha2(F.concat(F.lit(seed), F.col("key").cast("string")), 256).alias("hash"), "vector")
             .orderBy("hash", "vector").limit(count).collect())
    if not first:
        return rows.limit(0).selectExpr(
            "key", "0 cluster", "0L distance", "0L cluster_inertia", "0L inertia", "'' centroid_sha256")
    centroids = np.array([r["vector"] for r in first], np.int64)
    for _ in range(rounds):
        centroids = moved(rows, Nearest(centroids, turned), dimensions, leading)
    nearest = Nearest(centroids, turned)

    def assigned(batches):
        for batch in batches:
            cluster, distance = nearest.of(*_columns(batch, dimensions, leading))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cluster, pa.int32()), pa.array(distance)],
                                             names=["key", "cluster", "distance"])

    schema = T.StructType([rows.schema["key"], T.StructField("cluster", T.IntegerType()),
                           T.StructField("distance", T.LongType())])
    placed = stored(rows.mapInArrow(assigned, schema), "clusters")
    totals = {r["cluster"]: int(r["total"]) for r in placed.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}  # a row per centroid

    def fits(total: int) -> int | None:
        return total if total < 1 << 63 else None

    facts = df.sparkSession.createDataFrame(
        [(c, fits(t), fits(sum(totals.values())), digest(centroids[c])) for c, t in totals.items()],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    # As many rows as centroids.
    return placed.join(F.broadcast(facts), "cluster").select(
        "key", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()
