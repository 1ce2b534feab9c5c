"""Silhouette with Euclidean distances, without comparing all pairs of points.

The points are grouped into a bounded number of small cells once.  In a clustering, every part
of a cell that lies in one cluster is replaced by its mean, weighted by its points, and the
distances from a point to all points of a cluster by those to these means.  By the triangle
inequality a mean distance is then off by no more than the cluster's mean distance between a
point and its stand-in, which is measured.  This gives a value and a bound of its error; with
as many cells as different points the value is exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, functions as F

from farelens.session import materialise


def with_cells(points: DataFrame, vector: str = "__x", cells: int = 256,
               seed: int = 42) -> DataFrame:
    """Points with a ``cell``, at most ``cells`` of them; computed once for all clusterings."""
    model = KMeans(k=cells, seed=seed, maxIter=5, featuresCol=vector, predictionCol="cell").fit(points)
    return materialise(model.transform(points))


def _score(near: np.ndarray, far: np.ndarray) -> np.ndarray:
    """Silhouette from the mean distances to the own and the nearest other cluster."""
    most = np.maximum(near, far)
    return np.where(most > 0, (far - near) / np.where(most > 0, most, 1.0), 0.0)


def silhouette(points: DataFrame, vector: str = "__x",
               cluster: str = "Cluster") -> tuple[float, float]:
    """Mean silhouette of points ``with_cells`` and clusters, and a bound of its error.

    A point that is alone in its cluster counts 0.  There must be two clusters at least.
    """
    rows = points.select(F.col(cluster).cast("int").alias("c"), F.col("cell").cast("int").alias(
        "cell"), F.col(vector).alias("v"))
    parts = sorted(rows.groupBy("c", "cell").agg(
        F.count(F.lit(1)).alias("n"), Summarizer.mean(F.col("v")).alias("m")).collect(),
        key=lambda r: (r.c, r.cell))
    names = sorted({r.c for r in parts})
    if len(names) < 2:
        raise ValueError("a silhouette needs two clusters")
    place = {(r.c, r.cell): i for i, r in enumerate(parts)}
    means = np.array([r.m.toArray() for r in parts])
    weights = np.zeros((len(parts), len(names)))
    for i, r in enumerate(parts):
        weights[i, names.index(r.c)] = r.n
    sizes = weights.sum(axis=0)
    plain = rows.select("c", "cell", vector_to_array("v").alias("v"))

    def opened(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        c, cell = (batch.column(i).to_numpy() for i in (0, 1))
        part = np.array([place[key] for key in zip(c.tolist(), cell.tolist())])
        values = batch.column(2).flatten().to_numpy().reshape(len(c), -1)
        return np.searchsorted(names, c), part, values

    def moved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(names))
        for batch in batches:
            if batch.num_rows:
                own, part, values = opened(batch)
                np.add.at(total, own, np.linalg.norm(values - means[part], axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(range(len(names)), pa.int32()),
                                          pa.array(total)], names=["i", "d"])

    found = plain.mapInArrow(moved, "i int, d double").groupBy("i").agg(F.sum("d").alias("d"))
    slack = np.zeros(len(names))
    for r in found.collect():
        slack[r.i] = r.d

    def rated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(3)
        for batch in batches:
            if not batch.num_rows:
                continue
            own, _, values = opened(batch)
            squares = (values ** 2).sum(axis=1)[:, None] + (means ** 2).sum(axis=1)
            apart = np.sqrt(np.maximum(squares - 2 * values @ means.T, 0.0))
            sums, at = apart @ weights, np.arange(len(own))
            others = np.maximum(sizes[own] - 1, 1)
            near, blur = sums[at, own] / others, slack[own] / others
            mean, spread = sums / sizes, slack / sizes
            mean[at, own] = np.inf
            scores = [_score(near, mean.min(axis=1)),
                      _score(near + blur, np.maximum((mean - spread).min(axis=1), 0.0)),
                      _score(np.maximum(near - blur, 0.0), (mean + spread).min(axis=1))]
            total += [s[sizes[own] > 1].sum() for s in scores]
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in total], names=["s", "low", "high"])

    sums = plain.mapInArrow(rated, "s double, low double, high double").agg(
        F.sum("s"), F.sum("low"), F.sum("high")).first()
    value, low, high = (x / sizes.sum() for x in sums)
    return float(value), float(max(value - low, high - value, 0.0))
