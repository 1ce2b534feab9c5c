"""A dense network for regression, trained on rows that stay where they are.

In every round the tasks read one batch of the rows, which is a partition of a stored table, and
add up their gradients; Spark sums the tasks' sums, and the driver moves the weights (Adam) and
sends them out again.  What travels is one number per weight and task, whatever the number of
rows.  Inputs, weights, activations and errors are rounded to whole multiples of a power of two
before they are multiplied, so that all sums are exact and the fitted weights do not depend on
how the rows are partitioned.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from farelens.session import scratch_path

# Units of activations, weights and errors, and the largest activation and error.  Sums over
# 2^34 rows stay below 2^63.
ACTIVE, WEIGHT, ERROR = 2.0 ** 8, 2.0 ** 16, 2.0 ** 12
MOST_ACTIVE, MOST_ERROR = 64.0, 8.0


def _whole(x: np.ndarray, unit: float, most: float | None = None) -> np.ndarray:
    """``x`` in whole units, kept within ``most``."""
    return np.rint((x if most is None else np.clip(x, -most, most)) * unit)


@dataclass
class Network:
    """Weights (a row per input and one for the constant) of dense layers with rectifiers."""

    inputs: list[str]
    means: np.ndarray
    spreads: np.ndarray
    layers: list[np.ndarray]

    def _forward(self, x: np.ndarray) -> list[np.ndarray]:
        """Activations in whole units of every layer, the input first, the constant behind."""
        found = [np.column_stack([_whole(x, ACTIVE, MOST_ACTIVE), np.full(len(x), ACTIVE)])]
        for i, layer in enumerate(self.layers):
            raw = found[-1] @ _whole(layer, WEIGHT) / (WEIGHT * ACTIVE)
            if i + 1 == len(self.layers):
                return [*found, raw]
            active = _whole(np.maximum(raw, 0.0), ACTIVE, MOST_ACTIVE)
            found.append(np.column_stack([active, np.full(len(x), ACTIVE)]))
        return found

    def gradients(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Gradient of half the squared error summed over rows, in whole units, all layers in
        one vector."""
        active = self._forward(x)
        error = _whole(active[-1] - y[:, None], ERROR, MOST_ERROR)
        parts = []
        for i in range(len(self.layers) - 1, -1, -1):
            parts.append((active[i].T @ error).ravel())
            if i:
                back = error @ _whole(self.layers[i][:-1], WEIGHT).T / (WEIGHT * ERROR)
                error = _whole(back * (active[i][:, :-1] > 0), ERROR, MOST_ERROR)
        return np.concatenate(parts[::-1])

    def scaled(self, x: np.ndarray) -> np.ndarray:
        return (x - self.means[:-1]) / self.spreads[:-1]

    def transform(self, df: DataFrame, ids: Sequence[str], out: str) -> DataFrame:
        """``ids`` and the value that the network gives; unknown inputs count as 0."""
        kept = df.select(*ids, F.array(*_numbers(self.inputs)).alias("__x"))
        model, place = self, len(ids)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = batch.column(place).flatten().to_numpy().reshape(batch.num_rows, -1)
                y = model._forward(model.scaled(x))[-1][:, 0] * model.spreads[-1] + model.means[-1]
                yield pa.RecordBatch.from_arrays([*batch.columns[:place], pa.array(y)],
                                                 names=[*ids, out])

        types = ", ".join(f"`{c}` {kept.schema[c].dataType.simpleString()}" for c in ids)
        return kept.mapInArrow(run, f"{types}, `{out}` double")

    def save(self, spark: SparkSession, path: str) -> None:
        rows = [("inputs", self.inputs, [], [])] + [
            (name, [], list(x.shape), x.ravel().tolist()) for name, x in (
                ("means", self.means), ("spreads", self.spreads),
                *((f"layer{i}", x) for i, x in enumerate(self.layers)))]
        spark.createDataFrame(rows, "name string, texts array<string>, shape array<int>, "
                                    "numbers array<double>").coalesce(1).write.mode(
            "overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Network:
        found = {r.name: r for r in spark.read.parquet(path).collect()}
        arrays = {n: np.array(r.numbers).reshape(r.shape) for n, r in found.items() if r.shape}
        layers = [arrays[f"layer{i}"] for i in range(len(arrays) - 2)]
        return cls(list(found["inputs"].texts), arrays["means"], arrays["spreads"], layers)


def _numbers(names: Sequence[str]) -> list[Column]:
    return [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in names]


def fit_network(train: DataFrame, inputs: Sequence[str], target: str, row_id: Sequence[str],
                hidden: Sequence[int] = (128, 64), epochs: int = 8, batches: int = 16,
                rate: float = 0.01, seed: int = 42) -> Network:
    """Weights of least squared error after ``epochs`` passes over ``batches`` hash batches.

    Inputs and target are taken less their means, in deviations.  Rows without a target are
    left out.
    """
    spark, inputs = train.sparkSession, list(inputs)
    rows = train.where(F.col(target).isNotNull()).select(
        F.array(*_numbers(inputs)).alias("x"), F.col(target).cast("double").alias("y"),
        F.pmod(F.xxhash64(*row_id), F.lit(batches)).cast("int").alias("batch"))
    path = scratch_path(spark, "network-rows")
    rows.hint("rebalance", "batch").write.partitionBy("batch").parquet(path)
    rows = spark.read.schema("x array<double>, y double, batch int").parquet(path)
    means, spreads = _moments(rows, len(inputs))
    rng = np.random.default_rng(seed)
    sizes = [len(inputs), *hidden, 1]
    layers = [np.vstack([rng.normal(0, np.sqrt(2 / a), (a, b)), np.zeros((1, b))])
              for a, b in zip(sizes, sizes[1:])]
    model = Network(inputs, means, spreads, layers)
    shapes = [x.shape for x in layers]
    weights = np.concatenate([x.ravel() for x in layers])
    first, second = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, epochs * batches + 1):
        total, n = _summed(rows.where(F.col("batch") == step % batches), model)
        if not n:
            continue
        gradient = total / (n * ACTIVE * ERROR)
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient ** 2
        # The step shrinks along a half wave, so that the last batches do not pull it about.
        now = rate * 0.5 * (1 + np.cos(np.pi * (step - 1) / (epochs * batches)))
        weights = weights - now * (first / (1 - 0.9 ** step)) / (
            np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
        ends = np.cumsum([0, *(a * b for a, b in shapes)])
        model = Network(inputs, means, spreads, [
            weights[i:j].reshape(s) for i, j, s in zip(ends, ends[1:], shapes)])
    return model


def _moments(rows: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of the inputs and the target; a constant has deviation 1.

    Amounts are summed as decimals, so that the order of the rows does not matter.
    """
    columns = [F.col("x")[i] for i in range(width)] + [F.col("y")]
    exact = [c.cast("decimal(24, 6)") for c in columns]
    row = rows.agg(F.count(F.lit(1)), *[F.sum(c) for c in exact],
                   *[F.sum((c * c).cast("decimal(38, 6)")) for c in exact]).first()
    n = row[0]
    if not n:
        raise ValueError("there are no rows to fit")
    means = np.array([float(v) / n for v in row[1:width + 2]])
    squares = np.array([float(v) / n for v in row[width + 2:]])
    spreads = np.sqrt(np.maximum(squares - means ** 2, 0.0))
    return means, np.where(spreads > 1e-9, spreads, 1.0)


def _summed(rows: DataFrame, model: Network) -> tuple[np.ndarray, int]:
    """Summed gradients of some rows, and how many rows there are."""
    size = sum(x.size for x in model.layers)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(size, np.int64), 0
        for batch in batches:
            if batch.num_rows:
                x = batch.column(0).flatten().to_numpy().reshape(batch.num_rows, -1)
                y = (batch.column(1).to_numpy() - model.means[-1]) / model.spreads[-1]
                total += model.gradients(model.scaled(x), y).astype(np.int64)
                n += batch.num_rows
        if n:
            yield pa.RecordBatch.from_arrays([
                pa.array(np.arange(size + 1), pa.int32()),
                pa.array(np.append(total, n), pa.int64())], names=["i", "g"])

    sums = rows.select("x", "y").mapInArrow(run, "i int, g long").groupBy("i").agg(
        F.sum("g").alias("g")).toArrow()
    found = np.zeros(size + 1, np.int64)
    found[sums["i"].to_numpy()] = sums["g"].to_numpy()
    return found[:-1].astype(np.float64), int(found[-1])
