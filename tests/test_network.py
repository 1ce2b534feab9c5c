"""The dense network against plain gradients, and its independence of partitions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from farelens.operators import network as N


def rows(spark, n=600):
    rng = np.random.default_rng(2)
    a, b = rng.normal(5, 2, n), rng.integers(0, 2, n).astype(float)
    y = 100 + 30 * np.sin(a) + 20 * b + rng.normal(0, 1, n)
    return spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(zip(a, b, y))],
                                 "id long, a double, b double, y double")


def test_gradients_are_those_of_the_squared_error():
    rng = np.random.default_rng(1)
    layers = [rng.normal(0, 0.5, s) for s in ((4, 5), (6, 4), (5, 1))]
    layers = [np.rint(x * 64) / 64 for x in layers]
    x, y = np.rint(rng.normal(0, 1, (7, 3)) * 16) / 16, rng.normal(0, 1, 7)
    model = N.Network(list("abc"), np.zeros(4), np.ones(4), layers)

    def loss(flat):
        parts, at = [], 0
        for old in layers:
            parts.append(flat[at:at + old.size].reshape(old.shape))
            at += old.size
        h = x
        for i, w in enumerate(parts):
            h = np.column_stack([h, np.ones(len(h))]) @ w
            h = np.maximum(h, 0) if i < 2 else h
        return 0.5 * ((h[:, 0] - y) ** 2).sum()

    flat = np.concatenate([w.ravel() for w in layers])
    slope = [(loss(flat + e) - loss(flat - e)) / 2e-6 for e in np.eye(len(flat)) * 1e-6]
    got = model.gradients(x, y) / (N.ACTIVE * N.ERROR)
    np.testing.assert_allclose(got, slope, atol=0.03)


def test_any_partitioning_gives_the_same_weights_and_they_reload(spark, tmp_path):
    df = rows(spark)
    how = dict(hidden=(8, 4), epochs=2, batches=2)
    one = N.fit_network(df.coalesce(1), ["a", "b"], "y", ["id"], **how)
    many = N.fit_network(df.repartition(5, "y"), ["a", "b"], "y", ["id"], **how)
    assert all(np.array_equal(p, q) for p, q in zip(one.layers, many.layers))
    one.save(spark, str(tmp_path / "n"))
    again = N.Network.load(spark, str(tmp_path / "n"))
    assert sorted(again.transform(df, ["id"], "p").collect()) == sorted(
        one.transform(df, ["id"], "p").collect())


def test_a_bent_surface_is_learned(spark):
    df = rows(spark)
    model = N.fit_network(df, ["a", "b"], "y", ["id"], hidden=(32, 16), epochs=30, batches=2,
                          rate=0.02)
    off = model.transform(df, ["id", "y"], "p").agg(F.avg(F.abs(F.col("y") - F.col("p")))).first()[0]
    flat = df.agg(F.avg(F.abs(F.col("y") - 110))).first()[0]
    assert off < flat / 2


def test_no_rows_are_refused(spark):
    with pytest.raises(ValueError, match="no rows"):
        N.fit_network(rows(spark).where("false"), ["a"], "y", ["id"])
