"""Boosted classes against a plain loop over rows and values."""

import numpy as np
import pytest

from farelens.operators import boosting as G


def plain_fit(x, y, rounds, depth, rate=0.3, l2=1.0, least=1.0):
    """Scores after boosting, every value tried as a cut, recursively and without bins."""
    scores = np.zeros((len(x), y.max() + 1))
    for _ in range(rounds):
        g, h = (v / G.UNIT for v in G.gradients(scores, y))
        step = np.zeros_like(scores)

        def grow(rows, c, level):
            a, b = g[rows, c].sum(), h[rows, c].sum()
            best = (1e-9, None)
            for f in range(x.shape[1]) if level < depth else ():
                for value in np.unique(x[rows, f])[:-1]:
                    left = rows[x[rows, f] <= value]
                    la, lb = g[left, c].sum(), h[left, c].sum()
                    if lb < least or b - lb < least:
                        continue
                    gain = (la ** 2 / (lb + l2) + (a - la) ** 2 / (b - lb + l2) - a ** 2 / (b + l2))
                    if gain > best[0] + 1e-12:
                        best = gain, (f, value)
            if best[1] is None:
                step[rows, c] = -rate * a / (b + l2)
                return
            f, value = best[1]
            grow(rows[x[rows, f] <= value], c, level + 1)
            grow(rows[x[rows, f] > value], c, level + 1)

        for c in range(scores.shape[1]):
            grow(np.arange(len(x)), c, 0)
        scores += step
    return scores


def data(seed=3, n=150):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.integers(0, 12, n), rng.normal(size=n).round(1), rng.integers(0, 2, n),
                         np.full(n, 7.0)])
    y = ((x[:, 0] > 5).astype(int) + 2 * ((x[:, 1] > 0) & (x[:, 2] > 0))).clip(0, 2)
    flip = rng.random(n) < 0.15
    return x, np.where(flip, rng.integers(0, 3, n), y)


def frame(spark, x, y):
    return spark.createDataFrame(
        [(i, *map(float, r), int(c) * 10) for i, (r, c) in enumerate(zip(x, y))],
        "id int, a double, b double, c double, d double, Cluster int")


@pytest.mark.parametrize("rounds, depth, keep", [(5, 3, 2), (1, 1, 10)])
def test_matches_the_plain_loop(spark, rounds, depth, keep):
    x, y = data()
    df = frame(spark, x, y)
    model = G.fit_boosted(df, list("abcd"), rounds=rounds, depth=depth, bins=64, keep=keep)
    assert model.classes == [0, 10, 20] and len(model.feature) == 3 * rounds
    want = plain_fit(x, y, rounds, depth)
    np.testing.assert_allclose(model.scores(x), want, atol=1e-6)
    got = {r.id: r.pred for r in model.transform(df, ["id"]).collect()}
    assert [got[i] for i in range(len(x))] == (np.argmax(want, axis=1) * 10).tolist()


def test_any_partitioning_gives_the_same_model_and_it_reloads(spark, tmp_path):
    x, y = data(4, 400)
    df = frame(spark, x, y)
    one = G.fit_boosted(df.coalesce(1), list("abcd"), rounds=4, depth=3, bins=8)
    many = G.fit_boosted(df.repartition(7, "a"), list("abcd"), rounds=4, depth=3, bins=8, keep=1)
    for name in ("feature", "cut", "weight"):
        assert np.array_equal(getattr(one, name), getattr(many, name))
    one.save(spark, str(tmp_path / "m"))
    again = G.BoostedClasses.load(spark, str(tmp_path / "m"))
    assert again.classes == one.classes and again.features == one.features
    assert np.array_equal(again.scores(x), one.scores(x))


def test_ends_early_and_handles_unknown_values(spark):
    rows = [(i, None if i % 2 else 5.0, None if i == 0 else i % 2) for i in range(40)]
    df = spark.createDataFrame(rows, "id int, a double, Cluster int")
    model = G.fit_boosted(df, ["a"], rounds=100, depth=2)
    assert len(model.feature) < 200
    got = {r.id: r.pred for r in model.transform(df, ["id"]).collect()}
    assert all(got[i] == i % 2 for i in range(40))


def test_a_single_class_is_refused(spark):
    with pytest.raises(ValueError, match="two classes"):
        G.fit_boosted(spark.createDataFrame([(1.0, 3)], "a double, Cluster int"), ["a"])
