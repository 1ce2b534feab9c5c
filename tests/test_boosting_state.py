"""Rows of the boosting state: packed, opened and carried from round to round."""

import numpy as np
import pyarrow as pa

from farelens.operators import boosting as G


def _rows(n, seed):
    rng = np.random.default_rng(seed)
    return (rng.integers(0, 3, n), rng.integers(0, 9, (n, 4)).astype(np.uint8),
            rng.normal(size=(n, 3)), rng.normal(size=(n, 3)))


def test_rows_come_back_together_in_order():
    parts = [_rows(n, n) for n in (5, 0, 7)]
    batches = [G._state(*part) for part in parts]
    got = list(G._opened(iter([*batches, batches[2].slice(3, 2)])))
    assert len(got) == 1
    for i, found in enumerate(got[0]):
        want = np.concatenate([parts[0][i], parts[2][i], parts[2][i][3:5]])
        assert np.array_equal(found, want)
    assert pa.types.is_binary(batches[0].schema.field("bins").type)


def test_no_level_goes_through_older_trees_again(spark, monkeypatch):
    """The trees that the rows are scored with are those of one round, never more."""
    seen, rescored = [], G._rescored
    monkeypatch.setattr(G, "_rescored", lambda state, trees, settle: seen.append(
        (len(trees.feature), settle)) or rescored(state, trees, settle))
    rows = [(i % 3, float(i * 7 % 50), float(i % 3) + i * 11 % 13 / 9) for i in range(300)]
    train = spark.createDataFrame(rows, "Cluster int, a double, b double")
    model = G.fit_boosted(train, ["a", "b"], rounds=5, depth=2, keep=2)
    assert seen == [(3, False), (3, True), (3, False), (3, True)]
    often = G.fit_boosted(train, ["a", "b"], rounds=5, depth=2, keep=1)
    assert len(model.feature) == len(often.feature) == 15
    assert np.array_equal(model.feature, often.feature)
    assert not spark.sparkContext._jsc.getPersistentRDDs()


def test_one_of_two_siblings_is_summed(spark, monkeypatch):
    asked, summed = [], G._node_sums
    monkeypatch.setattr(G, "_node_sums", lambda state, feature, cut, nodes, *rest: asked.append(
        list(nodes)) or summed(state, feature, cut, nodes, *rest))
    rng = np.random.default_rng(4)
    rows = [(int(a * 3 + b * 2) % 3, a, b) for a, b in rng.random((300, 2)).tolist()]
    train = spark.createDataFrame(rows, "Cluster int, a double, b double")
    model = G.fit_boosted(train, ["a", "b"], rounds=2, depth=4)
    assert (model.feature != G.LEAF).sum() > 6
    for nodes in asked:
        parents = [(c, (node - 1) // 2) for c, node in nodes if node]
        assert len(set(parents)) == len(parents)
