"""The boosting state in blocks, and sums over the combined bins of features."""

import numpy as np
import pytest

from farelens.operators import boosting as G


def _train(spark, n=30000):
    return spark.range(n).selectExpr(
        "CAST(id % 3 AS INT) AS Cluster", "CAST(id * 7 % 50 AS DOUBLE) AS a",
        "id % 3 + id * 11 % 13 / 9D AS b", "CAST(id % 2 AS DOUBLE) AS c")


def test_rows_come_back_from_blocks(monkeypatch):
    monkeypatch.setattr(G, "BLOCK_BYTES", 300)
    rng = np.random.default_rng(1)
    part = (rng.integers(0, 3, 50), rng.integers(0, 9, (50, 4)).astype(np.uint8),
            rng.normal(size=(50, 3)), rng.normal(size=(50, 3)))
    blocks = list(G._blocks(*part))
    assert 5 < len(blocks) < 50
    [found] = G._unblocked(iter(blocks))
    for got, want in zip(found, part):
        assert np.array_equal(got, want)


def test_a_level_passes_few_rows_to_python_evenly(spark, monkeypatch):
    seen, summed = [], G._node_sums
    monkeypatch.setattr(G, "_node_sums", lambda state, *rest: seen.append(
        [len(x) for x in state.rdd.glom().collect()]) or summed(state, *rest))
    G.fit_boosted(_train(spark), ["a", "b", "c"], rounds=3, depth=2, keep=2)
    for sizes in seen:
        assert len(sizes) == 4 and sum(sizes) < 100


@pytest.mark.parametrize("cells", [1, 400, 1 << 17])
def test_sums_of_combined_bins_are_those_of_each_feature(spark, monkeypatch, cells):
    monkeypatch.setattr(G, "CELLS", cells)
    rng = np.random.default_rng(5)
    n, sizes, k = 700, [5, 1, 2, 32, 2], 2
    labels = rng.integers(0, k, n)
    bins = np.column_stack([rng.integers(0, size, n) for size in sizes]).astype(np.uint8)
    scores, fresh = rng.normal(size=(n, k)), rng.normal(size=(n, k))
    blocks = [(b.column(0)[0].as_py(),) for b in G._blocks(labels, bins, scores, fresh)]
    state = spark.createDataFrame([(bytes(b),) for b, in blocks], G.BLOCK)
    feature, cut = np.full((k, 7), G.LEAF, np.int32), np.zeros((k, 7))
    feature[0, 0], cut[0, 0] = 3, 11
    nodes = [(0, 1), (0, 2), (1, 0)]
    got = G._node_sums(state, feature, cut, nodes, sizes, 32)
    first, second = G.gradients(scores + fresh, labels)
    masks = [bins[:, 3] <= 11, bins[:, 3] > 11, np.ones(n, bool)]
    for (c, _), mask, (g, h) in zip(nodes, masks, got):
        for f in range(len(sizes)):
            for b in range(32):
                here = mask & (bins[:, f] == b)
                assert g[f, b] == first[here, c].sum() and h[f, b] == second[here, c].sum()


def test_combined_bins_are_bounded():
    assert G._combined([20, 32, 32, 31, 2, 2], 1024) == [[0, 1], [2, 3], [4, 5]]
    assert G._combined([20, 32, 2], 1) == [[0], [1], [2]]
    assert G._combined([256, 2, 1], 300) == [[0], [1, 2]]
