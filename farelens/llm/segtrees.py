"""Hash-consed segment trees over count vectors, and sums over two of them at once."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

EMPTY = -1  # the leaf that fills a tree up to a power of two


class Forest:
    """Segment trees of several count vectors of one length, with shared nodes.

    A leaf is a count, a node is the pair of its children.  Equal counts are one leaf and
    equal pairs one node, in whichever tree and at whichever place they occur, so that two
    subtrees have the same number exactly if all their counts are the same.
    """

    def __init__(self, counts: np.ndarray) -> None:
        """``counts`` has a row per tree and a column per leaf."""
        trees, leaves = counts.shape
        width = 1 << max(0, leaves - 1).bit_length()
        filled = np.full((trees, width), EMPTY, np.int64)
        filled[:, :leaves] = counts
        self.values, found = np.unique(filled, return_inverse=True)
        ids = found.reshape(trees, width)
        # Children of every node, one pair of arrays per level, lowest first.
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        self.sizes = [len(self.values)]
        while ids.shape[1] > 1:
            pairs = ids[:, 0::2] * self.sizes[-1] + ids[:, 1::2]
            nodes, found = np.unique(pairs, return_inverse=True)
            self.levels.append((nodes // self.sizes[-1], nodes % self.sizes[-1]))
            ids = found.reshape(trees, -1)
            self.sizes.append(len(nodes))
        self.roots = ids[:, 0]

    def total(self, one: int, other: int,
              price: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, ...]],
              ) -> tuple[int, ...]:
        """Sums of ``price`` over the leaves that two trees have at the same place.

        Both trees are walked down together, level by level.  Each pair of nodes is kept once
        however often it occurs, so ``price`` sees each pair of leaf numbers once, and on the
        way back a node pair's sum is added up once from those of its children.
        """
        a, b = self.roots[one:one + 1], self.roots[other:other + 1]
        met = []
        for (left, right), size in zip(reversed(self.levels), reversed(self.sizes[:-1])):
            below = np.concatenate([left[a], right[a]]) * size + np.concatenate(
                [left[b], right[b]])
            pairs, found = np.unique(below, return_inverse=True)
            met.append(found)
            a, b = pairs // size, pairs % size
        sums = price(a, b)
        for found in reversed(met):
            half = len(found) // 2
            sums = tuple(s[found[:half]] + s[found[half:]] for s in sums)
        return tuple(int(s[0]) for s in sums)
