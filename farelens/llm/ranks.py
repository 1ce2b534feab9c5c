"""A rank index of sorted offsets: error-bounded linear segments and stored residuals."""

from __future__ import annotations

import numpy as np


class RankIndex:
    """Offset of every rank, kept as linear segments and one small correction per rank.

    A segment covers a run of ranks whose offsets lie within ``reach`` of a line through its
    first one; it starts anew where no slope fits all of them.  The residual of a rank is its
    offset less the line's rounded value, so that prediction plus residual is exact.  With the
    default reach a residual takes one byte instead of the eight of an offset.
    """

    def __init__(self, offsets: np.ndarray, reach: int = 126) -> None:
        offsets = np.asarray(offsets, np.int64)
        firsts, slopes = [], []
        at = 0
        while at < len(offsets):
            stop, slope = _segment(offsets, at, reach)
            firsts.append(at)
            slopes.append(slope)
            at = stop
        self.first = np.array(firsts, np.int64)
        self.base = offsets[self.first]
        self.slope = np.array(slopes, np.float64)
        kind = np.int8 if reach < 127 else np.int64
        self.residual = (offsets - self.predict(np.arange(len(offsets)))).astype(kind)

    def predict(self, ranks: np.ndarray) -> np.ndarray:
        """The offsets as the segments have them, at most ``reach + 1`` off."""
        segment = np.searchsorted(self.first, ranks, side="right") - 1
        run = np.asarray(ranks, np.int64) - self.first[segment]
        return self.base[segment] + np.rint(self.slope[segment] * run).astype(np.int64)

    def offsets(self, ranks: np.ndarray) -> np.ndarray:
        """The exact offsets of ``ranks``."""
        return self.predict(ranks) + self.residual[ranks]


def _segment(offsets: np.ndarray, first: int, reach: int) -> tuple[int, float]:
    """End and slope of the longest segment from ``first``, looking ahead in doubling runs."""
    low, high, at, look = -np.inf, np.inf, first + 1, 32
    while at < len(offsets):
        stop = min(at + look, len(offsets))
        run = np.arange(at - first, stop - first)
        rise = offsets[at:stop] - offsets[first]
        lows = np.maximum.accumulate(np.maximum((rise - reach) / run, low))
        highs = np.minimum.accumulate(np.minimum((rise + reach) / run, high))
        bad = np.flatnonzero(lows > highs)
        if len(bad):
            if bad[0]:
                low, high = lows[bad[0] - 1], highs[bad[0] - 1]
            at += int(bad[0])
            break
        low, high, at, look = lows[-1], highs[-1], stop, look * 2
    return at, 0.0 if at == first + 1 else float((low + high) / 2)
