"""Joins that hold up when one key owns a large share of the rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

# Smallest share of the rows that makes a key hot; bounds the list of hot keys.
LEAST_SHARE = 1 / 2000
_SLICE = "__slice"


def hot_share(partitions: int) -> float:
    """A key is hot when it would fill a quarter of an even shuffle partition by itself."""
    return max(LEAST_SHARE, 1 / (4 * partitions))


def hot_keys(df: DataFrame, keys: Sequence[str], share: float) -> Column:
    """Hashes of the keys owning more than ``share`` of the rows, with the share of each, as
    one map value.

    A frequent-items sketch finds them in a single pass with partial aggregation; the
    map holds at most ``1 / share`` entries.  The sketch only steers how work is
    spread: a key it misses or adds changes no result.
    """
    limit = int(1 / share)
    sketch = (
        df.select(F.xxhash64(*keys).alias("k"))
        .agg(F.expr(f"approx_top_k(k, {limit}, 10000)").alias("top"),
             F.count(F.lit(1)).alias("n"))
    )
    return sketch.select(F.map_from_entries(F.transform(
        F.filter("top", lambda x: x["count"] > F.col("n") * F.lit(share)),
        lambda x: F.struct(x["item"], x["count"] / F.col("n"))))).scalar()


def spread_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str,
                row_id: Sequence[str], sample: DataFrame | None = None,
                share: float | None = None) -> DataFrame:
    """Equi-join whose hot left keys are divided over tasks.

    Left rows of a hot key go to slices chosen by a hash of ``row_id`` (the same slice
    if a task is rerun), as many as hold about ``share`` of the rows each; the matching right
    rows are repeated once per slice.  Cold keys stay in slice 0 and are not repeated.  Right
    rows with an unknown key match nothing and are left out; for semi- and anti-joins one right
    row per key is enough.
    ``sample`` names a cheaper frame with the same keys to look for hot ones, by default
    ``left`` itself; ``share`` is by default ``hot_share`` of the shuffle partitions.
    """
    keys = _checked(on, how)
    right = right.dropna(subset=keys)
    if how in ("left_semi", "left_anti"):
        right = right.select(*keys).distinct()
    share = share or hot_share(int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    hot = hot_keys(sample if sample is not None else left, keys, share)
    slices = F.coalesce(F.ceil(F.try_element_at(hot, F.xxhash64(*keys)) / F.lit(share)).cast("int"),
                        F.lit(1))
    spread_left = left.withColumn(_SLICE, F.pmod(F.xxhash64(*row_id), slices).cast("int"))
    spread_right = right.withColumn(_SLICE, F.explode(F.sequence(F.lit(0), slices - 1)))
    return spread_left.join(spread_right, keys + [_SLICE], how).drop(_SLICE)


def _checked(on: Sequence[str], how: str) -> list[str]:
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"{how} would repeat or lose right rows")
    return list(on)


@dataclass(frozen=True)
class Bucketed:
    """A stored table: ``cold`` in buckets of ``keys``, and the rows of hot keys, if there are
    any, in a plain table of their own, as they would fill whole buckets."""

    keys: tuple[str, ...]
    cold: DataFrame
    hot: DataFrame | None = None

    def rows(self) -> DataFrame:
        return self.cold if self.hot is None else self.cold.unionByName(self.hot)

    def map(self, change: Callable[[DataFrame], DataFrame]) -> Bucketed:
        """The table after a change that works on each key by itself and keeps the keys."""
        return Bucketed(self.keys, change(self.cold),
                        None if self.hot is None else change(self.hot))


def co_join(left: Bucketed, right: Bucketed, how: str, row_id: Sequence[str],
            on: Sequence[str] | None = None) -> DataFrame:
    """Equi-join on the bucket keys of two tables that were stored with the same hot keys, or on
    keys ``on`` that the bucket keys are among.

    Buckets meet buckets, so neither side is shuffled; hot keys are spread.  With more keys than
    those of the buckets that takes ``session.co_located``.
    """
    return co_joined(left, right, how, row_id, on).rows()


def co_joined(left: Bucketed, right: Bucketed, how: str, row_id: Sequence[str],
              on: Sequence[str] | None = None) -> Bucketed:
    """``co_join`` whose outcome is still in the buckets, for the next one."""
    keys = _checked(on or left.keys, how)
    if (tuple(right.keys) != tuple(left.keys) or not set(left.keys) <= set(keys)
            or (left.hot is None) != (right.hot is None)):
        raise ValueError("both tables need the same buckets and hot keys")
    joined = left.cold.join(right.cold, keys, how)
    if left.hot is None:
        return Bucketed(left.keys, joined)
    return Bucketed(left.keys, joined, spread_join(left.hot, right.hot, keys, how, row_id))
