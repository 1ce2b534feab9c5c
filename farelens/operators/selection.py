"""Exact order statistics of large groups, found by counting.

The value at a rank is narrowed down level by level: the rows of a group are counted by a coarse
rounding of their value, the running count says which rounded value holds the rank, and only
rows that round to it are counted by the next finer rounding, until the last level, which is
the value itself.  Roundings never reverse the order of two values, so the answer is exact.  No
group is sorted or gathered: what meets in one place is one count per rounded value, bounded by
the levels (see ``DOUBLE_LEVELS`` and ``LONG_LEVELS``) whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

Level = Callable[[Column], Column]


def _magnitude(steps: int) -> Level:
    """The value's logarithm in whole steps, mirrored for negative values; 0 for zero."""
    def level(value: Column) -> Column:
        size = F.floor((F.log2(F.abs(value)) + 1100) * float(steps))
        return F.when(value > 0, size).when(value < 0, -size - 1).otherwise(0)
    return level


def _same(value: Column) -> Column:
    return value


# Steps of 1/2^14 of a doubling, then 1/2^33: the second level has 2^19 roundings of one of the
# first, and some 360,000 doubles round alike there.
DOUBLE_LEVELS: tuple[Level, ...] = (
    _magnitude(1 << 14), _magnitude(1 << 33), _same)
# 65,536 roundings at every level.
LONG_LEVELS: tuple[Level, ...] = tuple(
    (lambda bits: lambda value: F.shiftright(value, bits))(bits) for bits in (48, 32, 16)
) + (_same,)


def order_statistics(counts: DataFrame, keys: Sequence[str], value: str,
                     ranks: Callable[[Column], Column], n: str = "n", rank: str = "rank",
                     levels: Sequence[Level] = DOUBLE_LEVELS) -> DataFrame:
    """``keys``, ``rank`` and the ``value`` at that rank, from 0, for each group.

    ``counts`` holds ``keys``, a value and how often it occurs, in any number of rows; unknown
    values are left out.  ``ranks`` gives an array of different ranks for a group's number of
    known values; those outside the group are left out.  NULL keys are a group.
    """
    rows = counts.where(F.col(value).isNotNull())
    group = Window.partitionBy(*keys)
    sums = rows.groupBy(*keys, levels[0](F.col(value)).alias("__at")).agg(F.sum(n).alias("__n"))
    upto = F.sum("__n").over(group.orderBy("__at").rowsBetween(
        Window.unboundedPreceding, Window.currentRow))
    here = F.filter("__ranks", lambda r: (
        (r < F.col("__upto")) & (r >= F.col("__upto") - F.col("__n"))))
    picks = sums.withColumns({"__upto": upto, "__ranks": F.transform(
        ranks(F.sum("__n").over(group)), lambda r: r.cast("long"))}).select(
        *keys, "__at", (F.col("__upto") - F.col("__n")).alias("__before"),
        F.explode(here).alias(rank)).select(
        *keys, rank, "__at", (F.col(rank) - F.col("__before")).alias("__left"))
    known, asked = [*keys, "__at"], [*keys, rank]
    one_target = Window.partitionBy(*asked).orderBy("__next").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    for coarse, fine in zip(levels, levels[1:]):
        marked = rows.select(*keys, coarse(F.col(value)).alias("__at"),
                             fine(F.col(value)).alias("__next"), F.col(n).alias("__n"))
        wanted = picks.withColumnsRenamed({c: f"{c}__r" for c in known})
        same = reduce(lambda a, b: a & b, [marked[c].eqNullSafe(wanted[f"{c}__r"]) for c in known])
        sums = marked.join(wanted, same).groupBy(*asked, "__left", "__next").agg(
            F.sum("__n").alias("__n"))
        before = F.sum("__n").over(one_target) - F.col("__n")
        picks = sums.withColumn("__before", before).where(
            (F.col("__left") >= F.col("__before"))
            & (F.col("__left") < F.col("__before") + F.col("__n"))).select(
            *asked, (F.col("__left") - F.col("__before")).alias("__left"),
            F.col("__next").alias("__at"))
    return picks.select(*asked, F.col("__at").alias(value))


def medians(counts: DataFrame, keys: Sequence[str], value: str, n: str = "n",
            levels: Sequence[Level] = DOUBLE_LEVELS) -> DataFrame:
    """``keys`` and the median of the known values of each group, the mean of the middle two."""
    found = order_statistics(counts, keys, value, lambda n: F.array_distinct(F.array(
        F.floor((n - 1) / 2), F.floor(n / 2))), n, levels=levels)
    return found.groupBy(*keys).agg(((F.min(value) + F.max(value)) / 2).alias(value))
