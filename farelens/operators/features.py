"""Feature steps shared by the customer and fare models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from farelens.functions.columns import safe_div
from farelens.operators.selection import LONG_LEVELS, order_statistics


def one_hot(df: DataFrame, name: str, categories: Sequence[str], prefix: str,
            drop_first: bool = False) -> DataFrame:
    """0/1 columns ``prefix_category`` over a fixed category list."""
    wanted = list(categories)[1:] if drop_first else list(categories)
    return df.withColumns({
        f"{prefix}_{c}": F.coalesce((F.col(name) == c).cast("int"), F.lit(0)) for c in wanted})


def moments(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row with the mean and population deviation of every column."""
    return df.agg(*[F.avg(c).alias(f"{c}__mean") for c in cols],
                  *[F.stddev_pop(c).alias(f"{c}__sd") for c in cols])


def z_score(df: DataFrame, cols: Sequence[str], stats: DataFrame | None = None) -> DataFrame:
    """Standardise with the population deviation; a constant column becomes 0.

    ``stats`` is the ``moments`` row of the training data; without it the frame's own.
    """
    row = moments(df, cols) if stats is None else stats
    one = row.select(F.struct(*row.columns)).scalar()

    def scaled(c: str) -> Column:
        deviation = F.col("__one")[f"{c}__sd"]
        centred = F.col(c) - F.col("__one")[f"{c}__mean"]
        return F.when(deviation == 0, centred).otherwise(safe_div(centred, deviation))

    return df.withColumn("__one", one).withColumns({c: scaled(c) for c in cols}).drop("__one")


def min_max(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Scale to 0..1; a constant column becomes 0."""
    ends = df.agg(F.struct(*[F.min(c).alias(f"{c}__lo") for c in cols],
                           *[F.max(c).alias(f"{c}__hi") for c in cols])).scalar()

    def scaled(c: str) -> Column:
        low, high = F.col("__ends")[f"{c}__lo"], F.col("__ends")[f"{c}__hi"]
        return F.when(F.col(c).isNotNull(), F.coalesce(
            safe_div(F.col(c) - low, high - low), F.lit(0.0)))

    return df.withColumn("__ends", ends).withColumns({c: scaled(c) for c in cols}).drop("__ends")


def hash_split(df: DataFrame, row_id: Sequence[str], frac: float = 0.8,
               out: str = "en_train") -> DataFrame:
    """Mark a reproducible share of the rows by a hash of their identity."""
    bucket = F.pmod(F.xxhash64(*row_id), F.lit(10_000))
    return df.withColumn(out, bucket < int(frac * 10_000))


def md5_split(df: DataFrame, row_id: Sequence[str], frac: float = 0.8,
              out: str = "en_train") -> DataFrame:
    """The same by the first 28 bits of an MD5, which other engines have too."""
    text = F.concat_ws("|", *[F.col(c).cast("string") for c in row_id])
    bits = F.conv(F.substring(F.md5(text), 1, 7), 16, 10).cast("long")
    return df.withColumn(out, bits < int(frac * 2 ** 28))


def id_bits(row_id: Sequence[str]) -> Column:
    """The first 60 bits of an MD5 of the row's identity, which other engines have too."""
    text = F.concat_ws("|", *[F.col(c).cast("string") for c in row_id])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def stratified_split(df: DataFrame, label: str, row_id: Sequence[str], frac: float = 0.8,
                     out: str = "en_train") -> DataFrame:
    """Mark the same share of every class, exact to one row; an unknown class is one too.

    Of a class with n rows the round(frac n) of lowest hash are marked (rows of one identity
    share a side).  The hash at that rank is found by counting hash ranges, so no class is
    sorted or collected in one place; the thresholds of all classes are one map value.
    """
    hashed = df.withColumn("__h", id_bits(row_id))
    counts = hashed.select(label, "__h", F.lit(1).cast("long").alias("n"))
    cuts = order_statistics(counts, [label], "__h", lambda n: F.array(
        F.floor(n * F.lit(frac) + 0.5) - 1), levels=LONG_LEVELS)
    name = F.coalesce(F.concat(F.lit("="), F.col(label).cast("string")), F.lit(""))
    table = cuts.agg(F.map_from_entries(F.collect_list(F.struct(name, "__h")))).scalar()
    return hashed.withColumn(
        out, F.coalesce(F.col("__h") <= F.try_element_at(table, name), F.lit(False))).drop("__h")


def errors(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Mean absolute error and root mean squared error."""
    gap = F.col(actual) - F.col(predicted)
    return df.agg(F.avg(F.abs(gap)).alias("MAE"), F.sqrt(F.avg(gap * gap)).alias("RMSE"),
                  F.count(gap).alias("n"))


def confusion(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Rows by actual and predicted class."""
    return df.groupBy(actual, predicted).agg(F.count(F.lit(1)).alias("n"))


def accuracy(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    return df.agg(F.avg((F.col(actual) == F.col(predicted)).cast("int")).alias("accuracy"))
