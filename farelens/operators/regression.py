"""Least squares by group: Spark sums the cross products, each group is then one row."""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import combinations_with_replacement

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T


def _beta_tail(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function by its continued fraction."""
    if x <= 0.0 or x >= 1.0:
        return 0.0 if x <= 0.0 else 1.0
    if x > (a + 1.0) / (a + b + 2.0):
        return 1.0 - _beta_tail(b, a, 1.0 - x)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
                     + a * math.log(x) + b * math.log1p(-x)) / a
    value, c, d = 1.0, 1.0, 0.0
    for i in range(400):
        m = i // 2
        if i == 0:
            term = 1.0
        elif i % 2 == 0:
            term = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        else:
            term = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        d = 1.0 / ((1.0 + term * d) or 1e-300)
        c = (1.0 + term / c) or 1e-300
        value *= c * d
        if abs(1.0 - c * d) < 1e-14:
            break
    return front * (value - 1.0)


def t_quantile(level: float, freedom: float) -> float:
    """Upper quantile of Student's t by bisection (``level`` above one half)."""
    tail = 2.0 * (1.0 - level)
    low, high = 0.0, 1.0

    def above(t: float) -> bool:
        return _beta_tail(freedom / 2.0, 0.5, freedom / (freedom + t * t)) > tail

    while above(high):
        low, high = high, high * 2.0
    for _ in range(200):
        mid = (low + high) / 2.0
        low, high = (mid, high) if above(mid) else (low, mid)
    return (low + high) / 2.0


def gram(df: DataFrame, y: str, x: Sequence[str], group: Sequence[str] = ()) -> DataFrame:
    """Counts and sums of all pairwise products of (1, x.., y), one row per group."""
    names = ["__one", *x, y]
    rows = df.dropna(subset=[*x, y, *group]).withColumn("__one", F.lit(1.0))
    numbers = rows.select(*group, *[F.col(n).cast("double").alias(n) for n in names])
    products = [
        F.sum(F.col(a) * F.col(b)).alias(f"g_{i}_{j}")
        for (i, a), (j, b) in combinations_with_replacement(list(enumerate(names)), 2)
    ]
    return numbers.groupBy(*group).agg(*products)


def _square(row: dict, prefix: str, size: int) -> np.ndarray:
    """The symmetric matrix whose upper half a row holds."""
    full = np.zeros((size, size))
    for i, j in combinations_with_replacement(range(size), 2):
        value = row[f"{prefix}_{i}_{j}"]
        full[i, j] = full[j, i] = np.nan if value is None else value
    return full


def _solved(row: dict, p: int) -> dict | None:
    """Coefficients and what their errors need from one row of ``gram``."""
    full = _square(row, "g", p + 1)
    n = full[0, 0]
    if not np.isfinite(full).all() or n < 1:
        return None
    scale = np.sqrt(np.where(np.diag(full)[:p] > 0, np.diag(full)[:p], 1.0))
    xx, xy, yy = full[:p, :p] / np.outer(scale, scale), full[:p, p] / scale, full[p, p]
    rank = int(np.linalg.matrix_rank(xx, tol=1e-10, hermitian=True))
    if n <= rank:
        return None
    inverse = np.linalg.pinv(xx, rcond=1e-10, hermitian=True)
    beta = inverse @ xy
    return {"n": n, "rank": rank, "beta": beta / scale,
            "inverse": inverse / np.outer(scale, scale),
            "residual": max(yy - float(beta @ xy), 0.0), "total": yy - full[0, p] ** 2 / n}


def _squared_errors(df: DataFrame, sums: DataFrame, y: str, x: Sequence[str],
                    group: Sequence[str]) -> DataFrame:
    """``sums`` with the sums of products of (1, x..) weighted by the squared residual.

    A second pass over the rows, with each group's coefficients as one array.
    """
    p = len(x) + 1
    keys = [sums.schema[g] for g in group]
    out = T.StructType([*keys, T.StructField("__beta", T.ArrayType(T.DoubleType()))])

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = [(row, _solved(row, p)) for row in pdf.to_dict("records")]
        return pd.DataFrame([{**{g: row[g] for g in group}, "__beta": fit["beta"].tolist()}
                             for row, fit in rows if fit], columns=out.names)

    betas = sums.mapInPandas(lambda frames: map(solve, frames), out)
    rows = df.dropna(subset=[*x, y, *group])
    rows = rows.join(betas, list(group)) if group else rows.withColumn("__beta", betas.scalar())
    columns = [F.lit(1.0), *[F.col(c).cast("double") for c in x]]
    fitted = sum((F.col("__beta")[i] * c for i, c in enumerate(columns[1:], 1)),
                 F.col("__beta")[0])
    squared = rows.withColumn("__e2", F.pow(F.col(y).cast("double") - fitted, 2))
    meat = squared.groupBy(*group).agg(*[
        F.sum(F.col("__e2") * columns[i] * columns[j]).alias(f"m_{i}_{j}")
        for i, j in combinations_with_replacement(range(p), 2)])
    if group:
        return sums.join(meat, list(group))
    return sums.withColumn("__m", meat.select(F.struct(*meat.columns)).scalar()).select(
        *sums.columns, "__m.*")


def ols(df: DataFrame, y: str, x: Sequence[str], group: Sequence[str] = (),
        level: float = 0.95, robust: bool = False) -> DataFrame:
    """Ordinary least squares with a constant, one row per group and term.

    Columns that are combinations of others (dummies that sum to one, a category that
    does not occur) are handled by the pseudo-inverse; degrees of freedom follow the
    rank.  Groups too small to fit give no rows.  ``robust`` adds ``std_err_robust``, the error
    that allows for a different spread of every row (the sandwich estimator, times n / (n -
    rank)), at the price of a second pass.
    """
    terms = ["const", *x]
    p = len(terms)
    keys = [df.schema[g] for g in group]
    numbers = ["coef", "std_err", "ci_low", "ci_high", "r2", "r2_adj"]
    out = T.StructType(keys + [
        T.StructField("term", T.StringType()),
        *[T.StructField(n, T.DoubleType()) for n in numbers + ["std_err_robust"] * robust],
        T.StructField("n", T.LongType()),
    ])

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        found = []
        for row in pdf.to_dict("records"):
            fit = _solved(row, p)
            if fit is None:
                continue
            n, free, inverse = fit["n"], fit["n"] - fit["rank"], fit["inverse"]
            error = np.sqrt(np.maximum(np.diag(inverse) * fit["residual"] / free, 0.0))
            r2 = 1.0 - fit["residual"] / fit["total"] if fit["total"] > 0 else float("nan")
            reach = t_quantile(0.5 + level / 2.0, free) * error
            part = {
                **{g: [row[g]] * p for g in group}, "term": terms, "coef": fit["beta"],
                "std_err": error, "ci_low": fit["beta"] - reach, "ci_high": fit["beta"] + reach,
                "r2": r2, "r2_adj": 1.0 - (1.0 - r2) * (n - 1.0) / free}
            if robust:
                spread = inverse @ _square(row, "m", p) @ inverse * n / free
                part["std_err_robust"] = np.sqrt(np.maximum(np.diag(spread), 0.0))
            found.append(pd.DataFrame({**part, "n": int(round(n))}))
        return pd.concat(found) if found else pd.DataFrame(columns=out.names)

    # One row per group arrives here, whatever the number of observations behind it.
    sums = gram(df, y, x, group)
    if robust:
        sums = _squared_errors(df, sums, y, x, group)
    return sums.mapInPandas(lambda frames: map(solve, frames), out)
