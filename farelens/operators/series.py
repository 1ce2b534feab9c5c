"""Smoothing and segmentation of ordered series.

A series is the rows sharing the ``series`` columns, ordered by ``order``.  All inputs
are aggregates with one row per series and order value (a lead day), so one series is
short however many tickets stand behind it.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

from farelens.functions.columns import lookup
from farelens.functions.fixed import ADVANCE_CLASSES
from farelens.operators.selection import order_statistics
from farelens.session import materialise

# Weights of the quadratic least-squares fit over seven points: value at the centre, and
# values at the first three points (mirrored for the last three).
_CENTRE = [-2, 3, 6, 7, 6, 3, -2]  # / 21
_EDGE = [
    [32, 15, 3, -4, -6, -3, 5],
    [5, 4, 3, 2, 1, 0, -1],
    [1, 3, 4, 4, 3, 1, -2],
]
_EDGE_DIVISOR = [42, 14, 14]


def weighted3(df: DataFrame, series: Sequence[str], order: str, value: str,
              out: str | None = None) -> DataFrame:
    """Three-point smoother .15 / .70 / .15, the ends .85 / .15."""
    w = Window.partitionBy(*series).orderBy(order)
    here, before, after = F.col(value), F.lag(value).over(w), F.lead(value).over(w)
    # Written out per position, so that a NULL value inside the series stays NULL.
    row, size = F.row_number().over(w), F.count(F.lit(1)).over(Window.partitionBy(*series))
    smooth = (
        F.when(row == 1, here * 0.85 + after * 0.15)
        .when(row == size, here * 0.85 + before * 0.15)
        .otherwise(before * 0.15 + here * 0.70 + after * 0.15)
    )
    return df.withColumn(out or f"{value}_SMOOTH", smooth)


def _dot(values: list[Column], weights: list[int], divisor: int) -> Column:
    terms = [v * w for v, w in zip(values, weights) if w]
    return sum(terms[1:], terms[0]) / divisor


def smooth_log(df: DataFrame, series: Sequence[str] = (), order: str = "DIAS_ANTICIPACION",
               value: str = "BOLETOS_VEND", from_x: int = 15) -> DataFrame:
    """Savitzky-Golay smoothing of ln(value), window 7, quadratic, used from ``from_x`` on.

    Fewer than three rows are left alone; three to six rows have nothing to smooth but
    their last point.  The last point is averaged with the mean of the two before it.
    Only positive values have a log: rows with others keep their value and do not
    enter the smoothing of the rest.
    """
    keys = [*series, "__ok"]
    rows = df.where(F.col(order) >= 0).withColumn(
        "__ok", F.coalesce(F.col(value) > 0, F.lit(False)))
    by_x = Window.partitionBy(*keys).orderBy(order)
    whole = Window.partitionBy(*keys)
    log = rows.withColumns({
        "__y": F.when(F.col("__ok"), F.ln(value)), "__i": F.row_number().over(by_x),
        "__n": F.count(F.lit(1)).over(whole),
    })
    near = {k: (F.lead("__y", k) if k > 0 else F.lag("__y", -k)).over(by_x) if k else F.col("__y")
            for k in range(-6, 7)}
    i, n = F.col("__i"), F.col("__n")
    fit = F.when(n < 7, F.col("__y"))
    for at in range(3):
        ahead = [near[k - at] for k in range(7)]
        behind = [near[at - k] for k in range(7)]
        fit = fit.when(i == at + 1, _dot(ahead, _EDGE[at], _EDGE_DIVISOR[at]))
        fit = fit.when(i == n - at, _dot(behind, _EDGE[at], _EDGE_DIVISOR[at]))
    fit = fit.otherwise(_dot([near[k] for k in range(-3, 4)], _CENTRE, 21))
    fitted = log.withColumn("__f", fit)
    last = (F.col("__f") + (F.lag("__f", 1).over(by_x) + F.lag("__f", 2).over(by_x)) / 2) / 2
    final = F.when((i == n) & (n >= 3), last).otherwise(F.col("__f"))
    smooth = fitted.withColumn(
        f"{value}_SMOOTH",
        F.when(F.col("__ok") & (F.col(order) >= from_x) & (n >= 3), F.exp(final)).otherwise(
            F.col(value).cast("double")))
    return smooth.drop("__ok", "__y", "__i", "__n", "__f")


def _segment_fit(x: np.ndarray, y: np.ndarray, lengths: np.ndarray):
    """Line fits of the first ``k`` points for every k in ``lengths``: rmse percent and R2."""
    xc, yc = x - x[0], y - y.mean()
    n = lengths.astype(float)
    at = lengths - 1
    sx, sy = np.cumsum(xc)[at], np.cumsum(yc)[at]
    sxx = np.cumsum(xc * xc)[at] - sx * sx / n
    sxy = np.cumsum(xc * yc)[at] - sx * sy / n
    syy = np.maximum(np.cumsum(yc * yc)[at] - sy * sy / n, 0.0)
    with np.errstate(divide="ignore", invalid="ignore"):
        explained = np.where(sxx > 0, sxy * sxy / np.where(sxx > 0, sxx, 1.0), 0.0)
        residual = np.maximum(syy - explained, 0.0)
        flat = syy <= 1e-12
        r2 = np.where(flat, np.where(residual <= 1e-12, 1.0, 0.0),
                      1.0 - residual / np.where(flat, 1.0, syy))
        rmse_pct = np.sqrt(residual / n) / (y.mean() + sy / n) * 100
    return rmse_pct, r2


def _decay_labels(x: np.ndarray, y: np.ndarray, max_segments: int, rmse0: float, r2_0: float):
    """Segment number of every point and the fitted log line, by the greedy rule."""
    n = len(x)
    labels, fitted = np.full(n, np.nan), np.full(n, np.nan)
    start, seg = 0, 1
    while start < n and seg <= max_segments:
        end = None
        if seg == max_segments:
            end = n
        else:
            shortest = 3 if seg <= 2 else 7
            lengths = np.arange(n - start, shortest - 1, -1)
            if len(lengths):
                rmse, r2 = _segment_fit(x[start:], y[start:], lengths)
                up, down = (0.25, 0.025) if seg < 3 else (1.0, 0.1)
                good = (rmse <= rmse0 + (seg - 1) * up) & (r2 >= r2_0 - (seg - 1) * down)
                if good.any():
                    end = start + int(lengths[np.argmax(good)])
        if end is None:
            break
        xs, ys = x[start:end], y[start:end]
        dx = xs - xs.mean()
        slope = (dx * ys).sum() / (dx * dx).sum() if len(xs) > 1 else 0.0
        fitted[start:end] = ys.mean() + slope * dx
        labels[start:end] = seg
        start, seg = end, seg + 1
    return labels, fitted


def decay_segments(df: DataFrame, series: Sequence[str] = (), x: str = "DIAS_ANTICIPACION",
                   y: str = "BOLETOS_VEND_SMOOTH", max_segments: int = 5, rmse0: float = 1.25,
                   r2_0: float = 0.9875) -> DataFrame:
    """Greedy segments of exponential decay along ``x``, longest acceptable first.

    Adds the segment number, its class and the fitted log value; rows after the last
    acceptable segment stay without, and so do rows without a positive value, which have no
    log and are left out of the fits.  ``df`` has one row per series and ``x``.
    """
    keyed = df.where(F.col(x) >= 0)
    out = T.StructType(keyed.schema.fields + [
        T.StructField("y_pred", T.DoubleType()),
        T.StructField("Clasif_venta_anticip_code", T.IntegerType()),
    ])

    def label(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(x).reset_index(drop=True)
        values = pdf[y].to_numpy(float, na_value=np.nan)
        known = np.flatnonzero(values > 0)
        labels, fitted = np.full(len(pdf), np.nan), np.full(len(pdf), np.nan)
        labels[known], fitted[known] = _decay_labels(
            pdf[x].to_numpy(float)[known], np.log(values[known]), max_segments, rmse0, r2_0)
        return pdf.assign(y_pred=fitted,
                          Clasif_venta_anticip_code=pd.array(labels, dtype="Int32"))

    # With no series columns the whole input is one series: one row per lead day.
    found = keyed.groupBy(*series).applyInPandas(label, out)
    return found.withColumn("Clasif_venta_anticip",
                            lookup("Clasif_venta_anticip_code", ADVANCE_CLASSES))


def _change_points(y: np.ndarray, breaks: int) -> np.ndarray:
    """Segment number per point minimising the squared error around segment means."""
    n = len(y)
    parts = min(breaks + 1, n)
    yc = y - y.mean()
    s1 = np.concatenate([[0.0], np.cumsum(yc)])
    s2 = np.concatenate([[0.0], np.cumsum(yc * yc)])
    cost = np.full(n + 1, np.inf)
    cost[0] = 0.0
    back = np.zeros((parts, n + 1), dtype=int)
    for k in range(parts):
        step = np.full(n + 1, np.inf)
        for end in range(k + 1, n + 1):
            starts = np.arange(k, end)
            spread = s2[end] - s2[starts] - (s1[end] - s1[starts]) ** 2 / (end - starts)
            best = cost[starts] + spread
            at = int(np.argmin(best))
            step[end], back[k, end] = best[at], starts[at]
        cost = step
    labels, end = np.zeros(n, dtype=int), n
    for k in range(parts - 1, -1, -1):
        labels[back[k, end]:end] = k
        end = back[k, end]
    return labels


def change_points(df: DataFrame, series: Sequence[str], order: str, value: str,
                  breaks: int = 4) -> DataFrame:
    """Exact change-point segments (``breaks`` breaks) of each series."""
    out = T.StructType(df.schema.fields + [T.StructField("Segmento_CPD", T.IntegerType())])

    def label(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order).reset_index(drop=True)
        return pdf.assign(Segmento_CPD=_change_points(
            pdf[value].to_numpy(float), breaks).astype("int32"))

    return df.groupBy(*series).applyInPandas(label, out)


@dataclass(frozen=True)
class Mixture:
    """Weight, mean and deviation of every component, by mean."""

    weights: tuple[float, ...]
    means: tuple[float, ...]
    spreads: tuple[float, ...]

    def densities(self, value: Column) -> list[Column]:
        """Weighted density of each component, without the factor they all share."""
        return [F.lit(w / s) * F.exp(-((value - m) * (value - m)) / (2.0 * s * s))
                for w, m, s in zip(self.weights, self.means, self.spreads)]


def fit_mixture(df: DataFrame, value: str, k: int = 3, rounds: int = 60,
                tolerance: float = 1e-10) -> tuple[Mixture, float]:
    """Gaussian mixture of the known values by expectation-maximisation, and its likelihood.

    The rows are first counted by value, and every round is one aggregate over the counts.
    The fit starts from the quantiles (2i + 1) / 2k with the deviation of all values over k, so
    that it is the same every time.  A deviation stays above a millionth of that of all values.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(F.col(value).cast("double").alias("v")).agg(
        F.count(F.lit(1)).alias("n"))
    counts = materialise(counts)
    starts = order_statistics(counts, [], "v", lambda n: F.array_distinct(F.array(
        *[F.floor(n * (2 * i + 1) / (2 * k)) for i in range(k)])))
    found = sorted((r["rank"], r["v"]) for r in starts.collect())
    n, deviation = counts.agg(F.sum("n"), F.sqrt(
        F.sum(F.col("n") * F.col("v") * F.col("v")) / F.sum("n")
        - F.pow(F.sum(F.col("n") * F.col("v")) / F.sum("n"), 2))).first()
    if not found:
        raise ValueError("there are no values to fit")
    least = max(deviation or 0.0, 1e-9) * 1e-6
    means = [found[min(i, len(found) - 1)][1] for i in range(k)]
    model = Mixture((1.0 / k,) * k, tuple(means), (max((deviation or 0.0) / k, least),) * k)
    before = -math.inf
    for _ in range(rounds):
        parts = model.densities(F.col("v"))
        whole = sum(parts[1:], parts[0])
        # Far from every component all densities vanish; such a value has none of them.
        shares = [F.coalesce(F.try_divide(x, whole), F.lit(0.0)) * F.col("n") for x in parts]
        row = counts.agg(
            F.sum(F.col("n") * F.ln(F.greatest(whole, F.lit(1e-300)))).alias("likelihood"),
            *[F.sum(r).alias(f"w{i}") for i, r in enumerate(shares)],
            *[F.sum(r * F.col("v")).alias(f"s{i}") for i, r in enumerate(shares)],
            *[F.sum(r * F.pow(F.col("v") - F.lit(m), 2)).alias(f"q{i}")
              for i, (r, m) in enumerate(zip(shares, model.means))]).first()
        likelihood = row["likelihood"] - n * 0.5 * math.log(2 * math.pi)
        if likelihood - before <= tolerance * abs(likelihood):
            break
        before = likelihood
        fitted = []
        for i in range(k):
            weight = row[f"w{i}"]
            if weight < 1e-12:
                fitted.append((1e-12, model.means[i], model.spreads[i]))
                continue
            mean = row[f"s{i}"] / weight
            around = row[f"q{i}"] / weight - (mean - model.means[i]) ** 2
            fitted.append((weight / n, mean, max(math.sqrt(max(around, 0.0)), least)))
        fitted.sort(key=lambda x: x[1])
        model = Mixture(*map(tuple, zip(*fitted)))
    return model, before


def mixture_labels(df: DataFrame, value: str, k: int = 3, rounds: int = 60) -> DataFrame:
    """Gaussian-mixture component of each value, 0 the one of lowest mean.

    The fit is ``fit_mixture``; rows without a value are left out.
    """
    model, _ = fit_mixture(df, value, k, rounds)
    parts = F.array(*model.densities(F.col(value).cast("double")))
    best = F.array_position(parts, F.array_max(parts)) - 1
    return df.where(F.col(value).isNotNull()).withColumn("Segmento_GMM", best.cast("int"))
