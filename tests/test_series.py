"""Smoothers and segmentation against direct computation."""

import itertools

import numpy as np
import pytest
from pyspark.ml.clustering import GaussianMixture
from pyspark.ml.feature import VectorAssembler

from farelens.operators import series as S


def curve(spark, values, key="r"):
    return spark.createDataFrame([(key, i, float(v)) for i, v in enumerate(values)],
                                 "serie string, DIAS_ANTICIPACION int, BOLETOS_VEND double")


def ordered(df, name):
    return [r[name] for r in df.orderBy("serie", "DIAS_ANTICIPACION").collect()]


def test_three_point_smoother(spark):
    got = S.weighted3(curve(spark, [1, 2, 4, 8]), ["serie"], "DIAS_ANTICIPACION", "BOLETOS_VEND")
    assert ordered(got, "BOLETOS_VEND_SMOOTH") == pytest.approx(
        [0.85 + 0.3, 0.15 + 1.4 + 0.6, 0.3 + 2.8 + 1.2, 0.85 * 8 + 0.6])


def savgol(y):
    """Quadratic fits over seven points, the ends on the first and last seven."""
    n, out = len(y), []
    for i in range(n):
        start = min(max(i - 3, 0), n - 7)
        x = np.arange(start, start + 7)
        out.append(np.polyval(np.polyfit(x, y[start:start + 7], 2), i))
    return np.array(out)


def test_log_smoother_matches_local_fits(spark):
    rng = np.random.default_rng(7)
    values = np.exp(5 - 0.1 * np.arange(30) + rng.normal(0, 0.2, 30))
    got = ordered(S.smooth_log(curve(spark, values), ["serie"]), "BOLETOS_VEND_SMOOTH")
    want = savgol(np.log(values))
    want[-1] = (want[-1] + want[-3:-1].mean()) / 2
    assert got[:15] == pytest.approx(list(values[:15]))
    assert got[15:] == pytest.approx(list(np.exp(want[15:])))


def test_log_smoother_reproduces_a_quadratic(spark):
    x = np.arange(20)
    values = np.exp(2 + 0.1 * x - 0.01 * x * x)
    got = ordered(S.smooth_log(curve(spark, values), ["serie"], from_x=0), "BOLETOS_VEND_SMOOTH")
    assert got[:-1] == pytest.approx(list(values[:-1]))


@pytest.mark.parametrize("n", [2, 5])
def test_short_curves(spark, n):
    values = np.array([8.0, 4.0, 6.0, 3.0, 5.0])[:n]
    got = ordered(S.smooth_log(curve(spark, values), ["serie"], from_x=0), "BOLETOS_VEND_SMOOTH")
    want = np.log(values)
    if n >= 3:
        want[-1] = (want[-1] + want[-3:-1].mean()) / 2
    assert got == pytest.approx(list(np.exp(want)))


def test_rows_without_a_log_stay(spark):
    got = S.smooth_log(curve(spark, [5, 0, 4, 3, 2, 6, 5, 4, 3]), ["serie"], from_x=0)
    values = ordered(got, "BOLETOS_VEND_SMOOTH")
    assert len(values) == 9 and values[1] == 0.0


def line(x, y):
    """Relative error in percent and R2 of the line through some points."""
    off = y - np.polyval(np.polyfit(x, y, 1), x)
    return np.sqrt(np.mean(off ** 2)) / y.mean() * 100, 1 - (off @ off) / np.var(y) / len(y)


def farthest_ends(x, y, most):
    """Segments by the rule: all stretches are rated, each start has its farthest good end."""
    n = len(x)
    rated = {(a, b): line(x[a:b], y[a:b]) for a in range(n) for b in range(a + 3, n + 1)}
    limits = {1: (3, 1.25, 0.9875), 2: (3, 1.5, 0.9625), 3: (7, 3.25, 0.7875)}
    ends = {(a, k): max((b for (s, b), (rmse, r2) in rated.items() if s == a and b - a >= least
                         and rmse <= error and r2 >= fit), default=None)
            for k, (least, error, fit) in limits.items() for a in range(n)}
    ends.update({(a, most): n for a in range(n)})
    labels, at = [None] * n, 0
    for k in range(1, most + 1):
        end = ends.get((at, k))
        if end is None:
            break
        labels[at:end] = [k] * (end - at)
        at = end
    return labels


@pytest.mark.parametrize("seed", range(5))
def test_decay_segments_follow_the_rule(spark, seed):
    rng = np.random.default_rng(seed)
    x = np.arange(60)
    log = np.where(x < 18, 8 - 0.15 * x, np.where(x < 40, 5.8 - 0.03 * x, 5.2 - 0.015 * x))
    log = log + rng.normal(0, 0.02 * seed, 60)
    df = curve(spark, np.exp(log)).withColumnRenamed("BOLETOS_VEND", "y")
    got = S.decay_segments(df, ["serie"], y="y", max_segments=4)
    assert ordered(got, "Clasif_venta_anticip_code") == farthest_ends(x, log, 4)


def test_planted_segments_and_classes(spark):
    x = np.arange(41)
    values = np.exp(np.where(x <= 20, 9 - 0.2 * x, 5.6 - 0.03 * x))
    df = curve(spark, values).withColumnRenamed("BOLETOS_VEND", "y")
    got = S.decay_segments(df, ["serie"], y="y")
    labels = ordered(got, "Clasif_venta_anticip")
    assert labels[0] == "Muy Alto" and set(labels) <= {"Muy Alto", "Alto"}
    codes = ordered(got, "Clasif_venta_anticip_code")
    assert codes == sorted(codes)


def test_series_are_independent(spark):
    one = np.exp(6 - 0.1 * np.arange(12))
    df = curve(spark, one, "a").union(curve(spark, one[::-1], "b")).withColumnRenamed(
        "BOLETOS_VEND", "y")
    got = S.decay_segments(df, ["serie"], y="y")
    assert got.where("Clasif_venta_anticip_code = 1").count() == 24


def test_change_points_are_optimal(spark):
    rng = np.random.default_rng(3)
    y = np.concatenate([rng.normal(m, 0.3, 3) for m in (0, 4, 1, 7)])
    got = np.array(ordered(S.change_points(
        curve(spark, y), ["serie"], "DIAS_ANTICIPACION", "BOLETOS_VEND", 3), "Segmento_CPD"))

    def cost(cuts):
        return sum(((p - p.mean()) ** 2).sum() for p in np.split(y, cuts))

    best = min(itertools.combinations(range(1, len(y)), 3), key=cost)
    assert list(np.flatnonzero(np.diff(got)) + 1) == list(best)


def test_mixture_separates_planted_levels(spark):
    rng = np.random.default_rng(5)
    y = np.concatenate([rng.normal(m, 0.2, 60) for m in (1, 10, 30)])
    got = S.mixture_labels(curve(spark, y), "BOLETOS_VEND")
    labels = ordered(got, "Segmento_GMM")
    assert labels == [0] * 60 + [1] * 60 + [2] * 60
    again = S.mixture_labels(curve(spark, y).repartition(3), "BOLETOS_VEND")
    assert ordered(again, "Segmento_GMM") == labels


@pytest.mark.parametrize("seed", range(3))
def test_mixture_is_as_likely_as_the_best_of_random_starts(spark, seed):
    rng = np.random.default_rng(seed)
    y = np.concatenate([rng.normal(2, 0.5, 80), rng.normal(5, 1, 60), rng.normal(9, 0.7, 90)])
    df = curve(spark, y.round(1))
    _, found = S.fit_mixture(df, "BOLETOS_VEND", rounds=200)
    rows = VectorAssembler(inputCols=["BOLETOS_VEND"], outputCol="v").transform(df)
    best = max(GaussianMixture(featuresCol="v", k=3, seed=i, maxIter=60).fit(
        rows).summary.logLikelihood for i in range(3))
    assert found >= best - 0.05


def test_mixture_of_few_or_no_values(spark):
    assert set(ordered(S.mixture_labels(curve(spark, [4, 4, 4]), "BOLETOS_VEND"),
                       "Segmento_GMM")) == {0}
    with pytest.raises(ValueError, match="no values"):
        S.fit_mixture(curve(spark, []), "BOLETOS_VEND")


def test_a_day_without_sales_leaves_the_other_labels(spark):
    rows = [(i, 1000 * float(np.exp(-i / 9))) for i in range(40)]
    rows[25] = (25, 0.0)
    df = spark.createDataFrame(rows, "DIAS_ANTICIPACION int, v double")
    found = {r["DIAS_ANTICIPACION"]: r["Clasif_venta_anticip_code"]
             for r in S.decay_segments(df, y="v").collect()}
    assert found.pop(25) is None and set(found.values()) == {1}
