"""Smoothing and segmentation of the advance-sale curves."""

from __future__ import annotations

from pyspark.sql import functions as F

from farelens.operators import kpis, series as S
from farelens.registry import oracle
from farelens.registry.base import entry, rounded
from farelens.registry.indicators import CLASSED, classified, scope
from farelens.session import materialise

oracle.define("curves", """
SELECT ORIGEN_DESTINO, DIAS_ANTICIPACION, CAST(sum(BOLETOS_VEND) AS BIGINT) AS BOLETOS_VEND
FROM kpi GROUP BY 1, 2""")


def curves(spark, d):
    """Tickets by route and lead day; on some days all of them were cancelled."""
    return kpis.advance_sums(scope(spark, d), ["ORIGEN_DESTINO"]).select(
        "ORIGEN_DESTINO", "DIAS_ANTICIPACION", "BOLETOS_VEND")


@entry("w06_three_point_smoother", """
SELECT ORIGEN_DESTINO, DIAS_ANTICIPACION, BOLETOS_VEND,
  round(CASE WHEN a IS NULL THEN 0.85::DOUBLE * BOLETOS_VEND + 0.15::DOUBLE * b
             WHEN b IS NULL THEN 0.85::DOUBLE * BOLETOS_VEND + 0.15::DOUBLE * a
             ELSE 0.15::DOUBLE * a + 0.7::DOUBLE * BOLETOS_VEND + 0.15::DOUBLE * b END, 6)
    AS BOLETOS_VEND_SMOOTH
FROM (SELECT *, lag(BOLETOS_VEND) OVER w AS a, lead(BOLETOS_VEND) OVER w AS b FROM curves
      WINDOW w AS (PARTITION BY ORIGEN_DESTINO ORDER BY DIAS_ANTICIPACION))""")
def w06(spark, d):
    return rounded(S.weighted3(curves(spark, d), ["ORIGEN_DESTINO"], "DIAS_ANTICIPACION",
                               "BOLETOS_VEND"), "BOLETOS_VEND_SMOOTH")


def _smoothed(table: str) -> str:
    """SQL of the log smoother for each series of a table."""
    return f"""
SELECT ORIGEN_DESTINO, DIAS_ANTICIPACION, BOLETOS_VEND, CASE
  WHEN DIAS_ANTICIPACION < 15 OR n < 3 THEN BOLETOS_VEND
  WHEN i = n THEN exp((f[i] + (f[i - 1] + f[i - 2]) / 2) / 2) ELSE exp(f[i]) END
  AS BOLETOS_VEND_SMOOTH
FROM (
  SELECT ORIGEN_DESTINO, n, xs, vs, unnest(range(1, n + 1)) AS i, xs[i] AS DIAS_ANTICIPACION,
    vs[i] AS BOLETOS_VEND,
    list_transform(range(1, n + 1), lambda k: CASE WHEN n < 7 THEN y[k]
      WHEN k = 1 THEN list_dot_product(y[1:7], [32,15,3,-4,-6,-3,5]::DOUBLE[]) / 42
      WHEN k = 2 THEN list_dot_product(y[1:7], [5,4,3,2,1,0,-1]::DOUBLE[]) / 14
      WHEN k = 3 THEN list_dot_product(y[1:7], [1,3,4,4,3,1,-2]::DOUBLE[]) / 14
      WHEN k = n THEN list_dot_product(y[n-6:n], [5,-3,-6,-4,3,15,32]::DOUBLE[]) / 42
      WHEN k = n - 1 THEN list_dot_product(y[n-6:n], [-1,0,1,2,3,4,5]::DOUBLE[]) / 14
      WHEN k = n - 2 THEN list_dot_product(y[n-6:n], [-2,1,3,4,4,3,1]::DOUBLE[]) / 14
      ELSE list_dot_product(y[k-3:k+3], [-2,3,6,7,6,3,-2]::DOUBLE[]) / 21 END) AS f
  FROM (SELECT ORIGEN_DESTINO, count(*) AS n, list(DIAS_ANTICIPACION ORDER BY DIAS_ANTICIPACION) AS xs,
      list(BOLETOS_VEND ORDER BY DIAS_ANTICIPACION) AS vs,
      list(ln(BOLETOS_VEND) ORDER BY DIAS_ANTICIPACION) AS y
    FROM {table} WHERE BOLETOS_VEND > 0 GROUP BY 1))
UNION ALL SELECT ORIGEN_DESTINO, DIAS_ANTICIPACION, BOLETOS_VEND, BOLETOS_VEND::DOUBLE
FROM {table} WHERE BOLETOS_VEND <= 0"""


def _segments(table: str) -> str:
    """SQL of the greedy segments: every start and end is fitted from running sums, the
    farthest acceptable end is kept for each start, and a recursion follows them."""
    return f"""
WITH RECURSIVE pts AS (
  SELECT ORIGEN_DESTINO AS r, DIAS_ANTICIPACION AS x, ln(BOLETOS_VEND_SMOOTH) AS y,
    row_number() OVER (PARTITION BY ORIGEN_DESTINO ORDER BY DIAS_ANTICIPACION) AS i,
    count(*) OVER (PARTITION BY ORIGEN_DESTINO) AS n
  FROM {table} WHERE BOLETOS_VEND_SMOOTH > 0
), sums AS (
  SELECT a.r, a.i AS s, b.i AS e, a.x AS x0, a.y AS y0, b.i - a.i + 1 AS k,
    sum(b.x - a.x) OVER w AS sx, sum(b.y - a.y) OVER w AS sy, sum((b.x - a.x) ** 2) OVER w AS sxx,
    sum((b.x - a.x) * (b.y - a.y)) OVER w AS sxy, sum((b.y - a.y) ** 2) OVER w AS syy
  FROM pts a JOIN pts b ON a.r = b.r AND b.i >= a.i
  WINDOW w AS (PARTITION BY a.r, a.i ORDER BY b.i)
), spread AS (
  SELECT r, s, e, k, x0 + sx / k AS mx, y0 + sy / k AS my, sxx - sx * sx / k AS vxx,
    sxy - sx * sy / k AS vxy, greatest(syy - sy * sy / k, 0) AS vyy FROM sums
), fits AS (
  SELECT *, CASE WHEN vxx > 0 THEN vxy / vxx ELSE 0 END AS slope,
    greatest(vyy - CASE WHEN vxx > 0 THEN vxy * vxy / vxx ELSE 0 END, 0) AS rest FROM spread
), rated AS (
  SELECT *, sqrt(rest / k) / my * 100 AS rmse,
    CASE WHEN vyy > 1e-12 THEN 1 - rest / vyy WHEN rest <= 1e-12 THEN 1 ELSE 0 END AS r2 FROM fits
), ends AS (
  SELECT r, s, seg, max(e) AS e FROM rated, (VALUES (1), (2), (3)) g(seg)
  WHERE k >= CASE WHEN seg <= 2 THEN 3 ELSE 7 END
    AND rmse <= 1.25 + (seg - 1) * CASE WHEN seg < 3 THEN 0.25 ELSE 1 END
    AND r2 >= 0.9875 - (seg - 1) * CASE WHEN seg < 3 THEN 0.025 ELSE 0.1 END
  GROUP BY r, s, seg UNION ALL SELECT r, i, 4, n FROM pts
), greedy AS (
  SELECT r, s, e, seg FROM ends WHERE seg = 1 AND s = 1
  UNION ALL SELECT n.r, n.s, n.e, n.seg FROM greedy g
  JOIN ends n ON n.r = g.r AND n.s = g.e + 1 AND n.seg = g.seg + 1
)
SELECT r AS ORIGEN_DESTINO, x AS DIAS_ANTICIPACION, seg AS Clasif_venta_anticip_code,
  my + slope * (x - mx) AS y_pred,
  (['Muy Alto', 'Alto', 'Media', 'Bajo'])[seg] AS Clasif_venta_anticip
FROM greedy JOIN fits USING (r, s, e) JOIN pts USING (r) WHERE i BETWEEN s AND e"""


oracle.define("smoothed", _smoothed("curves"))
oracle.define("segments", _segments("smoothed"))
oracle.define("whole_curve", """
SELECT '' AS ORIGEN_DESTINO, DIAS_ANTICIPACION, CAST(sum(BOLETOS_VEND) AS BIGINT) AS BOLETOS_VEND
FROM kpi WHERE DIAS_ANTICIPACION >= 0 GROUP BY 2""")
oracle.define("whole_smooth", _smoothed("whole_curve"))
oracle.define("lead_class", _segments("whole_smooth"))


@entry("w07_log_smoother", """
SELECT * REPLACE (round(BOLETOS_VEND_SMOOTH, 6) AS BOLETOS_VEND_SMOOTH) FROM smoothed""")
def w07(spark, d):
    return rounded(S.smooth_log(curves(spark, d), ["ORIGEN_DESTINO"]), "BOLETOS_VEND_SMOOTH")


@entry("w08_decay_segments", """
SELECT ORIGEN_DESTINO, DIAS_ANTICIPACION, BOLETOS_VEND,
  round(BOLETOS_VEND_SMOOTH, 6) AS BOLETOS_VEND_SMOOTH, round(y_pred, 6) AS y_pred,
  Clasif_venta_anticip_code, Clasif_venta_anticip
FROM smoothed LEFT JOIN segments USING (ORIGEN_DESTINO, DIAS_ANTICIPACION)""")
def w08(spark, d):
    """Greedy decay segments of the advance-sale curve of every route."""
    smooth = S.smooth_log(curves(spark, d), ["ORIGEN_DESTINO"])
    return rounded(S.decay_segments(smooth, ["ORIGEN_DESTINO"], max_segments=4),
                   "BOLETOS_VEND_SMOOTH", "y_pred")


@entry("m24_demand_profile", f"""
SELECT Clasif_venta_anticip, Clasif_asiento, Clasif_mes, Clasif_dia_venta, Clasif_hora_venta,
  count(*) AS n, round(sum(VENTA), 2) AS VENTA
{CLASSED}
LEFT JOIN lead_class USING (DIAS_ANTICIPACION) GROUP BY ALL""")
def m24(spark, d):
    """Tickets by all demand classes, lead-time class included."""
    return classified(spark, d).groupBy("Clasif_venta_anticip", "Clasif_asiento", "Clasif_mes",
                      "Clasif_dia_venta", "Clasif_hora_venta").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("VENTA"), 2).alias("VENTA"))


@entry("w09_change_points")
def w09(spark, d):
    """Exact change points of the advance-sale curve of every route."""
    smooth = S.smooth_log(curves(spark, d), ["ORIGEN_DESTINO"])
    return rounded(S.change_points(smooth, ["ORIGEN_DESTINO"], "DIAS_ANTICIPACION",
                                   "BOLETOS_VEND_SMOOTH"), "BOLETOS_VEND_SMOOTH")


# One round of expectation-maximisation from three components (weight, mean, deviation).
_PART = "w / s * exp(-(v - m) * (v - m) / (2.0::DOUBLE * s * s))"


oracle.define("mixture", f"""
WITH RECURSIVE vals AS (
  SELECT BOLETOS_VEND_SMOOTH AS v, count(*)::DOUBLE AS n FROM smoothed GROUP BY 1
), sorted AS (
  SELECT BOLETOS_VEND_SMOOTH AS v, row_number() OVER (ORDER BY BOLETOS_VEND_SMOOTH) - 1 AS i,
    count(*) OVER () AS n FROM smoothed
), start AS (
  SELECT k, (SELECT min(v) FROM sorted WHERE i = n * (2 * k + 1) // 6) AS m,
    (SELECT sqrt(sum(n * v * v) / sum(n) - (sum(n * v) / sum(n)) ** 2) FROM vals) AS all_s
  FROM range(3) AS t(k)
), em AS (
  SELECT 0 AS round, k, 1 / 3.0::DOUBLE AS w, m, all_s / 3 AS s, all_s FROM start
  UNION ALL
  SELECT round + 1, k, sum(r) / (SELECT sum(n) FROM vals), sum(r * v) / sum(r),
    greatest(sqrt(greatest(sum(r * (v - m) * (v - m)) / sum(r)
      - (sum(r * v) / sum(r) - m) ** 2, 0)), all_s * 1e-6), all_s
  FROM (SELECT *, n * p / sum(p) OVER (PARTITION BY v) AS r
        FROM (SELECT *, {_PART} AS p FROM em, vals WHERE round < 30))
  GROUP BY round, k, m, all_s
), last AS (SELECT * FROM em WHERE round = 30
), ranked AS (SELECT w, m, s, row_number() OVER (ORDER BY m) - 1 AS k FROM last
), labels AS (SELECT v, arg_max(k, p) AS k FROM (SELECT v, k, {_PART} AS p FROM ranked, vals)
  GROUP BY v)
SELECT ORIGEN_DESTINO, DIAS_ANTICIPACION, BOLETOS_VEND,
  round(BOLETOS_VEND_SMOOTH, 6) AS BOLETOS_VEND_SMOOTH, CAST(k AS INTEGER) AS Segmento_GMM
FROM smoothed JOIN labels ON v = BOLETOS_VEND_SMOOTH""")


@entry("w10_mixture_labels", "SELECT * FROM mixture")
def w10(spark, d):
    """Mixture components of the smoothed demand of all routes and lead days."""
    smooth = materialise(S.smooth_log(curves(spark, d), ["ORIGEN_DESTINO"]))
    return rounded(S.mixture_labels(smooth, "BOLETOS_VEND_SMOOTH", rounds=30),
                   "BOLETOS_VEND_SMOOTH")
