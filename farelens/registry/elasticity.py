"""Elasticity and regression."""

from __future__ import annotations

from pyspark.sql import functions as F

from farelens.bindings import BASE_YEAR
from farelens.operators import elasticity as E
from farelens.plans import datasets as S
from farelens.registry import oracle
from farelens.registry.base import entry, rounded, tickets
from farelens.sources.stored import stored
from farelens.registry.indicators import longs

oracle.define("trip_mean", """
SELECT ORIGEN_DESTINO, FECHA_CORRIDA, CV_CORRIDA,
  avg(INGRESO_TEORICO_TRAMO) AS INGRESO_TEORICO_TRAMO, avg(TARIFA_BASE_TRAMO) AS TARIFA_BASE_TRAMO,
  avg(INGRESO_TRANSP) AS INGRESO_TRANSP, avg(CAPACIDAD_ASIENTOS_TRAMO) AS CAPACIDAD_ASIENTOS_TRAMO,
  avg(OCUPACION_TRAMO) AS OCUPACION_TRAMO, avg(PAX_SUBEN) AS PAX_SUBEN,
  avg(DISPONIBILIDAD_TRAMO) AS DISPONIBILIDAD_TRAMO
FROM elas_set GROUP BY 1, 2, 3""")
oracle.define("elas", """
SELECT *, pd / nullif(pp, 0) AS ELASTICIDADES FROM (
  SELECT ORIGEN_DESTINO, FECHA_CORRIDA,
    sum(TARIFA_BASE_TRAMO * (PAX_SUBEN + DISPONIBILIDAD_TRAMO)) AS INGRESO_TEORICO,
    sum(INGRESO_TRANSP) AS INGRESO_TRANSP, sum(PAX_SUBEN + DISPONIBILIDAD_TRAMO) AS Q,
    sum(DISPONIBILIDAD_TRAMO) AS DISPONIBILIDAD_TRAMO, dayname(FECHA_CORRIDA) AS "Day",
    (sum(INGRESO_TRANSP) - sum(TARIFA_BASE_TRAMO * (PAX_SUBEN + DISPONIBILIDAD_TRAMO)))
      / nullif(sum(TARIFA_BASE_TRAMO * (PAX_SUBEN + DISPONIBILIDAD_TRAMO)), 0) AS pp,
    -sum(DISPONIBILIDAD_TRAMO) / nullif(sum(PAX_SUBEN + DISPONIBILIDAD_TRAMO), 0) AS pd
  FROM trip_mean GROUP BY 1, 2)""")
oracle.define("calendar", """
SELECT ORIGEN_DESTINO, TRY_CAST(y || '-' || m || '-' || d AS DATE) AS FECHA_CORRIDA, ELASTICIDADES
FROM (SELECT ORIGEN_DESTINO, month(FECHA_CORRIDA) AS m, day(FECHA_CORRIDA) AS d,
    avg(ELASTICIDADES) AS ELASTICIDADES FROM elas GROUP BY 1, 2, 3),
  (SELECT max(year(FECHA_CORRIDA)) + 1 AS y FROM elas)
WHERE TRY_CAST(y || '-' || m || '-' || d AS DATE) IS NOT NULL""")
oracle.define("grid", """
SELECT ORIGEN_DESTINO, MES AS mes, FECHA_CORRIDA, isodow(FECHA_OPERACION) - 1 AS dia,
  HORA_DECIMAL AS hora, avg(TARIFA_BASE_TRAMO) AS precio_unitario,
  CAST(sum(PAX_SUBEN) AS BIGINT) AS demanda_real, avg(VENTA) AS ingreso_real,
  CAST(sum(BOLETOS_VEND) AS BIGINT) AS BOLETOS_VEND,
  avg(CAPACIDAD_ASIENTOS_TRAMO) AS CAPACIDAD_ASIENTOS_TRAMO,
  avg(DIAS_ANTICIPACION) AS DIAS_ANTICIPACION, avg(HORAS_ANTICIPACION) AS HORAS_ANTICIPACION,
  avg(OCUPACION_TRAMO) AS OCUPACION_TRAMO
FROM tickets WHERE VENTA > 0 GROUP BY 1, 2, 3, 4, 5""")
oracle.define("days", """
SELECT * FROM (
  SELECT FECHA_OPERACION, ANIO, NOMBRE_DIA_CORRIDA, count(OPERACION) AS Num_Opers,
    CAST(sum(TOTAL_BOLETOS) AS BIGINT) AS Tot_Boletos, sum(TOTAL_VENTA) AS Tot_Venta,
    avg(OCUPACION_TRAMO) AS Prom_Ocupacion, avg(DIAS_ANTICIPACION) AS Dias_Anticip,
    avg(TARIFA_BASE_TRAMO) AS Tarif_Base_Tramo, avg(DIF_TARIF) AS Dif_Tarifa,
    sum(TOTAL_VENTA) / nullif(sum(TOTAL_BOLETOS), 0) AS Costo_Prom_Boleto
  FROM tickets GROUP BY 1, 2, 3)
WHERE Tot_Boletos > 0 AND Tot_Venta > 0""")
for _name, _value, _where in (
    ("fare_defl", "Tarif_Base_Tramo", "true"),
    ("stable_defl", "Costo_Prom_Boleto",
     "Dias_Anticip BETWEEN 7 AND 30 AND Prom_Ocupacion BETWEEN 30 AND 70"),
):
    oracle.define(_name, f"""
SELECT ANIO, idx / max(CASE WHEN ANIO = {BASE_YEAR} THEN idx END) OVER () AS deflator FROM (
  SELECT ANIO, sum({_value} * Tot_Boletos) / sum(Tot_Boletos) AS idx FROM days
  WHERE {_where} GROUP BY 1)""")


def elasticities(spark, d):
    return E.route_day_elasticity(S.elasticity_set(tickets(spark, d)))


@entry("a10_trip_means", """
SELECT ORIGEN_DESTINO, FECHA_CORRIDA, CV_CORRIDA, round(TARIFA_BASE_TRAMO, 5) AS TARIFA_BASE_TRAMO,
  round(INGRESO_TRANSP, 5) AS INGRESO_TRANSP, round(PAX_SUBEN, 5) AS PAX_SUBEN,
  round(DISPONIBILIDAD_TRAMO, 5) AS DISPONIBILIDAD_TRAMO,
  round(OCUPACION_TRAMO, 5) AS OCUPACION_TRAMO FROM trip_mean""")
def a10(spark, d):
    names = ["TARIFA_BASE_TRAMO", "INGRESO_TRANSP", "PAX_SUBEN", "DISPONIBILIDAD_TRAMO",
             "OCUPACION_TRAMO"]
    df = E.trip_means(S.elasticity_set(tickets(spark, d))).select(
        "ORIGEN_DESTINO", "FECHA_CORRIDA", "CV_CORRIDA", *names)
    return rounded(df, *names, digits=5)


@entry("a11_route_day_sums", """
SELECT ORIGEN_DESTINO, FECHA_CORRIDA, round(INGRESO_TEORICO, 5) AS INGRESO_TEORICO,
  round(INGRESO_TRANSP, 5) AS INGRESO_TRANSP, round(Q, 5) AS Q,
  round(DISPONIBILIDAD_TRAMO, 5) AS DISPONIBILIDAD_TRAMO FROM elas""")
def a11(spark, d):
    df = E.route_day_sums(E.trip_means(S.elasticity_set(tickets(spark, d))))
    return rounded(rounded(df, "INGRESO_TEORICO", digits=5), "INGRESO_TRANSP", "Q",
                   "DISPONIBILIDAD_TRAMO", digits=5)


@entry("e01_route_day_elasticity", """
SELECT ORIGEN_DESTINO, FECHA_CORRIDA, "Day", round(pp, 8) AS PCT_P, round(pd, 8) AS PCT_D,
  round(ELASTICIDADES, 8) AS ELASTICIDADES FROM elas""")
def e01(spark, d):
    df = elasticities(spark, d).select(
        "ORIGEN_DESTINO", "FECHA_CORRIDA", "Day", "PCT_P", "PCT_D", "ELASTICIDADES")
    return rounded(df, "PCT_P", "PCT_D", "ELASTICIDADES", digits=8)


@entry("a12_calendar_means", """
SELECT ORIGEN_DESTINO, month(FECHA_CORRIDA) AS month, day(FECHA_CORRIDA) AS day,
  round(avg(ELASTICIDADES), 8) AS ELASTICIDADES FROM elas GROUP BY 1, 2, 3""")
def a12(spark, d):
    df = E.calendar_means(elasticities(spark, d))
    return rounded(longs(df, "month", "day"), "ELASTICIDADES", digits=8)


@entry("e02_forward_calendar", """
SELECT * REPLACE (round(ELASTICIDADES, 8) AS ELASTICIDADES) FROM calendar""")
def e02(spark, d):
    return rounded(E.forward_calendar(elasticities(spark, d)), "ELASTICIDADES", digits=8)


_GRID = ["precio_unitario", "ingreso_real", "CAPACIDAD_ASIENTOS_TRAMO", "DIAS_ANTICIPACION",
         "HORAS_ANTICIPACION", "OCUPACION_TRAMO"]


@entry("a21_demand_grid", f"""
SELECT * REPLACE ({", ".join(f"round({c}, 5) AS {c}" for c in _GRID)}) FROM grid""")
def a21(spark, d):
    df = E.demand_grid(tickets(spark, d), ["ORIGEN_DESTINO"])
    return rounded(longs(df, "mes", "dia", "hora"), *_GRID, digits=5)


_CORRS = ", ".join(
    f"('{c}', (SELECT corr({c}, demanda_real) FROM grid))" for c in (
        "mes", "dia", "hora", "BOLETOS_VEND", *_GRID))


@entry("a29_predictor_ranking", f"""
SELECT row_number() OVER (ORDER BY v DESC, k) AS pos, k AS variable, round(v, 8) AS corr
FROM (VALUES {_CORRS}) t(k, v) WHERE v IS NOT NULL AND NOT isnan(v)""")
def a29(spark, d):
    grid = E.demand_grid(tickets(spark, d), ["ORIGEN_DESTINO"])
    return rounded(longs(E.top_predictors(grid, k=10), "pos"), "corr", digits=8)


@entry("o02_top_columns", f"""
SELECT row_number() OVER (ORDER BY v DESC, k) AS pos, k AS variable
FROM (VALUES {_CORRS}) t(k, v) WHERE v IS NOT NULL AND NOT isnan(v)
QUALIFY row_number() OVER (ORDER BY v DESC, k) <= 3""")
def o02(spark, d):
    grid = E.demand_grid(tickets(spark, d), ["ORIGEN_DESTINO"])
    return longs(E.top_predictors(grid), "pos").select("pos", "variable")


@entry("e03_semilog_elasticity")
def e03(spark, d):
    """Semi-log elasticity of each route."""
    grid = E.demand_grid(tickets(spark, d), ["ORIGEN_DESTINO"])
    return rounded(E.semilog_elasticity(grid, ["ORIGEN_DESTINO"]), "elasticidad", "r2_adj")


def days(spark, d):
    """The daily base, stored: every adjustment reads it, the deflators twice."""
    return stored("daily_base", lambda s, x: E.daily_base(tickets(s, x)), spark, d)


def _two_slopes(name: str, deflator: str, by: str) -> None:
    """SQL of the price and lead-time slopes beside weekday effects (and a whole model for each
    value of ``by``): the effects drop out when every column is taken less its weekday mean."""
    oracle.define(name, f"""
WITH logs AS (
  SELECT {by} AS g, NOMBRE_DIA_CORRIDA AS w, ln(1 + Tot_Boletos) AS q,
    ln(1 + Costo_Prom_Boleto / deflator) AS p, ln(1 + Dias_Anticip) AS a
  FROM days LEFT JOIN {deflator} USING (ANIO)
  WHERE Costo_Prom_Boleto / deflator > 0 AND Dias_Anticip > -1
), free AS (
  SELECT g, q - avg(q) OVER gw AS q, p - avg(p) OVER gw AS p, a - avg(a) OVER gw AS a,
    q - avg(q) OVER (PARTITION BY g) AS whole, w
  FROM logs WINDOW gw AS (PARTITION BY g, w)
), sums AS (
  SELECT g, count(*) AS n, count(DISTINCT w) + 2 AS rank, sum(p * p) AS pp, sum(a * a) AS aa,
    sum(p * a) AS pa, sum(p * q) AS pq, sum(a * q) AS aq, sum(whole * whole) AS total
  FROM free GROUP BY g
), slopes AS (
  SELECT *, pp * aa - pa * pa AS det, (aa * pq - pa * aq) / (pp * aa - pa * pa) AS bp,
    (pp * aq - pa * pq) / (pp * aa - pa * pa) AS ba FROM sums
), meat AS (
  SELECT g, sum(e * e) AS rest, sum(e * e * p * p) AS mpp, sum(e * e * p * a) AS mpa,
    sum(e * e * a * a) AS maa
  FROM (SELECT f.*, f.q - bp * f.p - ba * f.a AS e
        FROM free f JOIN slopes s ON f.g IS NOT DISTINCT FROM s.g) GROUP BY g
)
SELECT s.g, n, bp, ba, rest, sqrt(aa / det * rest / (n - rank)) AS se_p,
  sqrt(pp / det * rest / (n - rank)) AS se_a,
  sqrt((aa * aa * mpp - 2 * aa * pa * mpa + pa * pa * maa) / det / det * n / (n - rank)) AS hc_p,
  sqrt((pa * pa * mpp - 2 * pp * pa * mpa + pp * pp * maa) / det / det * n / (n - rank)) AS hc_a,
  1 - rest / total * (n - 1) / (n - rank) AS r2_adj
FROM slopes s JOIN meat m ON s.g IS NOT DISTINCT FROM m.g""")


_two_slopes("slopes_fare", "fare_defl", "NULL::INTEGER")
_two_slopes("slopes_stable", "stable_defl", "NULL::INTEGER")
_two_slopes("slopes_by_year", "fare_defl", "ANIO")
_ERRORS = ["elasticidad", "error", "error_robusto", "R2_ajustado"]
_FOUND = """bp, 6) AS elasticidad, round(se_p, 6) AS error, round(hc_p, 6) AS error_robusto,
  round(r2_adj, 6) AS R2_ajustado, n"""


@entry("e04_loglog_fit")
def e04(spark, d):
    """All terms of the log-log model with weekday controls, with both kinds of errors."""
    design, names = E.loglog_design(E.adjusted_days(days(spark, d), "tarifa_base", BASE_YEAR))
    return rounded(E.ols(design, "ln_Q", names, robust=True), "coef", "std_err", "ci_low",
                   "ci_high", "std_err_robust", "r2", "r2_adj")


@entry("e04_price_and_lead", """
SELECT 'ln_P' AS term, round(bp, 6) AS coef, round(se_p, 6) AS std_err,
  round(hc_p, 6) AS std_err_robust, round(r2_adj, 6) AS r2_adj, n FROM slopes_fare
UNION ALL SELECT 'ln_Anticip', round(ba, 6), round(se_a, 6), round(hc_a, 6), round(r2_adj, 6), n
FROM slopes_fare""")
def e04_slopes(spark, d):
    """Slopes of the same model, and their errors."""
    return e04(spark, d).where(F.col("term").isin("ln_P", "ln_Anticip")).select(
        "term", "coef", "std_err", "std_err_robust", "r2_adj", "n")


@entry("e05_price_elasticity")
def e05(spark, d):
    """Global elasticity under those of the three inflation adjustments the days allow."""
    found = [E.price_elasticity(days(spark, d), m, BASE_YEAR, by_year=False, strict=False)
             for m in ("year_fe", "tarifa_base", "interno")]
    return rounded(found[0].unionByName(found[1]).unionByName(found[2]), "ci_low", "ci_high",
                   *_ERRORS)


@entry("e05_deflated_elasticity", f"""
SELECT 'tarifa_base' AS metodo, round({_FOUND} FROM slopes_fare
UNION ALL SELECT 'interno', round({_FOUND} FROM slopes_stable""")
def e05_deflated(spark, d):
    """Global elasticity at the prices of the two deflators, with both kinds of errors."""
    fare, stable = (E.price_elasticity(days(spark, d), m, BASE_YEAR, by_year=False, strict=False)
                    for m in ("tarifa_base", "interno"))
    return rounded(fare.unionByName(stable).drop("ANIO", "ci_low", "ci_high"), *_ERRORS)


@entry("e06_elasticity_by_year", f"""
SELECT 'tarifa_base' AS metodo, CAST(g AS INTEGER) AS ANIO, round({_FOUND}
FROM slopes_by_year""")
def e06(spark, d):
    """Elasticity of each year, with both kinds of errors."""
    found = E.price_elasticity(days(spark, d), "tarifa_base", BASE_YEAR)
    return rounded(found.where(F.col("ANIO").isNotNull()).drop("ci_low", "ci_high"), *_ERRORS)


_CURVE = """
SELECT ORIGEN_DESTINO, i AS punto, 100 + i * (900 / 99.0::DOUBLE) AS precio,
  (100 + i * (900 / 99.0::DOUBLE)) * q0 * pow((100 + i * (900 / 99.0::DOUBLE)) / p0, -1.3::DOUBLE)
    AS ingreso
FROM (SELECT ORIGEN_DESTINO, avg(precio_unitario) AS p0, avg(demanda_real) AS q0 FROM grid
      GROUP BY 1), (SELECT unnest(range(0, 100)) AS i)"""


def _curve(spark, d):
    """Revenue curves of the routes for a fixed elasticity of -1.3."""
    grid = E.demand_grid(tickets(spark, d), ["ORIGEN_DESTINO"])
    means = grid.groupBy("ORIGEN_DESTINO").agg(
        F.avg("precio_unitario").alias("p0"), F.avg("demanda_real").alias("Q0"))
    return E.revenue_curve(means.withColumn("e", F.lit(-1.3)))


@entry("e07_revenue_curve", f"""
SELECT ORIGEN_DESTINO, punto, round(precio, 5) AS precio, round(ingreso, 5) AS ingreso
FROM ({_CURVE})""")
def e07(spark, d):
    df = longs(_curve(spark, d).select("ORIGEN_DESTINO", "punto", "precio", "ingreso"), "punto")
    return rounded(df, "precio", "ingreso", digits=5)


@entry("o08_best_price", f"""
SELECT ORIGEN_DESTINO, round(arg_max(precio, ingreso), 7) AS precio_optimo,
  round(max(ingreso), 7) AS ingreso_maximo FROM ({_CURVE}) GROUP BY 1""")
def o08(spark, d):
    return rounded(E.best_price(_curve(spark, d), ["ORIGEN_DESTINO"]), "precio_optimo",
                   "ingreso_maximo", digits=7)


@entry("e08_elasticity_summary")
def e08(spark, d):
    """The summary of each route."""
    df = E.elasticity_summary(tickets(spark, d), group=["ORIGEN_DESTINO"])
    return rounded(df, "elasticidad", "precio_actual", "demanda_promedio", "precio_optimo",
                   "ingreso_maximo")


_DAYS = ["Prom_Ocupacion", "Dias_Anticip", "Tarif_Base_Tramo", "Costo_Prom_Boleto"]


@entry("a22_daily_base", f"""
SELECT * REPLACE ({", ".join(f"round({c}, 6) AS {c}" for c in _DAYS)},
  round(Dif_Tarifa, 8) AS Dif_Tarifa, round(Tot_Venta, 2) AS Tot_Venta) FROM days""")
def a22(spark, d):
    df = longs(E.daily_base(tickets(spark, d)), "ANIO")
    df = rounded(rounded(df, *_DAYS), "Dif_Tarifa", digits=8)
    return rounded(df, "Tot_Venta", digits=2)


@entry("a23_fare_deflator", "SELECT ANIO, round(deflator, 8) AS deflator FROM fare_defl")
def a23(spark, d):
    df = E.fare_deflator(days(spark, d), BASE_YEAR)
    return rounded(longs(df, "ANIO"), "deflator", digits=8)


@entry("a24_stable_deflator", "SELECT ANIO, round(deflator, 8) AS deflator FROM stable_defl")
def a24(spark, d):
    df = E.stable_deflator(days(spark, d), BASE_YEAR)
    return rounded(longs(df, "ANIO"), "deflator", digits=8)


@entry("j12_deflated_days", """
SELECT FECHA_OPERACION, ANIO, NOMBRE_DIA_CORRIDA, round(deflator, 8) AS deflator,
  round(Costo_Prom_Boleto / deflator, 5) AS PRECIO_AJUST
FROM days LEFT JOIN fare_defl USING (ANIO)""")
def j12(spark, d):
    df = E.adjusted_days(days(spark, d), "tarifa_base", BASE_YEAR).select(
        "FECHA_OPERACION", "ANIO", "NOMBRE_DIA_CORRIDA", "deflator", "PRECIO_AJUST")
    return rounded(rounded(longs(df, "ANIO"), "deflator", digits=8), "PRECIO_AJUST", digits=5)


@entry("e09_loglog_slope", """
SELECT ANIO, round(regr_slope(q, p), 7) AS elasticidad, round(regr_intercept(q, p), 7) AS intercepto,
  round(regr_r2(q, p), 7) AS R2
FROM (SELECT ANIO, ln(1 + Tot_Boletos) AS q, ln(1 + Costo_Prom_Boleto) AS p FROM days) GROUP BY 1""")
def e09(spark, d):
    df = E.loglog_slope(days(spark, d))
    return rounded(longs(df, "ANIO"), "elasticidad", "intercepto", "R2", digits=7)
