"""Indicators, demand classes and their attachment."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from farelens.operators import classify, kpis
from farelens.plans.demand import CLASSES, attach_classes, classified_indicators
from farelens.registry import oracle
from farelens.registry.base import entry, money, rounded, sales, tickets
from farelens.registry.preparation import ID, _ID
from farelens.sources.stored import stored

YEAR, BAND_YEAR = 1997, 2000

oracle.define("kpi", f"""
SELECT * FROM tickets WHERE ANIO >= {YEAR} AND DIAS_ANTICIPACION >= 0 AND VENTA > 0""")
oracle.define("occ", """
SELECT NOMBRE_DIA_CORRIDA, HORA_DECIMAL, avg(OCUPACION_TRAMO) AS OCUPACION_TRAMO,
  avg(CAPACIDAD_ASIENTOS_TRAMO) AS CAPACIDAD_ASIENTOS_TRAMO,
  avg(OCUPACION_TRAMO) / avg(CAPACIDAD_ASIENTOS_TRAMO) AS FOP_PROM
FROM kpi GROUP BY 1, 2""")
oracle.define("seats", """
SELECT *, PAX_SUBEN / DIAS_VENTA AS PAX_X_DIA_PROM FROM (
  SELECT CAPACIDAD_ASIENTOS_TRAMO, NUM_ASIENTO, count(DISTINCT FECHA_OPERACION) AS DIAS_VENTA,
    CAST(sum(BOLETOS_VEND) AS BIGINT) AS BOLETOS_VEND, sum(VENTA) AS VENTA,
    CAST(sum(PAX_SUBEN) AS BIGINT) AS PAX_SUBEN,
    sum(CAST(VENTA AS DECIMAL(18, 2)))::DOUBLE / count(VENTA) AS VENTA_PROM,
    avg(DIAS_ANTICIPACION) AS VEL_VENTA_PROM, avg(TARIFA_BASE_TRAMO) AS TARIFA_BASE_PROM
  FROM kpi GROUP BY 1, 2)""")
oracle.define("seat_props", """
SELECT *, sum(PAX_X_DIA_PROM) OVER (PARTITION BY CAPACIDAD_ASIENTOS_TRAMO) AS TOTAL_PAX_X_DIA,
  PAX_X_DIA_PROM / sum(PAX_X_DIA_PROM) OVER (PARTITION BY CAPACIDAD_ASIENTOS_TRAMO)
    AS PROP_ASIENTO,
  sum(PAX_X_DIA_PROM) OVER (PARTITION BY CAPACIDAD_ASIENTOS_TRAMO
    ORDER BY PAX_X_DIA_PROM DESC, NUM_ASIENTO ROWS UNBOUNDED PRECEDING)
    / sum(PAX_X_DIA_PROM) OVER (PARTITION BY CAPACIDAD_ASIENTOS_TRAMO) AS PROP_ACUM
FROM seats""")
oracle.define("months", """
SELECT ANIO, MES, CAST(sum(BOLETOS_VEND) AS BIGINT) AS BOLETOS_VEND, sum(VENTA) AS VENTA,
  CAST(sum(PAX_SUBEN) AS BIGINT) AS PAX_SUBEN FROM tickets GROUP BY 1, 2""")
oracle.define("month_rank", """
SELECT MES, score, row_number() OVER (ORDER BY score DESC, MES) - 1 AS r FROM (
  SELECT MES, sum(PAX_SUBEN * w / t) AS score FROM months JOIN (
    SELECT ANIO, 1.0::DOUBLE / row_number() OVER (ORDER BY ANIO DESC) AS w FROM months GROUP BY ANIO)
    USING (ANIO), (SELECT sum(1.0::DOUBLE / i) AS t FROM (
      SELECT unnest(range(1, (SELECT count(DISTINCT ANIO) + 1 FROM months))) AS i))
  GROUP BY MES)""")
oracle.define("month_class", """
SELECT MES, CASE WHEN r <= 3 THEN 'Alto' WHEN r >= 8 THEN 'Bajo' ELSE 'Normal' END AS Clasif_mes
FROM month_rank""")
oracle.define("seat_class", """
SELECT CAPACIDAD_ASIENTOS_TRAMO, NUM_ASIENTO, PROP_ACUM,
  CASE WHEN PROP_ACUM < 0.3 THEN 'Alta' WHEN PROP_ACUM < 0.6 THEN 'Media' ELSE 'Baja' END
    AS Clasif_asiento,
  CASE WHEN PROP_ACUM < 0.3 THEN 1 WHEN PROP_ACUM < 0.6 THEN 2 ELSE 3 END
    AS Clasif_asiento_codigo
FROM seat_props""")
oracle.define("occ_class", """
SELECT NOMBRE_DIA_CORRIDA, HORA_DECIMAL,
  CASE WHEN avg(FOP_PROM) OVER (PARTITION BY NOMBRE_DIA_CORRIDA) >= 0.5 THEN 'Alto' ELSE 'Bajo' END
    AS Clasif_dia_venta,
  CASE WHEN avg(FOP_PROM) OVER (PARTITION BY HORA_DECIMAL) >= 0.5 THEN 'Alto' ELSE 'Bajo' END
    AS Clasif_hora_venta
FROM occ""")


def scope(spark, d):
    return kpis.indicator_scope(tickets(spark, d), "ANIO", YEAR)


def longs(df, *names):
    """Calendar parts as 64-bit numbers, as SQL gives them."""
    return df.withColumns({n: F.col(n).cast("long") for n in names})


@entry("a02_sales_by_day_hour", """
SELECT ORIGEN, DESTINO, ANIO, NOMBRE_DIA_CORRIDA, HORA_DECIMAL,
  CAST(sum(BOLETOS_VEND) AS BIGINT) AS BOLETOS_VEND, round(sum(VENTA), 2) AS VENTA,
  round(avg(OCUPACION_TRAMO), 8) AS OCUPACION_TRAMO,
  max(CAPACIDAD_ASIENTOS_TRAMO) AS CAPACIDAD_ASIENTOS_TRAMO
FROM tickets GROUP BY 1, 2, 3, 4, 5""")
def a02(spark, d):
    df = kpis.sales_by_day_hour(tickets(spark, d))
    return rounded(rounded(longs(df, "ANIO", "HORA_DECIMAL"), "VENTA", digits=2),
                   "OCUPACION_TRAMO", digits=8)


@entry("a03_indicator_scope", f"SELECT {_ID}, ANIO, DIAS_ANTICIPACION FROM kpi")
def a03(spark, d):
    return longs(scope(spark, d).select(*ID, "ANIO", "DIAS_ANTICIPACION"), "ANIO")


@entry("a04_occupancy", """
SELECT * REPLACE (round(OCUPACION_TRAMO, 8) AS OCUPACION_TRAMO, round(FOP_PROM, 8) AS FOP_PROM,
  round(CAPACIDAD_ASIENTOS_TRAMO, 8) AS CAPACIDAD_ASIENTOS_TRAMO) FROM occ""")
def a04(spark, d):
    df = longs(kpis.occupancy(scope(spark, d)), "HORA_DECIMAL")
    return rounded(df, "OCUPACION_TRAMO", "CAPACIDAD_ASIENTOS_TRAMO", "FOP_PROM", digits=8)


@entry("a05_advance_curve", """
SELECT DIAS_ANTICIPACION, CAST(sum(BOLETOS_VEND) AS BIGINT) AS BOLETOS_VEND,
  round(sum(VENTA), 2) AS VENTA, round(median(TARIFA_BASE_TRAMO), 4) AS TARIFA_BASE_TRAMO,
  round(sum(VENTA) / sum(BOLETOS_VEND), 6) AS COSTO_PROM_BOLETO
FROM kpi GROUP BY 1""")
def a05(spark, d):
    df = rounded(kpis.advance_curve(scope(spark, d)), "TARIFA_BASE_TRAMO", digits=4)
    return rounded(rounded(df, "VENTA", digits=2), "COSTO_PROM_BOLETO")


@entry("a06_seat_demand", """
SELECT CAPACIDAD_ASIENTOS_TRAMO, NUM_ASIENTO, DIAS_VENTA, BOLETOS_VEND, PAX_SUBEN,
  round(VENTA, 2) AS VENTA, round(VENTA_PROM, 7) AS VENTA_PROM,
  round(VEL_VENTA_PROM, 7) AS VEL_VENTA_PROM, round(TARIFA_BASE_PROM, 7) AS TARIFA_BASE_PROM,
  round(PAX_X_DIA_PROM, 7) AS PAX_X_DIA_PROM
FROM seats""")
def a06(spark, d):
    # Exact sums: a mean may lie midway between two roundings.
    df = kpis.seat_demand(money(scope(spark, d), "VENTA")).select(
        "CAPACIDAD_ASIENTOS_TRAMO", "NUM_ASIENTO", "DIAS_VENTA", "BOLETOS_VEND", "PAX_SUBEN",
        F.col("VENTA").cast("double").alias("VENTA"), "VENTA_PROM", "VEL_VENTA_PROM",
        "TARIFA_BASE_PROM", "PAX_X_DIA_PROM")
    return rounded(rounded(df, "VENTA", digits=2), "VENTA_PROM", "VEL_VENTA_PROM",
                   "TARIFA_BASE_PROM", "PAX_X_DIA_PROM", digits=7)


@entry("a07_origin_means", """
SELECT ORIGEN, round(avg(BOLETOS_VEND), 8) AS BOLETOS_VEND, round(avg(VENTA), 8) AS VENTA
FROM kpi GROUP BY 1""")
def a07(spark, d):
    return rounded(kpis.origin_means(scope(spark, d)), "BOLETOS_VEND", "VENTA", digits=8)


@entry("a08_monthly", "SELECT * REPLACE (round(VENTA, 2) AS VENTA) FROM months")
def a08(spark, d):
    return rounded(longs(kpis.monthly(tickets(spark, d)), "ANIO", "MES"), "VENTA", digits=2)


@entry("a09_fare_bands", f"""
SELECT b || '-' || (b + 25) AS RANGO_TARIFA, round(coalesce(sum(VENTA_TOTAL), 0), 2) AS VENTA_TOTAL,
  CAST(coalesce(sum(BOLETOS_VEND), 0) AS BIGINT) AS BOLETOS_VEND,
  CAST(coalesce(sum(PAX_SUBEN), 0) AS BIGINT) AS PAX_SUBEN, count(VENTA_TOTAL) AS VECES_OFERTADA,
  round(avg(DIAS_ANTICIPACION), 8) AS DIAS_ANTICIPACION,
  count(DISTINCT FECHA_OPERACION) AS DIAS_UNICOS,
  round(sum(BOLETOS_VEND) / count(DISTINCT FECHA_OPERACION), 8) AS BOLETOS_PROM,
  round(sum(PAX_SUBEN) / count(DISTINCT FECHA_OPERACION), 8) AS PAX_PROM
FROM (SELECT unnest(range(250, 1800, 25)) AS b) LEFT JOIN (
  SELECT * FROM kpi WHERE year(FECHA_OPERACION) >= {BAND_YEAR})
  ON VENTA_TOTAL >= b AND VENTA_TOTAL < b + 25
GROUP BY b""")
def a09(spark, d):
    df = kpis.fare_bands(scope(spark, d), year_from=BAND_YEAR)
    return rounded(rounded(df, "VENTA_TOTAL", digits=2), "DIAS_ANTICIPACION", "BOLETOS_PROM",
                   "PAX_PROM", digits=8)


_HOURS = ", ".join(
    f"round(sum(VENTA) FILTER (HORA_DECIMAL = {h}), 2) AS H{h:02d}" for h in range(24))


@entry("a27_pivot_day_hour", f"""
SELECT ANIO, NOMBRE_DIA_CORRIDA, {_HOURS} FROM tickets GROUP BY 1, 2""")
def a27(spark, d):
    df = kpis.pivot_day_hour(tickets(spark, d), "NOMBRE_DIA_CORRIDA", "HORA_DECIMAL", "VENTA",
                             year="ANIO")
    return rounded(longs(df, "ANIO"), *[f"H{h:02d}" for h in range(24)], digits=2)


@entry("a28_share_by_class", """
SELECT CLASE_SERVICIO, round(sum(VENTA), 2) AS VENTA,
  round(sum(VENTA) * 100 / (SELECT sum(VENTA) FROM tickets), 8) AS PCT
FROM tickets GROUP BY 1""")
def a28(spark, d):
    df = kpis.share(tickets(spark, d), "CLASE_SERVICIO", "VENTA")
    return rounded(rounded(df, "VENTA", digits=2), "PCT", digits=8)


@entry("a30_log_series", """
SELECT DIAS_ANTICIPACION, round(ln(nullif(sum(BOLETOS_VEND), 0)), 8) AS BOLETOS_VEND,
  round(ln(sum(VENTA)), 8) AS VENTA
FROM kpi GROUP BY 1""")
def a30(spark, d):
    curve = kpis.advance_curve(scope(spark, d))
    df = kpis.log_series(curve, "DIAS_ANTICIPACION", "BOLETOS_VEND", "VENTA", ylog=True)
    return rounded(df, "BOLETOS_VEND", "VENTA", digits=8)


@entry("w01_seat_share", """
SELECT CAPACIDAD_ASIENTOS_TRAMO, NUM_ASIENTO, round(TOTAL_PAX_X_DIA, 7) AS TOTAL_PAX_X_DIA,
  round(PROP_ASIENTO, 8) AS PROP_ASIENTO, round(PROP_ASIENTO * 100, 7) AS PROP_ASIENTO_PCT
FROM seat_props""")
def w01(spark, d):
    df = kpis.seat_demand(scope(spark, d)).select(
        "CAPACIDAD_ASIENTOS_TRAMO", "NUM_ASIENTO", "TOTAL_PAX_X_DIA", "PROP_ASIENTO",
        "PROP_ASIENTO_PCT")
    return rounded(rounded(df, "TOTAL_PAX_X_DIA", "PROP_ASIENTO_PCT", digits=7),
                   "PROP_ASIENTO", digits=8)


@entry("w02_running_share", """
SELECT CAPACIDAD_ASIENTOS_TRAMO, NUM_ASIENTO, round(PROP_ACUM, 8) AS PROP_ACUM,
  round(PROP_ACUM * 100, 7) AS PROP_ACUM_PCT FROM seat_props""")
def w02(spark, d):
    df = kpis.seat_demand(scope(spark, d)).select(
        "CAPACIDAD_ASIENTOS_TRAMO", "NUM_ASIENTO", "PROP_ACUM", "PROP_ACUM_PCT")
    return rounded(rounded(df, "PROP_ACUM", digits=8), "PROP_ACUM_PCT", digits=7)


@entry("w03_day_hour_class", "SELECT * FROM occ_class")
def w03(spark, d):
    df = classify.classify_day_hour(kpis.occupancy(scope(spark, d)))
    return longs(df.select("NOMBRE_DIA_CORRIDA", "HORA_DECIMAL", "Clasif_dia_venta",
                           "Clasif_hora_venta"), "HORA_DECIMAL")


@entry("w04_seat_class", "SELECT * EXCLUDE (PROP_ACUM) FROM seat_class")
def w04(spark, d):
    return classify.classify_seats(kpis.seat_demand(scope(spark, d))).select(
        "CAPACIDAD_ASIENTOS_TRAMO", "NUM_ASIENTO", "Clasif_asiento", "Clasif_asiento_codigo")


@entry("w05_month_class", """
SELECT MES, round(score, 6) AS score, Clasif_mes FROM month_rank JOIN month_class USING (MES)""")
def w05(spark, d):
    df = classify.month_classes(kpis.monthly(tickets(spark, d)))
    return rounded(longs(df, "MES"), "score")


@entry("j05_month_class_join", """
SELECT ANIO, MES, PAX_SUBEN, Clasif_mes FROM months LEFT JOIN month_class USING (MES)""")
def j05(spark, d):
    df = classify.classify_months(kpis.monthly(tickets(spark, d)))
    return longs(df.select("ANIO", "MES", "PAX_SUBEN", "Clasif_mes"), "ANIO", "MES")


@entry("j03_attach_class", f"""
SELECT {_ID}, CAPACIDAD_ASIENTOS_TRAMO, Clasif_asiento
FROM tickets LEFT JOIN seat_class USING (CAPACIDAD_ASIENTOS_TRAMO, NUM_ASIENTO)""")
def j03(spark, d):
    """One class attached although its keys come as text."""
    keys = ["CAPACIDAD_ASIENTOS_TRAMO", "NUM_ASIENTO"]
    seats = classify.classify_seats(kpis.seat_demand(scope(spark, d)))
    text = seats.withColumns({k: F.col(k).cast("string") for k in keys})
    df = tickets(spark, d).select(*ID, "CAPACIDAD_ASIENTOS_TRAMO")
    return classify.attach(df, text, keys, ["Clasif_asiento"])


CLASSED = """
FROM tickets LEFT JOIN seat_class USING (CAPACIDAD_ASIENTOS_TRAMO, NUM_ASIENTO)
LEFT JOIN month_class USING (MES)
LEFT JOIN occ_class USING (NOMBRE_DIA_CORRIDA, HORA_DECIMAL)"""


def classified(spark, d):
    """Tickets with all classes; the class tables are stored once per application."""
    tables = {name: stored(f"classes-{name}", lambda s, x, name=name: classified_indicators(
        tickets(s, x), "ANIO", YEAR, BAND_YEAR)[name], spark, d) for name in CLASSES}
    return attach_classes(tickets(spark, d), tables)


@entry("j04_attach_all_classes", f"""
SELECT {_ID}, ANIO, MES, Clasif_asiento, Clasif_mes, Clasif_dia_venta, Clasif_hora_venta
{CLASSED}""")
def j04(spark, d):
    """The whole profile on every ticket, but for the lead-time label of ``m24``."""
    return longs(classified(spark, d).select(
        *ID, "ANIO", "MES", "Clasif_asiento", "Clasif_mes", "Clasif_dia_venta",
        "Clasif_hora_venta"), "ANIO", "MES")


@entry("o01_mixed_sort", """
SELECT CAPACIDAD_ASIENTOS_TRAMO, NUM_ASIENTO, BOLETOS_VEND,
  row_number() OVER (ORDER BY NUM_ASIENTO, BOLETOS_VEND DESC, CAPACIDAD_ASIENTOS_TRAMO) AS pos
FROM seats""")
def o01(spark, d):
    """Seats by number and then by tickets, descending; ``pos`` shows the order."""
    order = [F.col("NUM_ASIENTO"), F.col("BOLETOS_VEND").desc(), F.col("CAPACIDAD_ASIENTOS_TRAMO")]
    seats = kpis.seat_demand(scope(spark, d)).select(
        "CAPACIDAD_ASIENTOS_TRAMO", "NUM_ASIENTO", "BOLETOS_VEND")
    # One row per capacity and seat, so numbering them all in one window is bounded.
    return seats.withColumn("pos", F.row_number().over(Window.orderBy(*order)).cast(
        "long")).orderBy(*order)


@entry("o03_head", """
SELECT OPERACION, TRANSACCION, NUM_ASIENTO, FECHA_OPERACION, NOMBRE_PASAJERO FROM sales
ORDER BY NOMBRE_PASAJERO, FECHA_CORRIDA, HORA_SALIDA_CORRIDA, FECHA_OPERACION, HORA_OPERACION,
  TIPO_PASAJERO, OPERACION, TRANSACCION, NUM_ASIENTO LIMIT 7""")
def o03(spark, d):
    """First seven tickets in a total order."""
    return sales(spark, d).orderBy(
        "NOMBRE_PASAJERO", "FECHA_CORRIDA", "HORA_SALIDA_CORRIDA", "FECHA_OPERACION",
        "HORA_OPERACION", "TIPO_PASAJERO", "OPERACION", "TRANSACCION", "NUM_ASIENTO",
    ).limit(7).select("OPERACION", "TRANSACCION", "NUM_ASIENTO", "FECHA_OPERACION",
                      "NOMBRE_PASAJERO")


@entry("o06_distinct", "SELECT DISTINCT NOMBRE_PASAJERO FROM tickets WHERE EMAIL IS NULL")
def o06(spark, d):
    return tickets(spark, d).where(F.col("EMAIL").isNull()).select("NOMBRE_PASAJERO").distinct()
