"""Projections, filters, cleaning, the base joins and the data sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from farelens import bindings as B
from farelens import schemas
from farelens.functions.columns import (
    clock_hour, deck_class, lookup, parse_date, route_key, safe_div, to_number,
)
from farelens.functions.fixed import CLUSTER_UPLIFT, PASSENGER_DISCOUNT
from farelens.operators import prep
from farelens.plans import datasets as S
from farelens.registry import oracle
from farelens.registry.base import (
    by_route_day, combined, entry, loyalty, rounded, sales, tickets, trips, with_loyalty,
    with_trips,
)
from farelens.sources import extracts

ID = ["OPERACION", "TRANSACCION", "NUM_ASIENTO", "CV_ASIGN"]
_ID = "OPERACION, TRANSACCION, NUM_ASIENTO, CV_ASIGN"
_DISCOUNTS = ", ".join(f"('{k}', {v})" for k, v in PASSENGER_DISCOUNT.items())
_UPLIFTS = ", ".join(f"({k}, {v})" for k, v in CLUSTER_UPLIFT.items())

oracle.define("fare_sold", "SELECT * FROM tickets WHERE VENTA > 0 AND BOLETOS_VEND > 0")
oracle.define("cust_sold", """
SELECT * REPLACE (abs(HORAS_ANTICIPACION) AS HORAS_ANTICIPACION,
  abs(DIAS_ANTICIPACION) AS DIAS_ANTICIPACION)
FROM tickets WHERE VENTA_TOTAL > 0 AND BOLETOS_VEND > 0""")
for _kind, _where in (
    ("train", "FECHA_OPERACION <= (SELECT max(FECHA_OPERACION) - 101 FROM cust_sold)"),
    ("score", "FECHA_OPERACION >= (SELECT max(FECHA_OPERACION) - 100 FROM cust_sold)"),
):
    oracle.define(f"cust_{_kind}_window", f"""
SELECT * REPLACE (coalesce(PORCENT_PROMO, 0) AS PORCENT_PROMO) FROM cust_sold WHERE {_where}""")
    oracle.define(f"cust_{_kind}_known", f"""
SELECT NOMBRE_PASAJERO, first(EMAIL ORDER BY FECHA_OPERACION, OPERACION, TRANSACCION,
  NUM_ASIENTO, EMAIL) AS EMAIL_KNOWN
FROM cust_{_kind}_window WHERE EMAIL IS NOT NULL GROUP BY 1""")
    oracle.define(f"cust_{_kind}", f"""
SELECT w.* REPLACE (
  coalesce(EMAIL, EMAIL_KNOWN, replace(lower(w.NOMBRE_PASAJERO), ' ', '.') || '@ejemplo.com')
    AS EMAIL,
  CASE WHEN PORCENT_PROMO > 0 AND DESC_DESCUENTO = 'ADULTO' THEN 'PROMOCION ESPECIAL'
       WHEN PORCENT_PROMO = 0 AND DESC_DESCUENTO = 'PROMOCION ESPECIAL' THEN 'ADULTO'
       ELSE DESC_DESCUENTO END AS DESC_DESCUENTO)
FROM cust_{_kind}_window w LEFT JOIN cust_{_kind}_known k
  ON w.NOMBRE_PASAJERO IS NOT DISTINCT FROM k.NOMBRE_PASAJERO""")
for _kind, _where in (
    ("train", """TIPO_PASAJERO = 'AD' AND FECHA_OPERACION <=
  (SELECT max(FECHA_OPERACION) - 101 FROM fare_sold WHERE TIPO_PASAJERO = 'AD')"""),
    ("score", "FECHA_OPERACION >= (SELECT max(FECHA_OPERACION) - 100 FROM fare_sold)"),
):
    oracle.define(f"fare_{_kind}", f"""
SELECT *, TARIFA_BASE_TRAMO AS TBT,
  (TARIFA_BASE_TRAMO - VENTA) / nullif(TARIFA_BASE_TRAMO, 0) AS DIF_TBT_VENTA,
  CASE WHEN CLASE_SERVICIO ILIKE '%dos pisos%' THEN 'DOS' ELSE 'UNO' END AS TIPO_CLASE
FROM fare_sold WHERE {_where}""")
oracle.define("elas_set", """
SELECT * FROM tickets
WHERE year(FECHA_CORRIDA) = (SELECT max(year(FECHA_CORRIDA)) - 1 FROM tickets)""")


@entry("p01_date_time_parse", """
SELECT OPERACION, TRANSACCION, NUM_ASIENTO, FECHA_OPERACION,
  hour(CAST(HORA_OPERACION AS TIME)) AS HORA_VENTA, FECHA_CORRIDA,
  hour(CAST(HORA_SALIDA_CORRIDA AS TIME)) AS HORA_DECIMAL FROM sales""")
def p01(spark, d):
    """Dates and clock hours read from text."""
    text = sales(spark, d).withColumns({
        c: F.col(c).cast("string") for c in ("FECHA_OPERACION", "FECHA_CORRIDA")})
    return text.select(
        "OPERACION", "TRANSACCION", "NUM_ASIENTO",
        parse_date("FECHA_OPERACION").alias("FECHA_OPERACION"),
        clock_hour("HORA_OPERACION").cast("long").alias("HORA_VENTA"),
        parse_date("FECHA_CORRIDA").alias("FECHA_CORRIDA"),
        clock_hour("HORA_SALIDA_CORRIDA").cast("long").alias("HORA_DECIMAL"))


@entry("p02_type_normalisation", """
SELECT * REPLACE (round(VENTA, 4) AS VENTA) FROM sales""")
def p02(spark, d):
    """A frame of texts cast to the declared sales schema."""
    df = sales(spark, d)
    text = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
    return rounded(schemas.conform(text, schemas.SALES), "VENTA", digits=4)


@entry("p03_derived_measures", f"""
SELECT {_ID}, TOTAL_BOLETOS, round(TOTAL_VENTA, 4) AS TOTAL_VENTA, DIF_TARIF, ANIO, MES,
  DIAS_ANTICIPACION, HORAS_ANTICIPACION, TIEMPO_ANTICIPACION FROM tickets""")
def p03(spark, d):
    df = tickets(spark, d).select(
        *ID, "TOTAL_BOLETOS", "TOTAL_VENTA", "DIF_TARIF", F.col("ANIO").cast("long").alias("ANIO"),
        F.col("MES").cast("long").alias("MES"), "DIAS_ANTICIPACION", "HORAS_ANTICIPACION",
        "TIEMPO_ANTICIPACION")
    return rounded(df, "TOTAL_VENTA", digits=4)


@entry("p04_weekday_label", f"""
SELECT {_ID}, NOMBRE_DIA_OPERACION, NOMBRE_DIA_CORRIDA FROM tickets""")
def p04(spark, d):
    return tickets(spark, d).select(*ID, "NOMBRE_DIA_OPERACION", "NOMBRE_DIA_CORRIDA")


@entry("p05_payment_method", f"SELECT {_ID}, TARJETA, PAGO_METODO FROM joined")
def p05(spark, d):
    found = prep.join_loyalty(
        prep.join_trips(sales(spark, d), prep.collapse_trips(trips(spark, d))),
        loyalty(spark, d), sales(spark, d))
    return prep.payment_method(found).select(*ID, "TARJETA", "PAGO_METODO")


@entry("p06_seat_sanity", f"SELECT {_ID}, CAPACIDAD_ASIENTOS_TRAMO FROM seated")
def p06(spark, d):
    joined = prep.join_trips(sales(spark, d), prep.collapse_trips(trips(spark, d)))
    full = prep.join_loyalty(joined, loyalty(spark, d), sales(spark, d))
    return prep.sane_seats(full, joined).select(*ID, "CAPACIDAD_ASIENTOS_TRAMO")


@entry("p07_capacity_repair", f"SELECT {_ID}, CAPACIDAD_ASIENTOS_TRAMO FROM repaired")
def p07(spark, d):
    return combined(spark, d).select(*ID, "CAPACIDAD_ASIENTOS_TRAMO")


@entry("p08_route_pairs", """
SELECT OPERACION, TRANSACCION, NUM_ASIENTO, ORIGEN, DESTINO FROM sales
WHERE ORIGEN || '-' || DESTINO IN (SELECT ORIGEN || '-' || DESTINO FROM trips
  WHERE CAPACIDAD_ASIENTOS_TRAMO = 36 AND ORIGEN <> 'EUROPE')""")
def p08(spark, d):
    """Pairs kept in another frame; the two IN lists alone would let more through."""
    pairs = trips(spark, d).where(
        (F.col("CAPACIDAD_ASIENTOS_TRAMO") == 36) & (F.col("ORIGEN") != "EUROPE"),
    ).select("ORIGEN", "DESTINO").distinct()
    return extracts.for_routes(sales(spark, d), pairs).select(
        "OPERACION", "TRANSACCION", "NUM_ASIENTO", "ORIGEN", "DESTINO")


@entry("p09_column_subset", """
SELECT OPERACION, TRANSACCION, NUM_ASIENTO, TIPO_CLIENTE, DESC_DESCUENTO FROM sales""")
def p09(spark, d):
    return S.present(sales(spark, d), [
        "OPERACION", "TRANSACCION", "NUM_ASIENTO", "TIPO_CLIENTE", "NO_SUCH_COLUMN",
        "DESC_DESCUENTO"])


@entry("p10_positive_sale", f"SELECT {_ID}, round(VENTA, 4) AS VENTA FROM fare_sold")
def p10(spark, d):
    return rounded(S.sold(tickets(spark, d)).select(*ID, "VENTA"), "VENTA", digits=4)


@entry("p11_passenger_type", f"SELECT {_ID} FROM tickets WHERE TIPO_PASAJERO = 'AD'")
def p11(spark, d):
    return tickets(spark, d).where(F.col("TIPO_PASAJERO") == "AD").select(*ID)


@entry("p12_train_cut", f"""
SELECT {_ID}, FECHA_OPERACION FROM fare_sold
WHERE FECHA_OPERACION <= (SELECT max(FECHA_OPERACION) - 101 FROM fare_sold)""")
def p12(spark, d):
    return S.before_holdout(S.sold(tickets(spark, d))).select(*ID, "FECHA_OPERACION")


@entry("p13_score_window", f"""
SELECT {_ID}, FECHA_OPERACION FROM fare_sold
WHERE FECHA_OPERACION >= (SELECT max(FECHA_OPERACION) - 100 FROM fare_sold)""")
def p13(spark, d):
    return S.in_holdout(S.sold(tickets(spark, d))).select(*ID, "FECHA_OPERACION")


@entry("p14_prior_year", f"SELECT {_ID}, FECHA_CORRIDA FROM elas_set")
def p14(spark, d):
    return S.prior_year(tickets(spark, d)).select(*ID, "FECHA_CORRIDA")


@entry("p15_relative_discount", f"""
SELECT {_ID}, round((TARIFA_BASE_TRAMO - VENTA) / TARIFA_BASE_TRAMO, 8) AS DIF_TBT_VENTA
FROM tickets""")
def p15(spark, d):
    return rounded(S.relative_discount(tickets(spark, d)).select(*ID, "DIF_TBT_VENTA"),
                   "DIF_TBT_VENTA", digits=8)


@entry("p16_deck_class", """
SELECT OPERACION, TRANSACCION, NUM_ASIENTO, CLASE_SERVICIO,
  CASE WHEN CLASE_SERVICIO = 'Large dos pisos' THEN 'DOS' ELSE 'UNO' END AS TIPO_CLASE
FROM sales""")
def p16(spark, d):
    return sales(spark, d).select("OPERACION", "TRANSACCION", "NUM_ASIENTO", "CLASE_SERVICIO",
                                  deck_class().alias("TIPO_CLASE"))


@entry("p17_absolute_lead", f"""
SELECT {_ID}, abs(HORAS_ANTICIPACION) AS HORAS_ANTICIPACION,
  abs(DIAS_ANTICIPACION) AS DIAS_ANTICIPACION FROM tickets""")
def p17(spark, d):
    return S.absolute_lead(tickets(spark, d)).select(
        *ID, "HORAS_ANTICIPACION", "DIAS_ANTICIPACION")


@entry("p18_null_fill", """
SELECT OPERACION, TRANSACCION, NUM_ASIENTO, coalesce(PORCENT_PROMO, 0) AS PORCENT_PROMO
FROM sales""")
def p18(spark, d):
    return S.fill_promo(sales(spark, d)).select(
        "OPERACION", "TRANSACCION", "NUM_ASIENTO", "PORCENT_PROMO")


@entry("p19_known_mail", f"""
SELECT {_ID}, coalesce(EMAIL, EMAIL_KNOWN) AS EMAIL
FROM joined LEFT JOIN (
  SELECT NOMBRE_PASAJERO, first(EMAIL ORDER BY FECHA_OPERACION, OPERACION, TRANSACCION,
    NUM_ASIENTO, EMAIL) AS EMAIL_KNOWN FROM joined WHERE EMAIL IS NOT NULL GROUP BY 1)
  USING (NOMBRE_PASAJERO)""")
def p19(spark, d):
    return S.known_mail(with_loyalty(spark, d), sample=sales(spark, d)).select(*ID, "EMAIL")


@entry("o07_keep_first", """
SELECT NOMBRE_PASAJERO, EMAIL AS EMAIL_KNOWN FROM tickets WHERE EMAIL IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY NOMBRE_PASAJERO
  ORDER BY FECHA_OPERACION, OPERACION, TRANSACCION, NUM_ASIENTO, EMAIL) = 1""")
def o07(spark, d):
    """First mail of each passenger name, in a stated order of rows."""
    return S.known_mails(tickets(spark, d))


@entry("p20_placeholder_mail", """
SELECT OPERACION, TRANSACCION, NUM_ASIENTO,
  replace(lower(NOMBRE_PASAJERO), ' ', '.') || '@ejemplo.com' AS EMAIL FROM sales""")
def p20(spark, d):
    return sales(spark, d).select("OPERACION", "TRANSACCION", "NUM_ASIENTO",
                                  S.placeholder_mail().alias("EMAIL"))


@entry("p21_discount_label", """
SELECT OPERACION, TRANSACCION, NUM_ASIENTO,
  CASE WHEN PORCENT_PROMO > 0 AND DESC_DESCUENTO = 'ADULTO' THEN 'PROMOCION ESPECIAL'
       WHEN PORCENT_PROMO IS NULL AND DESC_DESCUENTO = 'PROMOCION ESPECIAL' THEN 'ADULTO'
       ELSE DESC_DESCUENTO END AS DESC_DESCUENTO
FROM sales""")
def p21(spark, d):
    return S.correct_discount(S.fill_promo(sales(spark, d))).select(
        "OPERACION", "TRANSACCION", "NUM_ASIENTO", "DESC_DESCUENTO")


@entry("p22_route_key", """
SELECT ORIGEN || '-' || DESTINO AS ORIGEN_DESTINO, count(*) AS n FROM sales GROUP BY 1""")
def p22(spark, d):
    return sales(spark, d).groupBy(route_key().alias("ORIGEN_DESTINO")).agg(
        F.count(F.lit(1)).alias("n"))


@entry("p23_passenger_discount", f"""
SELECT OPERACION, TRANSACCION, NUM_ASIENTO, TIPO_PASAJERO, v / 100.0::DOUBLE AS DESCUENTO
FROM sales LEFT JOIN (VALUES {_DISCOUNTS}) t(k, v) ON TIPO_PASAJERO = k""")
def p23(spark, d):
    return sales(spark, d).select(
        "OPERACION", "TRANSACCION", "NUM_ASIENTO", "TIPO_PASAJERO",
        (lookup("TIPO_PASAJERO", PASSENGER_DISCOUNT) / 100).alias("DESCUENTO"))


@entry("p24_cluster_uplift", f"""
SELECT OPERACION, TRANSACCION, NUM_ASIENTO, CAST(OPERACION % 6 AS INTEGER) AS "Cluster",
  v AS "Aumento"
FROM sales LEFT JOIN (VALUES {_UPLIFTS}) t(k, v) ON OPERACION % 6 = k""")
def p24(spark, d):
    """Uplift of a cluster column; a cluster without an uplift gives NULL."""
    df = sales(spark, d).withColumn("Cluster", F.pmod("OPERACION", F.lit(6)).cast("int"))
    return df.select("OPERACION", "TRANSACCION", "NUM_ASIENTO", "Cluster",
                     lookup("Cluster", CLUSTER_UPLIFT).alias("Aumento"))


@entry("p25_rename_drop", """
SELECT MES AS mes, FECHA_CORRIDA, round(avg(TARIFA_BASE_TRAMO), 6) AS precio_unitario
FROM tickets GROUP BY ALL""")
def p25(spark, d):
    """Result columns renamed and helper columns dropped."""
    found = tickets(spark, d).groupBy("MES", "FECHA_CORRIDA").agg(
        F.avg("TARIFA_BASE_TRAMO").alias("TARIFA_BASE_TRAMO"), F.sum("VENTA").alias("aux"))
    named = found.withColumnsRenamed({"TARIFA_BASE_TRAMO": "precio_unitario", "MES": "mes"})
    return rounded(named.drop("aux"), "precio_unitario").withColumn(
        "mes", F.col("mes").cast("long"))


@entry("p26_no_infinities", """
SELECT OPERACION, TRANSACCION, NUM_ASIENTO,
  round(VENTA / nullif(BOLETOS_VEND, 0), 6) AS POR_BOLETO,
  round(VENTA_CANCEL / nullif(VENTA, 0), 6) AS RAZON
FROM sales""")
def p26(spark, d):
    """Quotients with a zero divisor are NULL, never infinite."""
    df = sales(spark, d).select(
        "OPERACION", "TRANSACCION", "NUM_ASIENTO",
        safe_div("VENTA", "BOLETOS_VEND").alias("POR_BOLETO"),
        safe_div("VENTA_CANCEL", "VENTA").alias("RAZON"))
    return rounded(df, "POR_BOLETO", "RAZON")


@entry("p27_numeric_coercion", """
SELECT OPERACION, TRANSACCION, NUM_ASIENTO,
  TRY_CAST(CASE WHEN OPERACION % 3 = 0 THEN 'n/d' ELSE CAST(NUM_ASIENTO AS VARCHAR) END AS DOUBLE)
    AS ASIENTO
FROM sales""")
def p27(spark, d):
    mixed = F.when(F.col("OPERACION") % 3 == 0, "n/d").otherwise(
        F.col("NUM_ASIENTO").cast("string"))
    return sales(spark, d).select("OPERACION", "TRANSACCION", "NUM_ASIENTO",
                                  to_number(mixed).alias("ASIENTO"))


_LEG_ROUND = ["TARIFA_BASE_TRAMO", "IVA_TARIFA_BASE_TRAMO", "INGRESO_TRANSP", "IVA_TRANSP",
              "INGRESO_TEORICO_TRAMO"]
_LEG_REPLACE = ", ".join(f"round({c}, 2) AS {c}" for c in _LEG_ROUND)


@entry("a01_trip_collapse", f"SELECT * REPLACE ({_LEG_REPLACE}) FROM legs")
def a01(spark, d):
    found = by_route_day(spark, d)["trips"].map(prep.collapse_trips).rows()
    return rounded(found, *_LEG_ROUND, digits=2)


@entry("j01_sales_with_trips", f"""
SELECT {_ID}, ORIGEN_CORRIDA, EMPRESA, PAX_SUBEN, round(TARIFA_BASE_TRAMO, 2)
  AS TARIFA_BASE_TRAMO FROM sales_legs""")
def j01(spark, d):
    df = with_trips(spark, d).rows()
    return rounded(df.select(*ID, "ORIGEN_CORRIDA", "EMPRESA", "PAX_SUBEN", "TARIFA_BASE_TRAMO"),
                   "TARIFA_BASE_TRAMO", digits=2)


@entry("j02_with_loyalty", f"SELECT {_ID}, TARJETA, EFECTIVO, EMAIL FROM joined")
def j02(spark, d):
    return with_loyalty(spark, d).select(*ID, "TARJETA", "EFECTIVO", "EMAIL")


_SET = [*ID, "EMAIL", "DESC_DESCUENTO", "PORCENT_PROMO", "DIAS_ANTICIPACION", "ORIGEN_DESTINO"]


@entry("m25_fare_train_set", f"""
SELECT {_ID}, round(DIF_TBT_VENTA, 8) AS DIF_TBT_VENTA, TIPO_CLASE FROM fare_train""")
def m25_fare_train(spark, d):
    df = S.fare_train_set(tickets(spark, d), keep=ID)
    return rounded(df.select(*ID, "DIF_TBT_VENTA", "TIPO_CLASE"), "DIF_TBT_VENTA", digits=8)


@entry("m25_fare_score_set", f"""
SELECT {_ID}, round(DIF_TBT_VENTA, 8) AS DIF_TBT_VENTA, TIPO_CLASE FROM fare_score""")
def m25_fare_score(spark, d):
    df = S.fare_score_set(tickets(spark, d), keep=ID)
    return rounded(df.select(*ID, "DIF_TBT_VENTA", "TIPO_CLASE"), "DIF_TBT_VENTA", digits=8)


@entry("m25_customer_train_set", f"SELECT {', '.join(_SET)} FROM cust_train")
def m25_customer_train(spark, d):
    return S.customer_train_set(tickets(spark, d)).select(*_SET)


@entry("m25_customer_score_set", f"SELECT {', '.join(_SET)} FROM cust_score")
def m25_customer_score(spark, d):
    return S.customer_score_set(tickets(spark, d)).select(*_SET)


@entry("m25_elasticity_set", """
SELECT FECHA_CORRIDA, CV_CORRIDA, ORIGEN, DESTINO, TIPO_PASAJERO, PAX_SUBEN, DISPONIBILIDAD_TRAMO,
  round(INGRESO_TRANSP, 2) AS INGRESO_TRANSP FROM elas_set""")
def m25_elasticity(spark, d):
    df = S.elasticity_set(tickets(spark, d)).select(
        "FECHA_CORRIDA", "CV_CORRIDA", "ORIGEN", "DESTINO", "TIPO_PASAJERO", "PAX_SUBEN",
        "DISPONIBILIDAD_TRAMO", "INGRESO_TRANSP")
    return rounded(df, "INGRESO_TRANSP", digits=2)
