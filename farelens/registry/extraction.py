"""Sources, sinks, extracts and projections."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelens import bindings as B
from farelens import schemas
from farelens.functions.fixed import GOOD_HOURS, GOOD_MONTHS, GOOD_SEATS, GOOD_WEEKDAYS
from farelens.registry.base import (
    entry, extracted_loyalty, extracted_sales, extracted_trips, loyalty, money,
    rounded, sales, settled, trips, with_trips,
)
from farelens.session import scratch_path
from farelens.sources import extracts, projections as P, readers

_LINES = T.StructType([
    T.StructField("l_orderkey", T.LongType()), T.StructField("l_linenumber", T.IntegerType()),
    T.StructField("l_shipdate", T.TimestampNTZType()),
])


@entry("s01_read_model", """
SELECT l_orderkey, count(*) AS n, max(l_linenumber) AS last_line
FROM lineitem WHERE l_shipdate >= TIMESTAMP '2000-01-01' GROUP BY 1""")
def s01(spark, d):
    """Open a source under a declared schema, register it and query it with SQL."""
    readers.read_model(spark, f"{d}/lineitem.parquet", _LINES, view="fl_lines")
    return spark.sql("""
        SELECT l_orderkey, count(*) AS n, max(l_linenumber) AS last_line
        FROM fl_lines WHERE l_shipdate >= TIMESTAMP_NTZ '2000-01-01' GROUP BY l_orderkey""")


@entry("s03_route_list", """
SELECT OPERACION, TRANSACCION, NUM_ASIENTO, ORIGEN, DESTINO FROM sales""")
def s03(spark, d):
    """Routes kept in a CSV file select the sales that count."""
    path = scratch_path(spark, "routes")
    found = extracts.extract_sales(B.sales_raw(spark, d), B.ROUTES, B.YEAR_FROM)
    pairs = spark.createDataFrame(B.ROUTES, "ORIGEN string, DESTINO string")
    readers.write_table(pairs, path, "csv")
    return extracts.for_routes(found, readers.read_routes(spark, path)).select(
        "OPERACION", "TRANSACCION", "NUM_ASIENTO", "ORIGEN", "DESTINO")


@entry("s04_customer_file", """
SELECT EMAIL, CAST(count(*) % 5 AS INTEGER) AS "Cluster" FROM loyalty
WHERE EMAIL IS NOT NULL GROUP BY 1""")
def s04(spark, d):
    """Clustered customers written as CSV and read back under their schema."""
    path = scratch_path(spark, "customers")
    known = loyalty(spark, d).where(F.col("EMAIL").isNotNull()).groupBy("EMAIL").agg(
        (F.count(F.lit(1)) % 5).cast("int").alias("Cluster"))
    readers.write_table(known, path, "csv")
    return readers.read_customers(spark, path, "csv")


@entry("s05_calendar_file", """
SELECT ORIGEN || '-' || DESTINO AS ORIGEN_DESTINO, FECHA_CORRIDA,
  round(avg(PAX_SUBEN), 6) AS ELASTICIDADES FROM trips GROUP BY ALL""")
def s05(spark, d):
    """A calendar kept as CSV with day-first dates."""
    path = scratch_path(spark, "calendar")
    days = trips(spark, d).groupBy(
        F.concat("ORIGEN", F.lit("-"), "DESTINO").alias("ORIGEN_DESTINO"), "FECHA_CORRIDA",
    ).agg(F.round(F.avg("PAX_SUBEN"), 6).alias("ELASTICIDADES"))
    text = days.withColumn("FECHA_CORRIDA", F.date_format("FECHA_CORRIDA", "dd/MM/yyyy"))
    readers.write_table(text, path, "csv")
    return readers.read_calendar(spark, path, "csv", day_first=True)


_SEAT_ROWS = ", ".join(
    f"({cap}, {seat})" for cap, seats in GOOD_SEATS.items() for seat in seats)


@entry("s06_rule_file", f"""
SELECT CAPACIDAD_ASIENTOS_TRAMO, NUM_ASIENTO, count(*) AS BOLETOS
FROM sales_legs JOIN (VALUES {_SEAT_ROWS}) g(CAPACIDAD_ASIENTOS_TRAMO, NUM_ASIENTO)
  USING (CAPACIDAD_ASIENTOS_TRAMO, NUM_ASIENTO)
GROUP BY ALL""")
def s06(spark, d):
    """Good seats read from a JSON rule file and counted among the tickets."""
    path = scratch_path(spark, "rules")
    rules = spark.createDataFrame([(
        GOOD_MONTHS, GOOD_HOURS, GOOD_WEEKDAYS,
        {str(cap): seats for cap, seats in GOOD_SEATS.items()})], schemas.RULES)
    readers.write_table(rules, path, "json")
    seats = with_trips(spark, d).rows().select("CAPACIDAD_ASIENTOS_TRAMO", "NUM_ASIENTO")
    good = readers.seat_rules(readers.read_rules(spark, path))
    return seats.join(good, ["CAPACIDAD_ASIENTOS_TRAMO", "NUM_ASIENTO"]).groupBy(
        "CAPACIDAD_ASIENTOS_TRAMO", "NUM_ASIENTO").agg(F.count(F.lit(1)).alias("BOLETOS"))


@entry("s07_csv_sink", """
SELECT ORIGEN, DESTINO, FECHA_CORRIDA, CAST(count(*) AS BIGINT) AS n FROM sales GROUP BY ALL""")
def s07(spark, d):
    """A result written as CSV and read back."""
    path = scratch_path(spark, "sink-csv")
    readers.write_table(sales(spark, d).groupBy("ORIGEN", "DESTINO", "FECHA_CORRIDA").agg(
        F.count(F.lit(1)).alias("n")), path, "csv")
    schema = "ORIGEN string, DESTINO string, FECHA_CORRIDA date, n long"
    return spark.read.schema(schema).option("header", True).csv(path)


@entry("s08_partitioned_sink", """
SELECT year(FECHA_CORRIDA) AS ANIO, FECHA_CORRIDA, ORIGEN || '-' || DESTINO AS ORIGEN_DESTINO,
  round(sum(VENTA), 2) AS VENTA
FROM sales WHERE year(FECHA_CORRIDA) = 1999 GROUP BY ALL""")
def s08(spark, d):
    """A report table partitioned by travel year; reading one year prunes the others."""
    path = scratch_path(spark, "sink-parquet")
    report = sales(spark, d).groupBy(
        F.year("FECHA_CORRIDA").alias("ANIO"), "FECHA_CORRIDA",
        F.concat("ORIGEN", F.lit("-"), "DESTINO").alias("ORIGEN_DESTINO"),
    ).agg(F.round(F.sum("VENTA"), 2).alias("VENTA"))
    readers.write_table(report.hint("rebalance", "ANIO"), path, "parquet", ["ANIO"])
    return spark.read.parquet(path).where(F.col("ANIO") == 1999)


@entry("q01_sales_extract", """
SELECT * REPLACE (round(VENTA, 4) AS VENTA) FROM sales""")
def q01(spark, d):
    return rounded(extracted_sales(spark, d), "VENTA", digits=4).select(*schemas.SALES.names)


@entry("s10_route_parameters", f"""
SELECT OPERACION, TRANSACCION, NUM_ASIENTO, ORIGEN, DESTINO FROM (
  SELECT l_orderkey AS OPERACION, TRANSACCION, CAST(l_quantity AS INTEGER) AS NUM_ASIENTO,
    ORIGEN, DESTINO FROM star
  WHERE ORIGEN IN ('AFRICA', 'ASIA') AND DESTINO IN ('EUROPE', 'AFRICA')
    AND l_suppkey % 7 <> 6 AND year(FECHA_OPERACION) >= 1997)""")
def s10(spark, d):
    """The two end lists let through their cross product; pairs are matched later."""
    routes = [("AFRICA", "EUROPE"), ("ASIA", "AFRICA")]
    return extracts.extract_sales(B.sales_raw(spark, d), routes, "1997").select(
        "OPERACION", "TRANSACCION", "NUM_ASIENTO", "ORIGEN", "DESTINO")


@entry("q02_trip_extract", "SELECT * FROM trips")
def q02(spark, d):
    return extracted_trips(spark, d)


@entry("q03_loyalty_extract", "SELECT * FROM loyalty")
def q03(spark, d):
    return extracted_loyalty(spark, d)


@entry("q04_contact_extract", f"""
SELECT o.l_orderkey AS OPERACION,
  '55' || lpad(CAST(o.c_custkey AS VARCHAR), 8, '0') AS TEL_PASAJERO,
  c.mail AS CORREO_ELECTRONICO, c.member AS MEMBRESIA_CRM, o.ORIGEN, o.DESTINO,
  o.FECHA_OPERACION, lpad(CAST(o.l_orderkey % 24 AS VARCHAR), 2, '0') || ':00:00' AS HORA_OPERACION
FROM star o LEFT JOIN (
  SELECT l_orderkey, TRANSACCION,
    CASE WHEN l_orderkey % 5 <> 0 THEN lower(replace(c_name, '#', '.')) END AS mail,
    CASE WHEN c_custkey % 2 = 0 THEN CAST(c_custkey AS VARCHAR) END AS member
  FROM star WHERE l_partkey % 3 <> 0) c
  ON o.l_orderkey = c.l_orderkey AND o.TRANSACCION = c.TRANSACCION
WHERE o.FECHA_CORRIDA >= DATE '1996-01-01' AND o.l_linenumber % 2 = 0 AND o.l_suppkey % 7 <> 6
  AND o.ORIGEN IN ({", ".join(f"'{o}'" for o, _ in B.ROUTES)})
  AND o.DESTINO IN ({", ".join(f"'{x}'" for _, x in B.ROUTES)})""")
def q04(spark, d):
    return extracts.extract_contacts(
        B.operations_raw(spark, d), B.complements_raw(spark, d), B.ROUTES, "1996-01-01")


_OCC = """
  CAST(sum(l_linenumber * 8) AS BIGINT) AS OCUPACION, count(*) AS CORRIDAS,
  round(sum((100 + p_size * 10) * l_linenumber * 8)::DOUBLE /
        sum((100 + p_size * 10) * (24 + 3 * (l_suppkey % 5)))::DOUBLE, 8) AS FOP"""
_OCC_KEYS = """
  CASE WHEN l_partkey % 11 <> 0 THEN 'E' || CAST(l_partkey % 4 AS VARCHAR) END AS EMPRESA,
  CAST(year(FECHA_CORRIDA) AS VARCHAR) AS ANIO, strftime(FECHA_CORRIDA, '%Y-%m') AS ANIO_MES,
  FECHA_CORRIDA AS FECHA"""
_INCOME = "sum(floor(l_extendedprice / 50 * 100 + 0.5) / 100)"
_KM_TOTAL = "sum(100 + p_size * 10 + l_linenumber * 50)::DOUBLE"
_YEARS = f"year(FECHA_CORRIDA) >= {B.YEAR_FROM}"


@entry("q05_daily_occupancy", f"""
SELECT {_OCC_KEYS}, {_OCC} FROM star
WHERE {_YEARS} AND l_partkey % 11 <> 0 AND l_partkey % 4 IN (0, 2) GROUP BY ALL""")
def q05(spark, d):
    return rounded(P.daily_occupancy(
        B.occupancy_raw(spark, d), ["E0", "E2"], B.YEAR_FROM), "FOP", digits=8)


@entry("q06_daily_occupancy_income", f"""
SELECT {_OCC_KEYS}, {_OCC}, 
  floor(sum(CAST(floor(l_extendedprice / 50 * 100 + 0.5) / 100 AS DECIMAL(18, 2)))::DOUBLE
        / {_KM_TOTAL} * 1e6 + 0.5::DOUBLE) / 1e6 AS FIK
FROM star WHERE {_YEARS} GROUP BY ALL""")
def q06(spark, d):
    df = P.daily_occupancy_income(money(B.occupancy_raw(spark, d), "INGRESOS"), B.YEAR_FROM)
    return settled(rounded(df, "FOP", digits=8), "FIK")


_BRANCH = """
  CAST(year(FECHA_OPERACION) AS VARCHAR) AS ANIO, FECHA_OPERACION AS FECHA,
  CASE l_suppkey % 3 WHEN 0 THEN 'BOLETOS' ELSE 'PACK' END AS TIPO_OPERACION,
  round(sum(VENTA_BRUTA), 2) AS VENTA, count(*) AS BOLETOS
FROM star WHERE l_suppkey % 3 <> 2 AND year(FECHA_OPERACION) >= 1996"""


@entry("q07_daily_branch_sales", f"SELECT {_BRANCH} AND l_partkey % 4 IN (1, 3) GROUP BY ALL")
def q07(spark, d):
    return rounded(P.daily_branch_sales(
        B.branch_raw(spark, d), ["E1", "E3"], B.YEAR_FROM), "VENTA", digits=2)


@entry("q08_daily_company_sales", f"""
SELECT 'E1' AS EMPRESA, {_BRANCH} AND l_partkey % 4 = 1 GROUP BY ALL""")
def q08(spark, d):
    return rounded(P.daily_company_sales(
        B.branch_raw(spark, d), "E1", B.YEAR_FROM), "VENTA", digits=2)


@entry("q09_daily_income", f"""
SELECT {_OCC_KEYS}, round({_INCOME}, 2) AS INGRESO, {_KM_TOTAL} AS KMS,
  CAST(sum(l_linenumber) AS BIGINT) AS PAX
FROM star WHERE {_YEARS} GROUP BY ALL""")
def q09(spark, d):
    return rounded(P.daily_income(B.occupancy_raw(spark, d), B.YEAR_FROM), "INGRESO", digits=2)


_ACCOUNT_KEYS = """
  CAST(year(FECHA_CORRIDA) AS VARCHAR) AS ANIO, strftime(FECHA_CORRIDA, '%Y-%m') AS ANIO_MES,
  FECHA_CORRIDA AS FECHA, round(sum(VENTA_BRUTA), 2) AS INGRESO,
  sum(100 + p_size * 10)::DOUBLE AS KMS, count(*) AS PAX"""


@entry("q10_accounting_income", f"""
SELECT 'AME' AS EMPRESA, {_ACCOUNT_KEYS} FROM star WHERE {_YEARS} GROUP BY ALL""")
def q10(spark, d):
    return rounded(P.accounting_income(
        B.accounting_raw(spark, d), "AME", B.YEAR_FROM), "INGRESO", digits=2)


@entry("q11_accounting_channels", f"""
SELECT 'E' || CAST(l_partkey % 4 AS VARCHAR) AS EMPRESA, {_ACCOUNT_KEYS},
  count(*) AS VIAJES,
  round(sum(CASE WHEN l_orderkey % 6 IN (0, 1, 2) THEN VENTA_BRUTA ELSE 0 END), 2) AS ING_TAQ,
  round(CASE WHEN year(FECHA_CORRIDA) < 1999 AND count(*) FILTER (l_orderkey % 6 = 5) = 0
    THEN NULL ELSE sum(CASE WHEN l_orderkey % 6 IN (3, 4, 5) THEN VENTA_BRUTA ELSE 0 END) END, 2)
    AS ING_ABO,
  floor(sum(CAST(VENTA_BRUTA AS DECIMAL(18, 2)))::DOUBLE / sum(100 + p_size * 10)::DOUBLE * 1e6
        + 0.5::DOUBLE) / 1e6 AS FIK
FROM star WHERE {_YEARS} GROUP BY EMPRESA, FECHA_CORRIDA""")
def q11(spark, d):
    df = P.accounting_channels(money(B.accounting_raw(spark, d), "IMPORTE"), B.YEAR_FROM)
    df = df.withColumn("INGRESO", F.col("INGRESO").cast("double"))
    return settled(rounded(df, "ING_TAQ", "ING_ABO", "INGRESO", digits=2), "FIK")


@entry("q12_budget_by_kind", """
SELECT FECHA_OPERACION AS FECHA, CASE l_suppkey % 2 WHEN 0 THEN 'BOLETOS' ELSE 'PACK' END
    AS TIPO_OPERACION, round(sum(VENTA_BRUTA), 2) AS PTTO, count(*) AS PTTO_PAX,
  CAST(sum(p_size * 30) AS BIGINT) AS PTTO_KM, CAST(sum(p_size * 30) AS BIGINT) AS PTTO_SERVICIOS
FROM star WHERE l_partkey % 4 <> 3 GROUP BY ALL""")
def q12(spark, d):
    return rounded(P.budget_by_kind(
        B.budget_raw(spark, d), ["E0", "E1", "E2"]), "PTTO", digits=2)


@entry("q13_budget_by_company", """
SELECT 'E' || CAST(l_partkey % 4 AS VARCHAR) AS EMPRESA, FECHA_OPERACION AS FECHA,
  CASE l_suppkey % 2 WHEN 0 THEN 'BOLETOS' ELSE 'PACK' END AS TIPO_OPERACION,
  round(sum(p_retailprice), 2) AS PTTO, CAST(sum(l_linenumber) AS BIGINT) AS PTTO_PAX,
  sum(100 + p_size * 10)::DOUBLE AS PTTO_KM, count(*) AS PTTO_SERVICIOS
FROM star GROUP BY ALL""")
def q13(spark, d):
    return rounded(P.budget_by_company(B.budget_raw(spark, d)), "PTTO", digits=2)
