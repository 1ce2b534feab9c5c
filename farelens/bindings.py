"""The supplied star schema bound to the source tables of a bus operator.

Every ticket is a line item.  The frames carry the column names of the operator's own
sources, so the extracts run on them unchanged.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from farelens.sources.extracts import for_routes
from farelens.sources.stored import is_stored, stored

# Nine continuous routes out of the 25 region pairs.
ROUTES = [
    ("AFRICA", "AMERICA"), ("AMERICA", "AFRICA"), ("ASIA", "AFRICA"), ("EUROPE", "AFRICA"),
    ("MIDDLE EAST", "ASIA"), ("AFRICA", "EUROPE"), ("AFRICA", "AFRICA"),
    ("EUROPE", "AMERICA"), ("MIDDLE EAST", "EUROPE"),
]
YEAR_FROM = "1996"
BASE_YEAR = 1998
CLIENT_TYPES = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
COMPANIES = ["E0", "E1", "E2", "E3"]

# Lead times: a ticket is sold one day earlier for each of these numbers that its hash (0 to
# 9972) reaches.  Four phases follow each other, each with its share of the tickets, its days
# and the rate by which its sales fall per day.
LEAD_PHASES = [(0.36, 4, 0.5), (0.30, 4, 0.5), (0.30, 10, 0.3), (0.04, 22, 0.1)]


def _lead_steps() -> list[int]:
    steps, done = [], 0.0
    for share, days, rate in LEAD_PHASES:
        weights = [math.exp(-rate * day) for day in range(days)]
        for weight in weights:
            done += share * weight / sum(weights)
            steps.append(round(done * 9973))
    return steps[:-1]


LEAD_STEPS = _lead_steps()

TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}

Source = Callable[[SparkSession, str], DataFrame]
_PLANS: dict[tuple, DataFrame] = {}


def once(build: Source) -> Source:
    """Build each plan once per application; nothing is computed or cached by it."""
    @wraps(build)
    def plan(spark: SparkSession, sf_dir: str) -> DataFrame:
        key = (build.__name__, spark.sparkContext.applicationId, id(spark), sf_dir)
        if key not in _PLANS:
            _PLANS[key] = build(spark, sf_dir)
        return _PLANS[key]
    return plan


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with part and both ends of the route, joined once and stored.

    What a row says by itself is worked out on reading and not stored.
    """
    return worked_out(stored("star", _joined_star, spark, sf_dir, even=False))


def worked_out(star: DataFrame) -> DataFrame:
    return star.selectExpr(
        "*",
        "l_partkey * 10 + l_linenumber AS TRANSACCION",
        "CAST(pmod(l_partkey, 6) AS STRING) AS CV_CORRIDA",
        "lpad(CAST(pmod(l_partkey, 6) * 4 + 1 AS STRING), 2, '0') || ':30:00' AS HORA_PUNTO",
        "floor(l_extendedprice * (1 - l_discount) * (1 + l_tax) / 50 * 100 + 0.5D) / 100 "
        "AS VENTA_BRUTA",
        "floor(l_extendedprice * (1 - l_discount) * l_tax / 50 * 100 + 0.5D) / 100 "
        "AS IVA_BRUTO",
    )


def _joined_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns that the sources are made of.  Orders come first, as they shuffle the line
    items in any case; with suppliers the route is known, so that only rows of routes that are
    asked for, if any are, go on to the parts."""
    ends = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.expr("n_regionkey = r_regionkey"))
    origin = ends.selectExpr("n_nationkey AS s_nationkey", "r_name AS ORIGEN")
    destination = ends.selectExpr("n_nationkey AS c_nationkey", "r_name AS DESTINO")
    suppliers = table(spark, sf_dir, "supplier").join(origin, "s_nationkey")
    customers = table(spark, sf_dir, "customer").join(destination, "c_nationkey")
    orders = table(spark, sf_dir, "orders").join(customers, F.expr("o_custkey = c_custkey"))
    return (
        table(spark, sf_dir, "lineitem")
        .join(orders, F.expr("l_orderkey = o_orderkey"))
        .join(suppliers, F.expr("l_suppkey = s_suppkey"))
        .join(table(spark, sf_dir, "part"), F.expr("l_partkey = p_partkey"))
        .selectExpr(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
            "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "p_brand", "p_type",
            "p_size", "p_retailprice", "o_orderstatus", "o_orderpriority", "c_custkey", "c_name",
            "c_mktsegment", "ORIGEN", "DESTINO",
            "CAST(l_shipdate AS DATE) AS FECHA_CORRIDA",
            f"date_sub(CAST(l_shipdate AS DATE), size(filter(array({', '.join(map(str, LEAD_STEPS))}), "
            "t -> t <= pmod(l_orderkey * 15485863 + l_linenumber * 17, 9973)))) AS FECHA_OPERACION",
        )
    )


def route_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored columns of the line items that the extracts of ``ROUTES`` may take, with one of
    the two years they ask for.

    Where the star is not stored yet, what is asked for reaches the scans below its joins, and
    only these line items are shuffled and stored.
    """
    if is_stored("star", spark, sf_dir):
        return _of_routes(stored("star", _joined_star, spark, sf_dir, even=False))
    return stored("route_lines", lambda s, d: _of_routes(_joined_star(s, d)), spark, sf_dir,
                  even=False)


def _of_routes(star: DataFrame) -> DataFrame:
    # The day of travel first: that of the sale is dear to work out, and is not where it holds.
    return for_routes(star, ROUTES).where(
        f"CAST(year(FECHA_CORRIDA) AS STRING) >= '{YEAR_FROM}' "
        f"OR CAST(year(FECHA_OPERACION) AS STRING) >= '{YEAR_FROM}'")


@once
def sales_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticket sales under their source names."""
    return sales_of(_star(spark, sf_dir))


def sales_of(star: DataFrame) -> DataFrame:
    return star.selectExpr(
        "l_orderkey AS OPERACION",
        "TRANSACCION",
        "FECHA_OPERACION AS FFECHAOPERACION",
        "lpad(CAST(pmod(l_orderkey, 24) AS STRING), 2, '0') || ':' || "
        "lpad(CAST(pmod(l_partkey, 60) AS STRING), 2, '0') || ':00' AS HHORAOPERACION",
        "CAST(weekday(FECHA_OPERACION) AS STRING) AS `NOMBRE DIA`",
        "o_orderstatus AS AREA_VENTA",
        "CASE WHEN p_type = 'LARGE' THEN 'Large dos pisos' WHEN p_type <> 'SMALL' THEN p_type END "
        "AS ANOMBRECLASESERVICIO",
        "ORIGEN", "DESTINO",
        "CV_CORRIDA AS `CLAVE CORRIDA`",
        "FECHA_CORRIDA",
        "HORA_PUNTO AS `H SALIDA BOLETO`",
        "get(array('AD', 'AD', 'AD', 'ES', 'NI', 'PF', 'ZB', 'QQ'), "
        "CAST(pmod(c_custkey, 8) AS INT)) AS `TIPO PASAJERO`",
        "c_mktsegment AS TIPO_CLIENTE",
        "get(array('AM', 'BM', 'CE', 'CS', 'NE', 'NS', 'ZZ'), "
        "CAST(pmod(l_suppkey, 7) AS INT)) AS TIPO_OPERACION",
        "CASE WHEN pmod(l_orderkey, 17) = 0 THEN NULL "
        "WHEN datediff(FECHA_CORRIDA, FECHA_OPERACION) > 30 THEN 'SI' ELSE 'NO' END "
        "AS VENTA_ANTICIPADA",
        "replace(c_name, '#', ' ') AS NOMBRE_PASAJERO",
        "CAST(l_quantity AS INT) AS `NUMERO ASIENTO`",
        "nullif(CAST(floor(l_discount * 100 + 0.5D) AS DOUBLE), 0) AS `% PROMOCION`",
        "CASE o_orderpriority WHEN '1-URGENT' THEN 'ADULTO' WHEN '2-HIGH' "
        "THEN 'PROMOCION ESPECIAL' ELSE o_orderpriority END AS DESCRIPCION_DESCUENTO",
        "CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS BOLETOS_CANCELADOS",
        "1 AS BOLETOS_VENDIDOS",
        "CASE WHEN l_returnflag = 'R' THEN VENTA_BRUTA ELSE 0D END AS CANCELACION",
        "CASE WHEN l_returnflag = 'R' THEN IVA_BRUTO ELSE 0D END AS IVA_CANCELADO",
        "IVA_BRUTO AS IVA_VENDIDO",
        "VENTA_BRUTA AS VENTA",
        "CAST(year(FECHA_OPERACION) AS STRING) AS ANIO",
    )


@once
def trips_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trip-leg occupancy under its source names."""
    return trips_of(_star(spark, sf_dir))


def trips_of(star: DataFrame) -> DataFrame:
    return star.selectExpr(
        "FECHA_CORRIDA AS `ANIO-MES-DIA`",
        "CV_CORRIDA AS CORRIDA",
        "CASE WHEN pmod(l_suppkey, 23) <> 0 THEN CAST(pmod(l_suppkey, 2) AS STRING) END "
        "AS CLAVEASIGNACION",
        "ORIGEN AS `CV ORIGEN CORRIDA`",
        "DESTINO AS `CV DESTINO CORRIDA`",
        "lpad(CAST(pmod(l_partkey, 6) * 4 AS STRING), 2, '0') || ':15:00.000' "
        "AS `HORA SALIDA ORIGEN RUTA`",
        "100D + p_size * 10 + l_linenumber * 50 AS NKILOMETROSACUMULADOSRUTAS",
        "ORIGEN AS `CLAVE TRAMO ORIGEN`",
        "DESTINO AS `CLAVE TRAMO DESTINO`",
        "HORA_PUNTO AS `HORA SALIDA PUNTO`",
        "CAST(weekday(FECHA_CORRIDA) AS STRING) AS NOMDIA",
        "CASE WHEN pmod(l_partkey, 11) <> 0 THEN 'E' || CAST(pmod(l_partkey, 4) AS STRING) END "
        "AS `EMPRESA SERVICIO`",
        "CASE WHEN pmod(l_partkey, 13) <> 0 THEN p_type END AS `TIPO CORRIDA`",
        "CASE WHEN pmod(l_suppkey, 5) <> 0 THEN p_brand END AS `TIPO AUTOBUS`",
        "p_retailprice AS TARIFABASETRAMO",
        "floor(p_retailprice * 0.16D * 100 + 0.5D) / 100 AS NIVATARIFABASETRAMO",
        "floor(l_extendedprice / 50 * 100 + 0.5D) / 100 AS INGRESOS",
        "floor(l_extendedprice * l_tax / 50 * 100 + 0.5D) / 100 AS IVA",
        "100D + p_size * 10 AS KILOMETROS_TRAMOS",
        "CAST(24 + pmod(l_suppkey, 5) * 3 AS INT) AS NCAPACIDADASIENTOTRAMO",
        "p_size AS DISPONIBILIDAD_TRAMO",
        "l_linenumber * 5 AS OCUPACIONPUNTO",
        "l_linenumber * 8 AS OCUPACION_TRAMO",
        "floor(p_retailprice * p_size / 10 * 100 + 0.5D) / 100 AS `INGRESO TEORICO_TRAMO`",
        "pmod(l_linenumber, 3) AS `PASAJEROS BAJAN EN ORIGEN`",
        "l_linenumber AS `PASAJEROS SUBEN EN ORIGEN`",
        "CAST(year(FECHA_CORRIDA) AS STRING) AS ANIO",
    )


@once
def loyalty_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loyalty records; two in three belong to transactions that nobody sold."""
    return loyalty_of(_star(spark, sf_dir))


def loyalty_of(star: DataFrame) -> DataFrame:
    return star.selectExpr(
        "IF(pmod(l_orderkey + l_partkey, 3) = 0, TRANSACCION, -TRANSACCION) AS TRANSACCION",
        "FECHA_OPERACION AS `FECHA OPERACION`",
        "FECHA_CORRIDA AS `FECHA SALIDA INICIO`",
        "ORIGEN", "DESTINO",
        "CASE WHEN pmod(l_partkey, 4) <> 0 THEN 'T' || CAST(pmod(l_suppkey, 9) AS STRING) END "
        "AS TERMINAL",
        "CASE WHEN pmod(l_partkey, 4) = 0 THEN VENTA_BRUTA END AS EFECTIVO",
        "CASE WHEN pmod(l_orderkey, 5) <> 0 AND pmod(c_custkey, 7) <> 0 THEN "
        "CASE WHEN pmod(l_orderkey, 4) = 0 THEN 'alt.' ELSE '' END || "
        "lower(replace(c_name, '#', '.')) || '@correo.com' END AS EMAIL",
        "CAST(year(FECHA_OPERACION) AS STRING) AS ANIO",
    )


@once
def operations_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Active operations, the left side of the contact extract."""
    return _star(spark, sf_dir).selectExpr(
        "l_orderkey AS NCLAVEOPERACION",
        "TRANSACCION AS NCLAVETRANSACCION",
        "'55' || lpad(CAST(c_custkey AS STRING), 8, '0') AS ATELEFONOPASAJERO",
        "ORIGEN AS ACLAVEOFICINAORIGEN",
        "DESTINO AS ACLAVEOFICINADESITINO",
        "FECHA_OPERACION AS FFECHAOPERACION",
        "lpad(CAST(pmod(l_orderkey, 24) AS STRING), 2, '0') || ':00:00' AS HHORAOPERACION",
        "FECHA_CORRIDA AS FFECHASALIDAINICIO",
        "get(array('AM', 'BM', 'CE', 'CS', 'NE', 'NS', 'ZZ'), "
        "CAST(pmod(l_suppkey, 7) AS INT)) AS ACLAVETIPOOPERACION",
        "pmod(l_linenumber, 2) AS NCLAVEOPERACIONVP",
    )


@once
def complements_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contact complements; one in three belongs to an operation that does not exist."""
    return _star(spark, sf_dir).selectExpr(
        "l_orderkey AS NCLAVEOPERACION",
        "IF(pmod(l_partkey, 3) <> 0, TRANSACCION, -TRANSACCION) AS NCLAVETRANSACCION",
        "CASE WHEN pmod(l_orderkey, 5) <> 0 THEN lower(replace(c_name, '#', '.')) END "
        "AS ACORREOELECTRONICO",
        "CASE WHEN pmod(c_custkey, 2) = 0 THEN CAST(c_custkey AS STRING) END AS AIDMEMBRESIACRM",
    )


@once
def occupancy_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily occupancy source of the projections."""
    return trips_raw(spark, sf_dir).selectExpr(
        "`EMPRESA SERVICIO` AS EMPRESA", "ANIO",
        "date_format(`ANIO-MES-DIA`, 'yyyy-MM') AS ANIO_MES",
        "`ANIO-MES-DIA` AS FECHA",
        "OCUPACION_TRAMO",
        "KILOMETROS_TRAMOS * OCUPACION_TRAMO AS KM_OCUPACION",
        "KILOMETROS_TRAMOS * NCAPACIDADASIENTOTRAMO AS KM_CAPACIDAD",
        "INGRESOS", "NKILOMETROSACUMULADOSRUTAS AS KMS",
        "1 AS CUENTACORRIDA",
        "`PASAJEROS SUBEN EN ORIGEN` AS PAX_SUBEN",
    )


@once
def branch_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily branch sales source of the projections."""
    return _star(spark, sf_dir).selectExpr(
        "'E' || CAST(pmod(l_partkey, 4) AS STRING) AS EMPRESA",
        "CAST(year(FECHA_OPERACION) AS STRING) AS ANIO",
        "FECHA_OPERACION AS FECHA",
        "get(array('BOLETOS', 'PACK', 'CARGA'), CAST(pmod(l_suppkey, 3) AS INT)) "
        "AS TIPO_OPERACION",
        "VENTA_BRUTA AS VENTA",
        "1 AS BOLETOS",
    )


@once
def accounting_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounting-day source: the amount of a ticket lands in one of six channels.

    The last channel is unknown, not zero, before 1999 where it has no amount.
    """
    names = ["BOLETOS_TAQUILLA", "INTERCIA_EXT", "INTERCIA_INT", "A_BORDO", "MANUALES"]
    return _star(spark, sf_dir).selectExpr(
        "'E' || CAST(pmod(l_partkey, 4) AS STRING) AS EMPRESA",
        "CAST(year(FECHA_CORRIDA) AS STRING) AS ANIO",
        "date_format(FECHA_CORRIDA, 'yyyy-MM') AS ANIO_MES",
        "FECHA_CORRIDA AS FECHA",
        "VENTA_BRUTA AS IMPORTE",
        "100D + p_size * 10 AS KMS",
        "1 AS CANTIDAD",
        "1 AS VIAJES",
        *[f"CASE WHEN pmod(l_orderkey, 6) = {n} THEN VENTA_BRUTA ELSE 0D END AS {name}"
          for n, name in enumerate(names)],
        "CASE WHEN pmod(l_orderkey, 6) = 5 THEN VENTA_BRUTA "
        "WHEN year(FECHA_CORRIDA) < 1999 THEN NULL ELSE 0D END AS PORTATIL",
    )


@once
def budget_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Budget source of the projections."""
    return _star(spark, sf_dir).selectExpr(
        "'E' || CAST(pmod(l_partkey, 4) AS STRING) AS EMPRESA",
        "FECHA_OPERACION AS FECHA",
        "get(array('BOLETOS', 'PACK'), CAST(pmod(l_suppkey, 2) AS INT)) AS TIPO_OPERACION",
        "VENTA_BRUTA AS VENTA",
        "1 AS BOLETOS",
        "p_size * 30 AS PRESUPUESTO_MENSUAL",
        "p_retailprice AS PRESUPUESTO",
        "l_linenumber AS PASAJEROS",
        "100D + p_size * 10 AS KMS",
        "1 AS SERVICIOS",
    )
