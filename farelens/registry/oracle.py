"""SQL common table expressions the checks build on.

They restate the bindings and the preparation in SQL on their own.  ``statement`` puts
only the expressions a body needs, in order, before it.
"""

from __future__ import annotations

import re

from farelens.bindings import LEAD_STEPS, ROUTES, YEAR_FROM

_PAIRS = ", ".join(f"'{o}-{d}'" for o, d in ROUTES)

STAR = f"""
SELECT l.*, o.*, p.*, s.s_nationkey, c.*, ro.r_name AS ORIGEN, rd.r_name AS DESTINO,
  l_partkey * 10 + l_linenumber AS TRANSACCION,
  CAST(l_shipdate AS DATE) AS FECHA_CORRIDA,
  CAST(l_shipdate AS DATE) - CAST(len(list_filter({LEAD_STEPS},
    lambda t: t <= (l_orderkey * 15485863 + l_linenumber * 17) % 9973)) AS INTEGER)
    AS FECHA_OPERACION,
  CAST(l_partkey % 6 AS VARCHAR) AS CV_CORRIDA,
  lpad(CAST((l_partkey % 6) * 4 + 1 AS VARCHAR), 2, '0') || ':30:00' AS HORA_PUNTO,
  floor(l_extendedprice * (1 - l_discount) * (1 + l_tax) / 50 * 100 + 0.5) / 100 AS VENTA_BRUTA,
  floor(l_extendedprice * (1 - l_discount) * l_tax / 50 * 100 + 0.5) / 100 AS IVA_BRUTO
FROM lineitem l
JOIN orders o ON l_orderkey = o_orderkey
JOIN part p ON l_partkey = p_partkey
JOIN supplier s ON l_suppkey = s_suppkey
JOIN customer c ON o_custkey = c_custkey
JOIN nation no ON s_nationkey = no.n_nationkey JOIN region ro ON no.n_regionkey = ro.r_regionkey
JOIN nation nd ON c_nationkey = nd.n_nationkey JOIN region rd ON nd.n_regionkey = rd.r_regionkey
"""

SALES = f"""
SELECT l_orderkey AS OPERACION, TRANSACCION, FECHA_OPERACION,
  lpad(CAST(l_orderkey % 24 AS VARCHAR), 2, '0') || ':' ||
    lpad(CAST(l_partkey % 60 AS VARCHAR), 2, '0') || ':00' AS HORA_OPERACION,
  CAST(isodow(FECHA_OPERACION) - 1 AS VARCHAR) AS NOMBRE_DIA_OPERACION,
  o_orderstatus AS AREA_VENTA,
  CASE WHEN p_type = 'LARGE' THEN 'Large dos pisos' WHEN p_type <> 'SMALL' THEN p_type END
    AS CLASE_SERVICIO,
  ORIGEN, DESTINO, CV_CORRIDA, FECHA_CORRIDA, HORA_PUNTO AS HORA_SALIDA_CORRIDA,
  (['AD', 'AD', 'AD', 'ES', 'NI', 'PF', 'ZB', 'QQ'])[c_custkey % 8 + 1] AS TIPO_PASAJERO,
  c_mktsegment AS TIPO_CLIENTE,
  (['AM', 'BM', 'CE', 'CS', 'NE', 'NS', 'ZZ'])[l_suppkey % 7 + 1] AS TIPO_OPERACION,
  CASE WHEN l_orderkey % 17 = 0 THEN NULL
       WHEN FECHA_CORRIDA - FECHA_OPERACION > 30 THEN 'SI' ELSE 'NO' END AS VENTA_ANTICIPADA,
  replace(c_name, '#', ' ') AS NOMBRE_PASAJERO,
  CAST(l_quantity AS INTEGER) AS NUM_ASIENTO,
  nullif(floor(l_discount * 100 + 0.5), 0) AS PORCENT_PROMO,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'ADULTO' WHEN '2-HIGH' THEN 'PROMOCION ESPECIAL'
       ELSE o_orderpriority END AS DESC_DESCUENTO,
  CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS BOLETOS_CANCEL,
  1 AS BOLETOS_TOTALES,
  1 - CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS BOLETOS_VEND,
  CASE WHEN l_returnflag = 'R' THEN VENTA_BRUTA ELSE 0 END AS VENTA_CANCEL,
  CASE WHEN l_returnflag = 'R' THEN IVA_BRUTO ELSE 0 END AS IVA_CANCEL,
  IVA_BRUTO AS IVA_VENDIDO, VENTA_BRUTA AS VENTA_TOTAL,
  (VENTA_BRUTA - IVA_BRUTO) - (CASE WHEN l_returnflag = 'R' THEN VENTA_BRUTA ELSE 0 END
    - CASE WHEN l_returnflag = 'R' THEN IVA_BRUTO ELSE 0 END) AS VENTA
FROM star
WHERE ORIGEN || '-' || DESTINO IN ({_PAIRS}) AND l_suppkey % 7 <> 6
  AND year(FECHA_OPERACION) >= {YEAR_FROM}
"""

TRIPS = f"""
SELECT FECHA_CORRIDA, CV_CORRIDA,
  CASE WHEN l_suppkey % 23 <> 0 THEN CAST(l_suppkey % 2 AS VARCHAR) END AS CV_ASIGN,
  ORIGEN AS ORIGEN_CORRIDA, DESTINO AS DESTINO_CORRIDA,
  lpad(CAST((l_partkey % 6) * 4 AS VARCHAR), 2, '0') || ':15:00.000' AS HORA_SALIDA_ORIGEN_CORRIDA,
  100.0::DOUBLE + p_size * 10 + l_linenumber * 50 AS KMS_ACUM_CORRIDA, ORIGEN, DESTINO,
  HORA_PUNTO AS HORA_SALIDA_CORRIDA,
  CAST(isodow(FECHA_CORRIDA) - 1 AS VARCHAR) AS NOMBRE_DIA_CORRIDA,
  CASE WHEN l_partkey % 11 <> 0 THEN 'E' || CAST(l_partkey % 4 AS VARCHAR) END AS EMPRESA,
  CASE WHEN l_partkey % 13 <> 0 THEN p_type END AS TIPO_CORRIDA,
  CASE WHEN l_suppkey % 5 <> 0 THEN p_brand END AS TIPO_BUS,
  p_retailprice AS TARIFA_BASE_TRAMO,
  floor(p_retailprice * 0.16::DOUBLE * 100 + 0.5) / 100 AS IVA_TARIFA_BASE_TRAMO,
  floor(l_extendedprice / 50 * 100 + 0.5) / 100 AS INGRESO_TRANSP,
  floor(l_extendedprice * l_tax / 50 * 100 + 0.5) / 100 AS IVA_TRANSP,
  100.0::DOUBLE + p_size * 10 AS KMS_TRAMO,
  CAST(24 + 3 * (l_suppkey % 5) AS INTEGER) AS CAPACIDAD_ASIENTOS_TRAMO,
  p_size AS DISPONIBILIDAD_TRAMO, l_linenumber * 5 AS OCUPACION_PUNTO,
  l_linenumber * 8 AS OCUPACION_TRAMO,
  floor(p_retailprice * p_size / 10 * 100 + 0.5) / 100 AS INGRESO_TEORICO_TRAMO,
  l_linenumber % 3 AS PAX_BAJAN, l_linenumber AS PAX_SUBEN
FROM star
WHERE ORIGEN || '-' || DESTINO IN ({_PAIRS}) AND year(FECHA_CORRIDA) >= {YEAR_FROM}
"""

LOYALTY = f"""
SELECT CASE WHEN (l_orderkey + l_partkey) % 3 = 0 THEN TRANSACCION ELSE -TRANSACCION END
    AS TRANSACCION, FECHA_OPERACION, FECHA_CORRIDA, ORIGEN, DESTINO,
  CASE WHEN l_partkey % 4 <> 0 THEN 'T' || CAST(l_suppkey % 9 AS VARCHAR) END AS TARJETA,
  CASE WHEN l_partkey % 4 = 0 THEN VENTA_BRUTA END AS EFECTIVO,
  CASE WHEN l_orderkey % 5 <> 0 AND c_custkey % 7 <> 0 THEN
    CASE WHEN l_orderkey % 4 = 0 THEN 'alt.' ELSE '' END ||
    lower(replace(c_name, '#', '.')) || '@correo.com' END AS EMAIL
FROM star
WHERE ORIGEN || '-' || DESTINO IN ({_PAIRS})
  AND year(FECHA_OPERACION) >= {YEAR_FROM}
"""

LEGS = """
SELECT CV_CORRIDA, FECHA_CORRIDA, HORA_SALIDA_CORRIDA, ORIGEN, DESTINO, CV_ASIGN,
  ORIGEN_CORRIDA, DESTINO_CORRIDA,
  max(CAPACIDAD_ASIENTOS_TRAMO) AS CAPACIDAD_ASIENTOS_TRAMO, max(KMS_TRAMO) AS KMS_TRAMO,
  last(EMPRESA ORDER BY KMS_ACUM_CORRIDA, EMPRESA) FILTER (EMPRESA IS NOT NULL) AS EMPRESA,
  last(TIPO_CORRIDA ORDER BY KMS_ACUM_CORRIDA, TIPO_CORRIDA)
    FILTER (TIPO_CORRIDA IS NOT NULL) AS TIPO_CORRIDA,
  last(TIPO_BUS ORDER BY KMS_ACUM_CORRIDA, TIPO_BUS) FILTER (TIPO_BUS IS NOT NULL) AS TIPO_BUS,
  first(HORA_SALIDA_ORIGEN_CORRIDA ORDER BY KMS_ACUM_CORRIDA) AS HORA_SALIDA_ORIGEN_CORRIDA,
  first(NOMBRE_DIA_CORRIDA ORDER BY KMS_ACUM_CORRIDA) AS NOMBRE_DIA_CORRIDA,
  sum(KMS_ACUM_CORRIDA) AS KMS_ACUM_CORRIDA, sum(TARIFA_BASE_TRAMO) AS TARIFA_BASE_TRAMO,
  sum(IVA_TARIFA_BASE_TRAMO) AS IVA_TARIFA_BASE_TRAMO, sum(INGRESO_TRANSP) AS INGRESO_TRANSP,
  sum(IVA_TRANSP) AS IVA_TRANSP, CAST(sum(DISPONIBILIDAD_TRAMO) AS BIGINT) AS DISPONIBILIDAD_TRAMO,
  CAST(sum(OCUPACION_PUNTO) AS BIGINT) AS OCUPACION_PUNTO, CAST(sum(OCUPACION_TRAMO) AS BIGINT) AS OCUPACION_TRAMO,
  sum(INGRESO_TEORICO_TRAMO) AS INGRESO_TEORICO_TRAMO, CAST(sum(PAX_BAJAN) AS BIGINT) AS PAX_BAJAN,
  CAST(sum(PAX_SUBEN) AS BIGINT) AS PAX_SUBEN
FROM trips WHERE CV_ASIGN IS NOT NULL
GROUP BY CV_CORRIDA, FECHA_CORRIDA, HORA_SALIDA_CORRIDA, ORIGEN, DESTINO, CV_ASIGN,
  ORIGEN_CORRIDA, DESTINO_CORRIDA
"""

SALES_LEGS = """
SELECT s.*, g.* EXCLUDE (CV_CORRIDA, FECHA_CORRIDA, HORA_SALIDA_CORRIDA, ORIGEN, DESTINO)
FROM sales s JOIN legs g USING (CV_CORRIDA, FECHA_CORRIDA, HORA_SALIDA_CORRIDA, ORIGEN, DESTINO)
"""

JOINED = """
SELECT s.*, y.TARJETA, y.EFECTIVO, y.EMAIL,
  CASE WHEN y.TARJETA IS NULL THEN 'EFECTIVO' ELSE 'TARJETA' END AS PAGO_METODO
FROM sales_legs s LEFT JOIN loyalty y
  USING (TRANSACCION, FECHA_OPERACION, FECHA_CORRIDA, ORIGEN, DESTINO)
"""

SEATED = """
SELECT * FROM joined
WHERE NUM_ASIENTO <= (SELECT max(CAPACIDAD_ASIENTOS_TRAMO) FROM joined)
"""

REPAIRED = """
SELECT * REPLACE (CASE WHEN NUM_ASIENTO > CAPACIDAD_ASIENTOS_TRAMO
    THEN (SELECT max(CAPACIDAD_ASIENTOS_TRAMO) FROM seated)
    ELSE CAPACIDAD_ASIENTOS_TRAMO END AS CAPACIDAD_ASIENTOS_TRAMO)
FROM seated
"""

TICKETS = """
SELECT * EXCLUDE (NOMBRE_DIA_OPERACION, NOMBRE_DIA_CORRIDA),
  hour(CAST(HORA_OPERACION AS TIME)) AS HORA_VENTA,
  hour(CAST(HORA_SALIDA_CORRIDA AS TIME)) AS HORA_DECIMAL,
  left(HORA_SALIDA_ORIGEN_CORRIDA, 8) AS HORA_SALIDA_CORRIDA_,
  CAST(isodow(FECHA_OPERACION) - 1 AS VARCHAR) || '_' ||
    (['Lun', 'Mar', 'Mie', 'Jue', 'Vie', 'Sab', 'Dom'])[isodow(FECHA_OPERACION)]
    AS NOMBRE_DIA_OPERACION,
  CAST(isodow(FECHA_CORRIDA) - 1 AS VARCHAR) || '_' ||
    (['Lun', 'Mar', 'Mie', 'Jue', 'Vie', 'Sab', 'Dom'])[isodow(FECHA_CORRIDA)]
    AS NOMBRE_DIA_CORRIDA,
  BOLETOS_VEND - BOLETOS_CANCEL AS TOTAL_BOLETOS,
  VENTA - VENTA_CANCEL - IVA_VENDIDO - IVA_CANCEL AS TOTAL_VENTA,
  round_even((VENTA - VENTA_CANCEL - IVA_VENDIDO - IVA_CANCEL) / nullif(TARIFA_BASE_TRAMO, 0), 4)
    AS DIF_TARIF,
  year(FECHA_CORRIDA) AS ANIO, month(FECHA_CORRIDA) AS MES,
  FECHA_CORRIDA - FECHA_OPERACION AS DIAS_ANTICIPACION,
  CAST((FECHA_CORRIDA - FECHA_OPERACION) * 24 + hour(CAST(HORA_SALIDA_CORRIDA AS TIME))
    - hour(CAST(HORA_OPERACION AS TIME)) AS DOUBLE) AS HORAS_ANTICIPACION,
  round_even(((FECHA_CORRIDA - FECHA_OPERACION) * 24 + hour(CAST(HORA_SALIDA_CORRIDA AS TIME))
    - hour(CAST(HORA_OPERACION AS TIME))) / 24.0::DOUBLE, 5) AS TIEMPO_ANTICIPACION,
  ORIGEN || '-' || DESTINO AS ORIGEN_DESTINO
FROM repaired
"""

CTES: dict[str, str] = {
    "star": STAR, "sales": SALES, "trips": TRIPS, "loyalty": LOYALTY, "legs": LEGS,
    "sales_legs": SALES_LEGS, "joined": JOINED, "seated": SEATED, "repaired": REPAIRED,
    "tickets": TICKETS,
}


def define(name: str, sql: str) -> None:
    """Add a shared expression; it may use the ones defined before it."""
    if name in CTES:
        raise ValueError(f"{name} is defined twice")
    CTES[name] = sql


def statement(body: str) -> str:
    """``body`` preceded by the expressions it needs."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in CTES:
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(CTES[name])
                needed.append(name)

    visit(body)
    if not needed:
        return body.strip()
    parts = ",\n".join(f"{name} AS MATERIALIZED ({CTES[name].strip()})" for name in needed)
    return f"WITH {parts}\n{body.strip()}"
