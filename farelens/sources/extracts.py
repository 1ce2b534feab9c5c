"""Extraction of sales, trips, loyalty and contacts from their source tables.

Filters are plain predicates on source columns, so they reach the parquet or JDBC scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from farelens.functions.fixed import SALE_OPERATIONS

Routes = Sequence[tuple[str, str]]


def _between(routes: Routes, origin: str, destination: str) -> Column:
    """Both ends belong to the listed ends; pairs are matched by ``for_routes``."""
    return F.col(origin).isin(sorted({o for o, _ in routes})) & F.col(destination).isin(
        sorted({d for _, d in routes}))


def _rename(df: DataFrame, names: dict[str, str | Column]) -> DataFrame:
    return df.select(*[
        (F.col(f"`{source}`") if isinstance(source, str) else source).alias(name)
        for name, source in names.items()
    ])


def extract_sales(data: DataFrame, routes: Routes, year_from: str = "2023") -> DataFrame:
    """Ticket sales: 28 columns, tickets and amounts net of cancellations."""
    kept = data.where(
        _between(routes, "ORIGEN", "DESTINO")
        & F.col("TIPO_OPERACION").isin(SALE_OPERATIONS)
        & (F.col("ANIO") >= year_from)
    )
    net_sale = F.col("VENTA") - F.col("IVA_VENDIDO")
    net_cancel = F.col("CANCELACION") - F.col("IVA_CANCELADO")
    return _rename(kept, {
        "OPERACION": "OPERACION",
        "TRANSACCION": "TRANSACCION",
        "FECHA_OPERACION": "FFECHAOPERACION",
        "HORA_OPERACION": "HHORAOPERACION",
        "NOMBRE_DIA_OPERACION": "NOMBRE DIA",
        "AREA_VENTA": "AREA_VENTA",
        "CLASE_SERVICIO": "ANOMBRECLASESERVICIO",
        "ORIGEN": "ORIGEN",
        "DESTINO": "DESTINO",
        "CV_CORRIDA": "CLAVE CORRIDA",
        "FECHA_CORRIDA": "FECHA_CORRIDA",
        "HORA_SALIDA_CORRIDA": "H SALIDA BOLETO",
        "TIPO_PASAJERO": "TIPO PASAJERO",
        "TIPO_CLIENTE": "TIPO_CLIENTE",
        "TIPO_OPERACION": "TIPO_OPERACION",
        "VENTA_ANTICIPADA": "VENTA_ANTICIPADA",
        "NOMBRE_PASAJERO": "NOMBRE_PASAJERO",
        "NUM_ASIENTO": "NUMERO ASIENTO",
        "PORCENT_PROMO": "% PROMOCION",
        "DESC_DESCUENTO": "DESCRIPCION_DESCUENTO",
        "BOLETOS_CANCEL": "BOLETOS_CANCELADOS",
        "BOLETOS_TOTALES": "BOLETOS_VENDIDOS",
        "BOLETOS_VEND": F.col("BOLETOS_VENDIDOS") - F.col("BOLETOS_CANCELADOS"),
        "VENTA_CANCEL": "CANCELACION",
        "IVA_CANCEL": "IVA_CANCELADO",
        "IVA_VENDIDO": "IVA_VENDIDO",
        "VENTA_TOTAL": "VENTA",
        "VENTA": net_sale - net_cancel,
    })


def extract_trips(data: DataFrame, routes: Routes, year_from: str = "2023") -> DataFrame:
    """Trip-leg occupancy: 26 columns."""
    kept = data.where(
        _between(routes, "CLAVE TRAMO ORIGEN", "CLAVE TRAMO DESTINO")
        & (F.col("ANIO") >= year_from)
    )
    return _rename(kept, {
        "FECHA_CORRIDA": "ANIO-MES-DIA",
        "CV_CORRIDA": "CORRIDA",
        "CV_ASIGN": "CLAVEASIGNACION",
        "ORIGEN_CORRIDA": "CV ORIGEN CORRIDA",
        "DESTINO_CORRIDA": "CV DESTINO CORRIDA",
        "HORA_SALIDA_ORIGEN_CORRIDA": "HORA SALIDA ORIGEN RUTA",
        "KMS_ACUM_CORRIDA": "NKILOMETROSACUMULADOSRUTAS",
        "ORIGEN": "CLAVE TRAMO ORIGEN",
        "DESTINO": "CLAVE TRAMO DESTINO",
        "HORA_SALIDA_CORRIDA": "HORA SALIDA PUNTO",
        "NOMBRE_DIA_CORRIDA": "NOMDIA",
        "EMPRESA": "EMPRESA SERVICIO",
        "TIPO_CORRIDA": "TIPO CORRIDA",
        "TIPO_BUS": "TIPO AUTOBUS",
        "TARIFA_BASE_TRAMO": "TARIFABASETRAMO",
        "IVA_TARIFA_BASE_TRAMO": "NIVATARIFABASETRAMO",
        "INGRESO_TRANSP": "INGRESOS",
        "IVA_TRANSP": "IVA",
        "KMS_TRAMO": "KILOMETROS_TRAMOS",
        "CAPACIDAD_ASIENTOS_TRAMO": "NCAPACIDADASIENTOTRAMO",
        "DISPONIBILIDAD_TRAMO": "DISPONIBILIDAD_TRAMO",
        "OCUPACION_PUNTO": "OCUPACIONPUNTO",
        "OCUPACION_TRAMO": "OCUPACION_TRAMO",
        "INGRESO_TEORICO_TRAMO": "INGRESO TEORICO_TRAMO",
        "PAX_BAJAN": "PASAJEROS BAJAN EN ORIGEN",
        "PAX_SUBEN": "PASAJEROS SUBEN EN ORIGEN",
    })


def extract_loyalty(data: DataFrame, routes: Routes, year_from: str = "2023") -> DataFrame:
    """Loyalty records: 8 columns."""
    kept = data.where(_between(routes, "ORIGEN", "DESTINO") & (F.col("ANIO") >= year_from))
    return _rename(kept, {
        "TRANSACCION": "TRANSACCION",
        "FECHA_OPERACION": "FECHA OPERACION",
        "FECHA_CORRIDA": "FECHA SALIDA INICIO",
        "ORIGEN": "ORIGEN",
        "DESTINO": "DESTINO",
        "TARJETA": "TERMINAL",
        "EFECTIVO": "EFECTIVO",
        "EMAIL": "EMAIL",
    })


def extract_contacts(operations: DataFrame, complements: DataFrame, routes: Routes,
                     date_from: str = "2023-01-01") -> DataFrame:
    """Contact data of active operations, with mail and membership where known."""
    keys = ["NCLAVEOPERACION", "NCLAVETRANSACCION"]
    kept = operations.where(
        (F.col("FFECHASALIDAINICIO") >= F.lit(date_from).cast("date"))
        & _between(routes, "ACLAVEOFICINAORIGEN", "ACLAVEOFICINADESITINO")
        & F.col("ACLAVETIPOOPERACION").isin(SALE_OPERATIONS)
        & (F.col("NCLAVEOPERACIONVP") == 0)
    )
    return _rename(kept.join(complements, keys, "left"), {
        "OPERACION": "NCLAVEOPERACION",
        "TEL_PASAJERO": "ATELEFONOPASAJERO",
        "CORREO_ELECTRONICO": "ACORREOELECTRONICO",
        "MEMBRESIA_CRM": "AIDMEMBRESIACRM",
        "ORIGEN": "ACLAVEOFICINAORIGEN",
        "DESTINO": "ACLAVEOFICINADESITINO",
        "FECHA_OPERACION": "FFECHAOPERACION",
        "HORA_OPERACION": "HHORAOPERACION",
    })


def for_routes(df: DataFrame, routes: Routes | DataFrame, origin: str = "ORIGEN",
               destination: str = "DESTINO") -> DataFrame:
    """Rows of the listed (origin, destination) pairs.

    A list becomes a predicate whose two end lists are pushed to the scan.  A frame
    becomes a semi-join; Spark broadcasts it if its files are below the threshold.
    """
    if isinstance(routes, DataFrame):
        dim = routes.select(F.col("ORIGEN").alias(origin), F.col("DESTINO").alias(destination))
        return df.join(dim, [origin, destination], "left_semi")
    pair = F.concat(F.col(origin), F.lit("-"), F.col(destination))
    return df.where(_between(routes, origin, destination)
                    & pair.isin([f"{o}-{d}" for o, d in routes]))
