"""Dynamic fares against sold fares, and the demand response."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from farelens.functions.columns import safe_div
from farelens.operators.fares import passenger_discount
from farelens.operators.prep import TICKET

# A ticket repeats once per assignment of its trip.
ASSIGNED_TICKET = (*TICKET, "CV_ASIGN")


def align_results(fares: DataFrame, clusters: DataFrame,
                  row_id: Sequence[str] = ASSIGNED_TICKET) -> DataFrame:
    """Quoted fare and cluster of the same ticket, matched by its identity.

    ``row_id`` must identify a row on both sides; rows missing on either side drop out.
    """
    extra = [c for c in clusters.columns if c in row_id or c not in fares.columns]
    return fares.join(clusters.select(*extra), list(row_id))


def final_fare(df: DataFrame) -> DataFrame:
    """Uplift by cluster, discount by passenger type, and the gap to the sold fare."""
    priced = passenger_discount(df).withColumn(
        "Tarifa_final", F.col("TARIFA_DINAMICA") * (1 + F.col("Aumento") / 100),
    ).withColumn("VentaD_final", F.col("Tarifa_final") * (1 - F.col("Descuento")))
    return priced.withColumn(
        "Delta_P", safe_div(F.col("VentaD_final") - F.col("VENTA"), "VentaD_final"))


def route_day_compare(df: DataFrame) -> DataFrame:
    """Dynamic and sold income, prices and their gap by route and day."""
    sums = df.dropna(subset=["ORIGEN_DESTINO", "FECHA_CORRIDA"]).groupBy(
        "ORIGEN_DESTINO", "FECHA_CORRIDA").agg(*[
            F.coalesce(F.sum(c), F.lit(0)).alias(c)
            for c in ("BOLETOS_VEND", "VentaD_final", "VENTA")])
    return sums.withColumns({
        "Diff_P_Dinero": F.col("VentaD_final") - F.col("VENTA"),
        "PCT_dP": safe_div(F.col("VENTA") - F.col("VentaD_final"), "VentaD_final"),
        "Precio_Prom": safe_div("VENTA", "BOLETOS_VEND"),
        "Precio_Prom_Dinamico": safe_div("VentaD_final", "BOLETOS_VEND"),
    })


def by_calendar_day(df: DataFrame, calendar: DataFrame) -> DataFrame:
    """Elasticity of the same route, month and day of the month, whatever the year."""
    def dated(frame: DataFrame) -> DataFrame:
        return frame.withColumns({
            "mes": F.month("FECHA_CORRIDA"), "dia": F.dayofmonth("FECHA_CORRIDA")})

    days = dated(calendar).select(
        "ORIGEN_DESTINO", "mes", "dia", F.col("ELASTICIDADES").alias("Elast"))
    return dated(df).join(days, ["ORIGEN_DESTINO", "mes", "dia"], "left").drop("mes", "dia")


def scenario(df: DataFrame, response: str = "elasticity") -> DataFrame:
    """Estimated tickets and income under the dynamic fare.

    ``elasticity`` scales tickets by 1 + e; ``price`` by 1 + e times the price change.
    """
    if response not in ("elasticity", "price"):
        raise ValueError("response must be 'elasticity' or 'price'")
    moved = df.withColumn("PCT_dQ", F.col("PCT_dP") * F.col("Elast"))
    factor = F.col("Elast") + 1 if response == "elasticity" else F.col("PCT_dQ") + 1
    est = moved.withColumn("Boletos_Estimados", F.col("BOLETOS_VEND") * factor).withColumn(
        "Ingreso_Estimado", F.col("Boletos_Estimados") * F.col("Precio_Prom_Dinamico"))
    return est.withColumns({
        "Diff_P_Dinero_Estimado": F.col("Ingreso_Estimado") - F.col("VENTA"),
        "PCT_dP_Estimado": safe_div(F.col("Ingreso_Estimado") - F.col("VENTA"),
                                    "Ingreso_Estimado"),
        "PCT_dQ_Estimado": safe_div(F.col("Boletos_Estimados") - F.col("BOLETOS_VEND"),
                                    "Boletos_Estimados"),
    })


def route_minimum(df: DataFrame, name: str) -> DataFrame:
    """Worst value of each route."""
    return df.groupBy("ORIGEN_DESTINO").agg(F.min(name).alias(name))


# Columns of the per-ticket summary, without those that identify the ticket.
SUMMARY = ["NOMBRE_PASAJERO", "FECHA_CORRIDA", "HORA_SALIDA_CORRIDA", "TIPO_PASAJERO",
           "ORIGEN_DESTINO", "EMAIL", "Cluster", "TARIFA_DINAMICA", "Aumento", "VentaD_final"]


def report_tables(priced: DataFrame, calendar: DataFrame, response: str = "elasticity",
                  keep: Sequence[str] = ASSIGNED_TICKET) -> dict[str, DataFrame]:
    """The five report tables by name, from priced tickets and the elasticity calendar.

    ``priced`` is the outcome of ``final_fare``; the ticket summary has those of its columns
    that there are, ``keep`` in front.
    """
    compared = scenario(by_calendar_day(route_day_compare(priced), calendar), response)
    columns = [*keep, *[c for c in SUMMARY if c not in keep]]
    return {
        "calendario": calendar.select("ORIGEN_DESTINO", "FECHA_CORRIDA", "ELASTICIDADES"),
        "resumen_boletos": priced.select(*[c for c in columns if c in priced.columns]),
        "comparacion_ruta_dia": compared,
        "minimo_ingreso_ruta": route_minimum(compared, "PCT_dP_Estimado"),
        "minimo_boletos_ruta": route_minimum(compared, "PCT_dQ_Estimado"),
    }
