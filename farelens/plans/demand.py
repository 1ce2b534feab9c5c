"""The demand profile: all indicators, their classes, and the classes on every ticket."""

from __future__ import annotations

from pyspark.sql import DataFrame

from farelens.operators import classify, kpis, series


def indicators(df: DataFrame, year_col: str = "ANIO", min_year: int | None = None,
               band_year: int = 2025) -> dict[str, DataFrame]:
    """The indicator tables by name; each is a plan, nothing is computed yet."""
    scope = kpis.indicator_scope(df, year_col, min_year)
    return {
        "ocupacion_promedio": kpis.occupancy(scope),
        "venta_anticipada": kpis.advance_curve(scope),
        "venta_x_asientos": kpis.seat_demand(scope),
        "ventas_por_origen": kpis.origin_means(scope),
        "ventas_por_mes": kpis.monthly(df),
        "boletos_x_tarifa": kpis.fare_bands(scope, year_from=band_year),
    }


# Class tables, the keys they join tickets on, and the classes they bring.
CLASSES = {
    "venta_anticipada": (["DIAS_ANTICIPACION"], ["Clasif_venta_anticip"]),
    "venta_x_asientos": (["CAPACIDAD_ASIENTOS_TRAMO", "NUM_ASIENTO"], ["Clasif_asiento"]),
    "ventas_por_mes": (["ANIO", "MES"], ["Clasif_mes"]),
    "ocupacion_promedio": (["NOMBRE_DIA_CORRIDA", "HORA_DECIMAL"],
                           ["Clasif_dia_venta", "Clasif_hora_venta"]),
}


def classified_indicators(df: DataFrame, year_col: str = "ANIO", min_year: int | None = None,
                          band_year: int = 2025) -> dict[str, DataFrame]:
    """The indicator tables, four of them with classes."""
    found = indicators(df, year_col, min_year, band_year)
    found["venta_anticipada"] = series.decay_segments(
        series.smooth_log(found["venta_anticipada"]), max_segments=4)
    found["venta_x_asientos"] = classify.classify_seats(found["venta_x_asientos"])
    found["ventas_por_mes"] = classify.classify_months(found["ventas_por_mes"])
    found["ocupacion_promedio"] = classify.classify_day_hour(found["ocupacion_promedio"])
    return found


def attach_classes(df: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """Tickets with all classes.

    Where the tables were stored, their size is known before the join, and a small one is
    broadcast instead of shuffling the tickets on lead days or hours, of which there are few.
    """
    for name, (on, cols) in CLASSES.items():
        df = classify.attach(df, tables[name], on, cols)
    return df


def demand_profile(df: DataFrame, year_col: str = "ANIO", min_year: int | None = None,
                   band_year: int = 2025) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Tickets with their demand classes, and the classified indicator tables."""
    found = classified_indicators(df, year_col, min_year, band_year)
    return attach_classes(df, found), found
