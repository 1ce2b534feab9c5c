"""Trip collapse, the sales x trip x loyalty join, seat repair and derived columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from farelens.functions.columns import (
    clock_hour, half_even, parse_date, route_key, safe_div, total, weekday_label,
)
from farelens.operators.joins import Bucketed, co_joined, spread_join

TRIP_KEYS = ["CV_CORRIDA", "FECHA_CORRIDA", "HORA_SALIDA_CORRIDA", "ORIGEN", "DESTINO"]
FULL_TRIP_KEYS = TRIP_KEYS + ["CV_ASIGN", "ORIGEN_CORRIDA", "DESTINO_CORRIDA"]
LOYALTY_KEYS = ["TRANSACCION", "FECHA_OPERACION", "FECHA_CORRIDA", "ORIGEN", "DESTINO"]
# The keys both have: tables in buckets of them take both joins in place.
ROUTE_DAY_KEYS = ["FECHA_CORRIDA", "ORIGEN", "DESTINO"]
TICKET = ["OPERACION", "TRANSACCION", "NUM_ASIENTO"]

_LAST_KNOWN = ["EMPRESA", "TIPO_CORRIDA", "TIPO_BUS"]
_FIRST_TEXT = ["HORA_SALIDA_ORIGEN_CORRIDA", "NOMBRE_DIA_CORRIDA"]
_SUMMED = [
    "KMS_ACUM_CORRIDA", "TARIFA_BASE_TRAMO", "IVA_TARIFA_BASE_TRAMO", "INGRESO_TRANSP",
    "IVA_TRANSP", "DISPONIBILIDAD_TRAMO", "OCUPACION_PUNTO", "OCUPACION_TRAMO",
    "INGRESO_TEORICO_TRAMO", "PAX_BAJAN", "PAX_SUBEN",
]


def _ordered(name: str, order: Sequence[str]) -> Column:
    """Order of the rows where ``name`` is known; its own value settles ties."""
    return F.when(F.col(name).isNotNull(), F.struct(*order, name))


def collapse_trips(trips: DataFrame,
                   order: Sequence[str] = ("KMS_ACUM_CORRIDA",)) -> DataFrame:
    """One row per trip leg and assignment.

    Capacity and km take the maximum, company and types the last known value in
    ``order``, texts the first, everything else the sum.  Rows with an unknown key are
    left out.
    """
    return trips.dropna(subset=FULL_TRIP_KEYS).groupBy(*FULL_TRIP_KEYS).agg(
        F.max("CAPACIDAD_ASIENTOS_TRAMO").alias("CAPACIDAD_ASIENTOS_TRAMO"),
        F.max("KMS_TRAMO").alias("KMS_TRAMO"),
        *[F.max_by(c, _ordered(c, order)).alias(c) for c in _LAST_KNOWN],
        *[F.min_by(c, _ordered(c, order)).alias(c) for c in _FIRST_TEXT],
        *[total(c).alias(c) for c in _SUMMED],
    )


def join_trips(sales: DataFrame, legs: DataFrame) -> DataFrame:
    """Tickets with their trip leg; a leg with several assignments repeats the ticket."""
    return spread_join(sales, legs, TRIP_KEYS, "inner", TICKET)


def join_loyalty(tickets: DataFrame, loyalty: DataFrame,
                 sales: DataFrame | None = None) -> DataFrame:
    """Loyalty data where there is any; repeated loyalty records repeat the ticket."""
    return spread_join(tickets, loyalty, LOYALTY_KEYS, "left", TICKET, sample=sales)


def co_join_trips(sales: Bucketed, trips: Bucketed,
                  order: Sequence[str] = ("KMS_ACUM_CORRIDA",)) -> Bucketed:
    """``join_trips`` of tables in buckets of the route and day: collapse and join in place."""
    return co_joined(sales, trips.map(lambda df: collapse_trips(df, order)), "inner", TICKET,
                     TRIP_KEYS)


def co_join_loyalty(tickets: Bucketed, loyalty: Bucketed) -> Bucketed:
    """``join_loyalty`` of tables in buckets of the route and day."""
    return co_joined(tickets, loyalty, "left", TICKET, LOYALTY_KEYS)


def payment_method(df: DataFrame) -> DataFrame:
    return df.withColumn("PAGO_METODO", F.when(
        F.col("TARJETA").isNotNull(), "TARJETA").otherwise("EFECTIVO"))


def parse_clock(df: DataFrame) -> DataFrame:
    """Dates, sale and departure hours, origin departure text and weekday labels."""
    return df.withColumns({
        "FECHA_OPERACION": parse_date("FECHA_OPERACION"),
        "FECHA_CORRIDA": parse_date("FECHA_CORRIDA"),
        "HORA_SALIDA_CORRIDA_": F.substring("HORA_SALIDA_ORIGEN_CORRIDA", 1, 8),
        "HORA_VENTA": clock_hour("HORA_OPERACION"),
        "HORA_DECIMAL": clock_hour("HORA_SALIDA_CORRIDA"),
    })


def weekday_labels(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "NOMBRE_DIA_OPERACION": weekday_label("FECHA_OPERACION"),
        "NOMBRE_DIA_CORRIDA": weekday_label("FECHA_CORRIDA"),
    })


def fleet_capacity(pairs: DataFrame) -> Column:
    """Largest capacity before and after the seat filter, as one (before, after) value.

    ``pairs`` holds (capacity, seat).  One aggregate by capacity serves both: a capacity
    survives the filter if its lowest seat does.
    """
    by_capacity = pairs.groupBy("CAPACIDAD_ASIENTOS_TRAMO").agg(
        F.min("NUM_ASIENTO").alias("seat"))
    kinds = by_capacity.agg(F.collect_list(F.struct(
        F.col("CAPACIDAD_ASIENTOS_TRAMO").alias("cap"), "seat")).alias("k"))
    before = F.array_max(F.transform("k", lambda x: x["cap"]))
    after = F.array_max(F.transform(
        F.filter("k", lambda x: x["seat"] <= before), lambda x: x["cap"]))
    return kinds.select(F.struct(before.alias("before"), after.alias("after"))).scalar()


def sane_seats(df: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    """Drop tickets whose seat exceeds the largest capacity of all."""
    limits = fleet_capacity(df if pairs is None else pairs)
    return df.where(F.col("NUM_ASIENTO") <= limits["before"])


def repair_seats(df: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    """``sane_seats``, then a bus too small for its seat gets the largest capacity left.

    ``pairs`` is a narrower frame with the same (capacity, seat) pairs, if there is one.
    """
    limits = fleet_capacity(df if pairs is None else pairs)
    seat, capacity = F.col("NUM_ASIENTO"), F.col("CAPACIDAD_ASIENTOS_TRAMO")
    known = df.withColumn("__limits", limits)
    return known.where(seat <= F.col("__limits.before")).withColumn(
        "CAPACIDAD_ASIENTOS_TRAMO",
        F.when(seat > capacity, F.col("__limits.after")).otherwise(capacity)).drop("__limits")


def combine(sales: DataFrame, trips: DataFrame, loyalty: DataFrame,
            order: Sequence[str] = ("KMS_ACUM_CORRIDA",)) -> DataFrame:
    """Sales x trip x loyalty, parsed, labelled and with seats repaired."""
    joined = join_trips(sales, collapse_trips(trips, order))
    return finished(joined, join_loyalty(joined, loyalty, sales))


def finished(joined: DataFrame, tickets: DataFrame) -> DataFrame:
    """``tickets``, which are ``joined`` with loyalty data, parsed, labelled and repaired.

    The loyalty join neither adds nor drops (capacity, seat) pairs, so the seat limits come
    from the narrower join below it.
    """
    full = weekday_labels(parse_clock(payment_method(tickets)))
    return repair_seats(full, joined.select("CAPACIDAD_ASIENTOS_TRAMO", "NUM_ASIENTO"))


def derive(df: DataFrame, net: bool = False) -> DataFrame:
    """Measures every later step relies on.

    The extract already nets tickets and sales of cancellations; by default the totals
    subtract them once more, ``net=True`` takes the extract's values.
    """
    if net:
        tickets, sale = F.col("BOLETOS_VEND"), F.col("VENTA")
    else:
        tickets = F.col("BOLETOS_VEND") - F.col("BOLETOS_CANCEL")
        sale = (F.col("VENTA") - F.col("VENTA_CANCEL") - F.col("IVA_VENDIDO")
                - F.col("IVA_CANCEL"))
    days = F.datediff("FECHA_CORRIDA", "FECHA_OPERACION")
    hours = (days * 24 + F.col("HORA_DECIMAL") - F.col("HORA_VENTA")).cast("double")
    return df.withColumns({
        "TOTAL_BOLETOS": tickets,
        "TOTAL_VENTA": sale,
        "DIF_TARIF": half_even(safe_div(sale, "TARIFA_BASE_TRAMO"), 4),
        "ANIO": F.year("FECHA_CORRIDA"),
        "MES": F.month("FECHA_CORRIDA"),
        "DIAS_ANTICIPACION": days,
        "HORAS_ANTICIPACION": hours,
        "TIEMPO_ANTICIPACION": half_even(hours / 24, 5),
        "CAPACIDAD_ASIENTOS_TRAMO": F.col("CAPACIDAD_ASIENTOS_TRAMO").cast("int"),
        "NUM_ASIENTO": F.col("NUM_ASIENTO").cast("int"),
        "ORIGEN_DESTINO": route_key(),
    })
