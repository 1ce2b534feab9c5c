"""Demand indicators over the ticket frame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from farelens.functions.columns import safe_div, total
from farelens.functions.fixed import FARE_BANDS
from farelens.operators.selection import medians


def sales_by_day_hour(df: DataFrame) -> DataFrame:
    """Tickets, sales, mean occupancy and capacity by route, year, weekday and hour."""
    keys = ["ORIGEN", "DESTINO", "ANIO", "NOMBRE_DIA_CORRIDA", "HORA_DECIMAL"]
    return df.dropna(subset=keys).groupBy(*keys).agg(
        total("BOLETOS_VEND").alias("BOLETOS_VEND"),
        total("VENTA").alias("VENTA"),
        F.avg("OCUPACION_TRAMO").alias("OCUPACION_TRAMO"),
        F.max("CAPACIDAD_ASIENTOS_TRAMO").alias("CAPACIDAD_ASIENTOS_TRAMO"),
    )


def indicator_scope(df: DataFrame, year_col: str = "ANIO", min_year: int | None = None) -> DataFrame:
    """Tickets the indicators look at: sold, not after departure, from ``min_year`` on."""
    kept = df.where((F.col("DIAS_ANTICIPACION") >= 0) & (F.col("VENTA") > 0))
    return kept if min_year is None else kept.where(F.col(year_col) >= min_year)


def occupancy(df: DataFrame) -> DataFrame:
    """Mean occupancy and load factor (ratio of the means) by weekday and hour."""
    keys = ["NOMBRE_DIA_CORRIDA", "HORA_DECIMAL"]
    return df.dropna(subset=keys).groupBy(*keys).agg(
        F.avg("OCUPACION_TRAMO").alias("OCUPACION_TRAMO"),
        F.avg("CAPACIDAD_ASIENTOS_TRAMO").alias("CAPACIDAD_ASIENTOS_TRAMO"),
    ).withColumn("FOP_PROM", safe_div("OCUPACION_TRAMO", "CAPACIDAD_ASIENTOS_TRAMO"))


def advance_sums(df: DataFrame, series: Sequence[str] = ()) -> DataFrame:
    """Tickets and sales by days of lead time."""
    keys = [*series, "DIAS_ANTICIPACION"]
    return df.dropna(subset=keys).groupBy(*keys).agg(
        total("BOLETOS_VEND").alias("BOLETOS_VEND"), total("VENTA").alias("VENTA")).withColumn(
        "COSTO_PROM_BOLETO", safe_div("VENTA", "BOLETOS_VEND"))


def advance_curve(df: DataFrame, series: Sequence[str] = ()) -> DataFrame:
    """``advance_sums`` with the median base fare.

    The exact median is found by counting fares in ever narrower ranges, without gathering
    the fares of a lead day; a crowded lead day is summed and counted by many tasks.
    """
    keys = [*series, "DIAS_ANTICIPACION"]
    by_fare = df.dropna(subset=keys).groupBy(*keys, "TARIFA_BASE_TRAMO").agg(
        F.count(F.lit(1)).alias("n"))
    middle = medians(by_fare, keys, "TARIFA_BASE_TRAMO")
    return advance_sums(df, series).join(middle, keys, "left")


def _day_word(date: str) -> tuple[Column, Column]:
    """The 64-day word that a date falls in, and its bit there."""
    day = F.unix_date(date)
    return F.floor(day / 64), F.expr(f"shiftleft(1L, pmod(unix_date({date}), 64))")


def seat_demand(df: DataFrame) -> DataFrame:
    """Demand by capacity and seat, with shares and running shares within the capacity.

    The distinct sale days are bits of 64-day words, so they combine like sums do: a seat's
    rows become one row per word in every task.
    """
    keys = ["CAPACIDAD_ASIENTOS_TRAMO", "NUM_ASIENTO"]
    means = {"VENTA_PROM": "VENTA", "VEL_VENTA_PROM": "DIAS_ANTICIPACION",
             "TARIFA_BASE_PROM": "TARIFA_BASE_TRAMO"}
    word, bit = _day_word("FECHA_OPERACION")
    by_word = df.dropna(subset=keys).groupBy(*keys, word.alias("word")).agg(
        F.bit_or(bit).alias("days"),
        *[total(c).alias(c) for c in ("BOLETOS_VEND", "VENTA", "PAX_SUBEN")],
        *[F.sum(c).alias(f"{name}__sum") for name, c in means.items()],
        *[F.count(c).alias(f"{name}__n") for name, c in means.items()])
    seats = by_word.groupBy(*keys).agg(
        F.coalesce(F.sum(F.bit_count("days")), F.lit(0)).alias("DIAS_VENTA"),
        *[F.sum(c).alias(c) for c in ("BOLETOS_VEND", "VENTA", "PAX_SUBEN")],
        *[safe_div(F.sum(f"{name}__sum"), F.sum(f"{name}__n")).alias(name) for name in means],
    ).withColumn("PAX_X_DIA_PROM", safe_div("PAX_SUBEN", "DIAS_VENTA"))
    return seat_shares(seats)


def seat_shares(seats: DataFrame) -> DataFrame:
    """Share of each seat in its capacity, and the running share, busiest seat first."""
    capacity = Window.partitionBy("CAPACIDAD_ASIENTOS_TRAMO")
    running = capacity.orderBy(F.col("PAX_X_DIA_PROM").desc(), "NUM_ASIENTO").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    shares = seats.withColumn(
        "TOTAL_PAX_X_DIA", F.sum("PAX_X_DIA_PROM").over(capacity),
    ).withColumn("PROP_ASIENTO", safe_div("PAX_X_DIA_PROM", "TOTAL_PAX_X_DIA"))
    return shares.withColumn("PROP_ACUM", F.sum("PROP_ASIENTO").over(running)).withColumns({
        "PROP_ASIENTO_PCT": F.col("PROP_ASIENTO") * 100,
        "PROP_ACUM_PCT": F.col("PROP_ACUM") * 100,
    })


def origin_means(df: DataFrame) -> DataFrame:
    return df.dropna(subset=["ORIGEN"]).groupBy("ORIGEN").agg(
        F.avg("BOLETOS_VEND").alias("BOLETOS_VEND"), F.avg("VENTA").alias("VENTA"))


def monthly(df: DataFrame) -> DataFrame:
    """Monthly sums over all tickets, outside the indicator scope too."""
    return df.dropna(subset=["ANIO", "MES"]).groupBy("ANIO", "MES").agg(
        *[total(c).alias(c) for c in ("BOLETOS_VEND", "VENTA", "PAX_SUBEN")])


def fare_bands(df: DataFrame, lo: int = FARE_BANDS[0], hi: int = FARE_BANDS[1],
               step: int = FARE_BANDS[2], year_from: int = 2025) -> DataFrame:
    """Tickets by fare band [a, b), bands without tickets included.

    Each ticket finds its band by arithmetic; only the handful of band totals meets the
    full list of bands.
    """
    spark = df.sparkSession
    last = (hi - lo + step - 1) // step
    kept = df.where(
        (F.col("VENTA_TOTAL") >= lo) & (F.col("VENTA_TOTAL") < lo + last * step)
        & (F.col("VENTA_TOTAL") > 0) & (F.col("DIAS_ANTICIPACION") >= 0)
        & (F.year("FECHA_OPERACION") >= year_from))
    band = F.floor((F.col("VENTA_TOTAL") - lo) / step)
    word, bit = _day_word("FECHA_OPERACION")
    sums = ["VENTA_TOTAL", "BOLETOS_VEND", "PAX_SUBEN"]
    by_word = kept.groupBy(band.alias("banda"), word.alias("word")).agg(
        F.bit_or(bit).alias("days"), *[F.sum(c).alias(c) for c in sums],
        F.count(F.lit(1)).alias("n"), F.sum("DIAS_ANTICIPACION").alias("lead"),
        F.count("DIAS_ANTICIPACION").alias("known"))
    found = by_word.groupBy("banda").agg(
        *[F.sum(c).alias(c) for c in sums], F.sum("n").alias("VECES_OFERTADA"),
        safe_div(F.sum("lead"), F.sum("known")).alias("DIAS_ANTICIPACION"),
        F.sum(F.bit_count("days")).alias("DIAS_UNICOS"))
    low = F.col("id") * step + lo
    bands = spark.range(last).select(
        F.col("id").alias("banda"),
        F.concat(low.cast("string"), F.lit("-"), (low + step).cast("string")).alias("RANGO_TARIFA"))
    full = bands.join(found, "banda", "left").drop("banda").fillna(
        0, subset=["VENTA_TOTAL", "BOLETOS_VEND", "PAX_SUBEN", "VECES_OFERTADA", "DIAS_UNICOS"])
    return full.withColumns({
        "BOLETOS_PROM": safe_div("BOLETOS_VEND", "DIAS_UNICOS"),
        "PAX_PROM": safe_div("PAX_SUBEN", "DIAS_UNICOS"),
    })


def pivot_day_hour(df: DataFrame, day: str, hour: str, value: str, agg: str = "sum",
                   year: str | None = None, hours: Sequence[int] = tuple(range(24))) -> DataFrame:
    """Weekday by hour table of one measure, per year if ``year`` is named.

    The hours are listed up front, so no job has to look for them.
    """
    keys = [day] if year is None else [year, day]
    wanted = {"sum": F.sum, "mean": F.avg, "max": F.max, "min": F.min, "count": F.count}[agg]
    table = df.groupBy(*keys).pivot(hour, list(hours)).agg(wanted(value))
    return table.withColumnsRenamed({str(h): f"H{h:02d}" for h in hours})


def share(df: DataFrame, cls: str, value: str) -> DataFrame:
    """Total of each class and its percent of all."""
    everything: Column = df.agg(F.sum(value)).scalar()
    return df.groupBy(cls).agg(F.sum(value).alias(value)).withColumn(
        "PCT", safe_div(F.col(value) * 100, everything))


def log_series(df: DataFrame, x: str, y1: str, y2: str, xlog: bool = False,
               ylog: bool = False) -> DataFrame:
    """Two measures along ``x`` with logs of ``x``, or else of both measures.

    A value that is not positive has no log and becomes NULL.
    """
    def ln(name: str) -> Column:
        return F.when(F.col(name) > 0, F.ln(name)).alias(name)

    if xlog:
        return df.select(ln(x), y1, y2)
    return df.select(x, ln(y1), ln(y2)) if ylog else df.select(x, y1, y2)
