"""Price elasticity: by route and day, semi-log, log-log, and what follows from it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from farelens.functions.columns import correlation, route_key, safe_div, total
from farelens.functions.fixed import WEEKDAY_NAMES
from farelens.operators.regression import ols

_TRIP_MEANS = [
    "INGRESO_TEORICO_TRAMO", "TARIFA_BASE_TRAMO", "INGRESO_TRANSP", "CAPACIDAD_ASIENTOS_TRAMO",
    "OCUPACION_TRAMO", "PAX_SUBEN", "DISPONIBILIDAD_TRAMO",
]


def trip_means(df: DataFrame) -> DataFrame:
    """Mean measures of each trip: undoes the repetition of a trip over its tickets."""
    keyed = df.withColumn("ORIGEN_DESTINO", route_key())
    keys = ["ORIGEN_DESTINO", "FECHA_CORRIDA", "CV_CORRIDA"]
    return keyed.dropna(subset=keys).groupBy(*keys).agg(*[F.avg(c).alias(c) for c in _TRIP_MEANS])


def route_day_sums(means: DataFrame) -> DataFrame:
    """Income, theoretical income, seats and free seats by route and day."""
    seats = F.col("PAX_SUBEN") + F.col("DISPONIBILIDAD_TRAMO")
    trips = means.withColumns({
        "Q": seats, "INGRESO_TEORICO": F.col("TARIFA_BASE_TRAMO") * seats})
    return trips.groupBy("ORIGEN_DESTINO", "FECHA_CORRIDA").agg(*[
        total(c).alias(c)
        for c in ("INGRESO_TEORICO", "INGRESO_TRANSP", "Q", "DISPONIBILIDAD_TRAMO")])


def route_day_elasticity(df: DataFrame) -> DataFrame:
    """Arc elasticity of each route and day; NULL where a divisor is zero."""
    sums = route_day_sums(trip_means(df)).withColumns({
        "Day": F.date_format("FECHA_CORRIDA", "EEEE"),
        "PCT_P": safe_div(F.col("INGRESO_TRANSP") - F.col("INGRESO_TEORICO"), "INGRESO_TEORICO"),
        "PCT_D": safe_div(-F.col("DISPONIBILIDAD_TRAMO"), "Q"),
    })
    return sums.withColumn("ELASTICIDADES", safe_div("PCT_D", "PCT_P"))


def calendar_means(elasticities: DataFrame) -> DataFrame:
    """Mean elasticity by route, month and day of the month."""
    return elasticities.groupBy(
        "ORIGEN_DESTINO", F.month("FECHA_CORRIDA").alias("month"),
        F.dayofmonth("FECHA_CORRIDA").alias("day"),
    ).agg(F.avg("ELASTICIDADES").alias("ELASTICIDADES"))


def forward_calendar(elasticities: DataFrame) -> DataFrame:
    """The calendar means dated in the year after the newest; 29 February may drop out."""
    year = elasticities.agg(F.max(F.year("FECHA_CORRIDA")) + 1).scalar()
    dated = calendar_means(elasticities).withColumn("FECHA_CORRIDA", F.try_to_date(
        F.concat_ws("-", year.cast("string"), "month", "day"), "yyyy-M-d"))
    return dated.dropna(subset=["FECHA_CORRIDA"]).select(
        "ORIGEN_DESTINO", "FECHA_CORRIDA", "ELASTICIDADES")


def demand_grid(df: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """Demand, price and lead time by month, travel date, weekday of sale and hour."""
    sold = df.where(F.col("VENTA") > 0).withColumns({
        "dia": F.weekday("FECHA_OPERACION"), "mes": F.col("MES"), "hora": F.col("HORA_DECIMAL")})
    keys = [*group, "mes", "FECHA_CORRIDA", "dia", "hora"]
    return sold.dropna(subset=keys).groupBy(*keys).agg(
        F.avg("TARIFA_BASE_TRAMO").alias("precio_unitario"),
        total("PAX_SUBEN").alias("demanda_real"),
        F.avg("VENTA").alias("ingreso_real"),
        total("BOLETOS_VEND").alias("BOLETOS_VEND"),
        F.avg("CAPACIDAD_ASIENTOS_TRAMO").alias("CAPACIDAD_ASIENTOS_TRAMO"),
        F.avg("DIAS_ANTICIPACION").alias("DIAS_ANTICIPACION"),
        F.avg("HORAS_ANTICIPACION").alias("HORAS_ANTICIPACION"),
        F.avg("OCUPACION_TRAMO").alias("OCUPACION_TRAMO"),
    )


_GRID_NUMBERS = [
    "mes", "dia", "hora", "precio_unitario", "ingreso_real", "BOLETOS_VEND",
    "CAPACIDAD_ASIENTOS_TRAMO", "DIAS_ANTICIPACION", "HORAS_ANTICIPACION", "OCUPACION_TRAMO",
]


def top_predictors(df: DataFrame, target: str = "demanda_real", k: int = 3,
                   candidates: Sequence[str] = _GRID_NUMBERS,
                   group: Sequence[str] = ()) -> DataFrame:
    """The ``k`` columns with the highest (signed) correlation with ``target``."""
    wide = df.groupBy(*group).agg(*[
        correlation(c, target).alias(c) for c in candidates])
    pairs = F.array(*[F.struct(F.lit(c).alias("variable"), F.col(c).alias("corr"))
                      for c in candidates])
    known = F.filter(pairs, lambda p: p["corr"].isNotNull())
    # Descending by correlation, ties by name: a short array per group, sorted in place.
    ranked = F.array_sort(F.transform(known, lambda p: F.struct(
        (-p["corr"]).alias("neg"), p["variable"].alias("variable"), p["corr"].alias("corr"))))
    return wide.select(*group, F.posexplode(F.slice(ranked, 1, k)).alias("pos", "p")).select(
        *group, (F.col("pos") + 1).alias("pos"), "p.variable", "p.corr")


def semilog_fit(grid: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """ln(1 + demand) on month, weekday, hour and ln(1 + income)."""
    logs = grid.withColumns({
        "log_precio": F.log1p("precio_unitario"), "log_ingreso": F.log1p("ingreso_real"),
        "log_demanda": F.log1p("demanda_real")})
    return ols(logs, "log_demanda", ["mes", "dia", "hora", "log_ingreso"], group)


def semilog_elasticity(grid: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """exp(coefficient of ln(1 + income)) - 1."""
    return semilog_fit(grid, group).where(F.col("term") == "log_ingreso").select(
        *group, F.expm1("coef").alias("elasticidad"), "r2_adj", "n")


def revenue_curve(df: DataFrame, lo: float = 100.0, hi: float = 1000.0,
                  points: int = 100) -> DataFrame:
    """Income p * Q0 * (p / p0)^e on an even price grid, for each row (Q0, p0, e)."""
    step = F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("punto")
    price = F.lit(float(lo)) + F.col("punto") * F.lit((hi - lo) / (points - 1))
    return df.select("*", step).withColumn("precio", price).withColumn(
        "ingreso",
        F.col("precio") * F.col("Q0") * F.pow(safe_div("precio", "p0"), F.col("e")))


def best_price(curve: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """Price of the highest income (the first one, if several), and that income."""
    best = F.struct("ingreso", -F.col("punto"))
    return curve.groupBy(*group).agg(
        F.max_by("precio", best).alias("precio_optimo"), F.max("ingreso").alias("ingreso_maximo"))


def elasticity_summary(df: DataFrame, lo: float = 100.0, hi: float = 1000.0,
                       group: Sequence[str] = ()) -> DataFrame:
    """Elasticity, mean price and demand, best price and income, best predictors."""
    key = list(group) or ["__all"]
    grid = demand_grid(df.withColumn("__all", F.lit(0)), key)
    means = grid.groupBy(*key).agg(
        F.avg("precio_unitario").alias("p0"), F.avg("demanda_real").alias("Q0"))
    fit = semilog_elasticity(grid, key).select(*key, F.col("elasticidad").alias("e"))
    best = best_price(revenue_curve(means.join(fit, key), lo, hi), key)
    names = top_predictors(grid, group=key).groupBy(*key).agg(F.transform(
        F.array_sort(F.collect_list(F.struct("pos", "variable"))),
        lambda p: p["variable"]).alias("variables_predictoras"))
    joined = means.join(fit, key).join(best, key).join(names, key)
    return joined.select(
        *group, F.col("e").alias("elasticidad"), F.col("p0").alias("precio_actual"),
        F.col("Q0").alias("demanda_promedio"), "precio_optimo", "ingreso_maximo",
        "variables_predictoras")


def daily_base(df: DataFrame) -> DataFrame:
    """Daily sales for the log-log model: counts, sums, means and mean ticket cost."""
    keys = ["FECHA_OPERACION", "ANIO", "NOMBRE_DIA_CORRIDA"]
    days = df.dropna(subset=keys).groupBy(*keys).agg(
        F.count("OPERACION").alias("Num_Opers"),
        total("TOTAL_BOLETOS").alias("Tot_Boletos"),
        total("TOTAL_VENTA").alias("Tot_Venta"),
        F.avg("OCUPACION_TRAMO").alias("Prom_Ocupacion"),
        F.avg("DIAS_ANTICIPACION").alias("Dias_Anticip"),
        F.avg("TARIFA_BASE_TRAMO").alias("Tarif_Base_Tramo"),
        F.avg("DIF_TARIF").alias("Dif_Tarifa"),
    ).withColumn("Costo_Prom_Boleto", safe_div("Tot_Venta", "Tot_Boletos"))
    return days.where((F.col("Tot_Boletos") > 0) & (F.col("Tot_Venta") > 0)
                      & F.col("Costo_Prom_Boleto").isNotNull())


def _index(days: DataFrame, value: str, base_year: int, missing: str | None) -> DataFrame:
    """Ticket-weighted yearly mean of ``value`` over that of the base year.

    Without data in the base year ``missing`` is the error; NULL gives unknown deflators.
    """
    yearly = days.dropna(subset=[value]).groupBy("ANIO").agg(safe_div(
        F.sum(F.col(value) * F.col("Tot_Boletos")), F.sum("Tot_Boletos")).alias("idx"))
    base: Column = yearly.agg(F.max(F.when(F.col("ANIO") == base_year, F.col("idx")))).scalar()
    known = base if missing is None else F.coalesce(
        base, F.raise_error(F.lit(missing)).cast("double"))
    return yearly.select("ANIO", safe_div("idx", known).alias("deflator"))


def fare_deflator(days: DataFrame, base_year: int = 2025, strict: bool = True) -> DataFrame:
    """Yearly deflator from the base fare; a base year without data is an error if ``strict``."""
    return _index(days, "Tarif_Base_Tramo", base_year,
                  f"no base fare in base year {base_year}" if strict else None)


def stable_deflator(days: DataFrame, base_year: int = 2025, lead: tuple = (7, 30),
                    occupancy: tuple = (30, 70), strict: bool = True) -> DataFrame:
    """Yearly deflator from the ticket cost on days of stable lead time and occupancy; a base
    year without such days is an error if ``strict``."""
    stable = days.where(F.col("Dias_Anticip").between(*lead)
                        & F.col("Prom_Ocupacion").between(*occupancy))
    return _index(stable, "Costo_Prom_Boleto", base_year,
                  f"no stable days in base year {base_year}" if strict else None)


def deflate(days: DataFrame, deflator: DataFrame, strict: bool = True) -> DataFrame:
    """Ticket cost at base-year prices; a year without a deflator is an error if ``strict``, else
    its cost is unknown."""
    known = F.coalesce("deflator", F.raise_error(F.concat(
        F.lit("no deflator for "), F.col("ANIO").cast("string"))).cast("double")) if strict else (
        F.col("deflator"))
    return days.join(deflator, "ANIO", "left").withColumn("deflator", known).withColumn(
        "PRECIO_AJUST", safe_div("Costo_Prom_Boleto", "deflator"))


def loglog_design(days: DataFrame, price: str = "PRECIO_AJUST",
                  years: Sequence[int] = ()) -> tuple[DataFrame, list[str]]:
    """Logs, weekday dummies and (for ``years`` but the first) year dummies."""
    labels = [f"{i}_{name}" for i, name in enumerate(WEEKDAY_NAMES)]
    logs = days.where((F.col(price) > 0) & (F.col("Tot_Boletos") > 0)).withColumns({
        "ln_Q": F.log1p("Tot_Boletos"), "ln_P": F.log1p(price),
        "ln_Anticip": F.log1p("Dias_Anticip"),
        **{f"DIA_{x}": (F.col("NOMBRE_DIA_CORRIDA") == x).cast("int") for x in labels[1:]},
        **{f"ANIO_{x}": (F.col("ANIO") == x).cast("int") for x in list(years)[1:]},
    })
    names = ["ln_P", "ln_Anticip", *[f"DIA_{x}" for x in labels[1:]],
             *[f"ANIO_{x}" for x in list(years)[1:]]]
    return logs, names


def adjusted_days(days: DataFrame, method: str, base_year: int, strict: bool = True) -> DataFrame:
    """A ``daily_base`` with the price each adjustment method works on."""
    if method == "year_fe":
        return days.withColumn("PRECIO_AJUST", F.col("Costo_Prom_Boleto"))
    if method == "tarifa_base":
        return deflate(days, fare_deflator(days, base_year, strict), strict)
    if method == "interno":
        return deflate(days, stable_deflator(days, base_year, strict=strict), strict)
    raise ValueError("method must be 'year_fe', 'tarifa_base' or 'interno'")


def price_elasticity(days: DataFrame, method: str = "year_fe", base_year: int = 2025,
                     by_year: bool = True, years: Sequence[int] | None = None,
                     strict: bool = True) -> DataFrame:
    """Log-log price elasticity over all days, and by year, with 95 percent intervals and
    plain and robust errors.

    ``days`` is a ``daily_base``, best a stored one, as it is read several times.  The year
    effects need the list of years; unless given it is read from the frame.

    A method that the days hold no basis for, such as stable days in the base year, is an
    error.  With ``strict=False`` it gives no row, and years without a deflator are left out.
    """
    adjusted = adjusted_days(days, method, base_year, strict)
    if method == "year_fe" and years is None:
        years = sorted(r[0] for r in days.select("ANIO").distinct().dropna().collect())
    pooled, names = loglog_design(adjusted, years=years if method == "year_fe" else ())
    found = ols(pooled, "ln_Q", names, robust=True).withColumn("ANIO", F.lit(None).cast("int"))
    if by_year:
        single, names = loglog_design(adjusted)
        found = found.unionByName(ols(single, "ln_Q", names, ["ANIO"], robust=True))
    return found.where(F.col("term") == "ln_P").select(
        F.lit(method).alias("metodo"), "ANIO", F.col("coef").alias("elasticidad"),
        "ci_low", "ci_high", F.col("std_err").alias("error"),
        F.col("std_err_robust").alias("error_robusto"), F.col("r2_adj").alias("R2_ajustado"), "n")


def loglog_slope(days: DataFrame, group: Sequence[str] = ("ANIO",)) -> DataFrame:
    """Slope, intercept and R2 of ln(1 + tickets) on ln(1 + price) alone."""
    logs = days.where((F.col("Costo_Prom_Boleto") > 0) & (F.col("Tot_Boletos") > 0)).withColumns({
        "ln_Q": F.log1p("Tot_Boletos"), "ln_P": F.log1p("Costo_Prom_Boleto")})
    return logs.groupBy(*group).agg(
        F.regr_slope("ln_Q", "ln_P").alias("elasticidad"),
        F.regr_intercept("ln_Q", "ln_P").alias("intercepto"),
        F.regr_r2("ln_Q", "ln_P").alias("R2"))
