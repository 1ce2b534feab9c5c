"""Daily revenue, occupancy and budget projections: one aggregate, nine bindings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from farelens.functions.columns import safe_div

TICKET_KINDS = ["BOLETOS", "PACK"]
DAY = ("ANIO", "ANIO_MES", "FECHA")


def daily_projection(df: DataFrame, keys: Sequence[str], sums: dict[str, Column | str],
                     ratios: dict[str, tuple[str, str]] | None = None,
                     where: Column | None = None) -> DataFrame:
    """Sum measures by ``keys`` and add ratios of sums.

    ``sums`` maps a result name to a source column, or to an aggregate expression;
    ``ratios`` maps a result name to (numerator, denominator) source columns.
    """
    kept = df if where is None else df.where(where)
    aggregates = [
        (F.sum(value) if isinstance(value, str) else value).alias(name)
        for name, value in sums.items()
    ]
    aggregates += [
        safe_div(F.sum(top), F.sum(bottom)).alias(name)
        for name, (top, bottom) in (ratios or {}).items()
    ]
    return kept.groupBy(*keys).agg(*aggregates)


def _since(year_from: str, company: str | Sequence[str] | None) -> Column:
    keep = F.col("ANIO") >= year_from
    if company is None:
        return keep
    names = [company] if isinstance(company, str) else list(company)
    return keep & F.col("EMPRESA").isin(names)


_LOAD_FACTOR = {"FOP": ("KM_OCUPACION", "KM_CAPACIDAD")}


def daily_occupancy(df: DataFrame, company=None, year_from: str = "2023") -> DataFrame:
    """Occupancy, load factor and trips by company and day."""
    return daily_projection(
        df, ("EMPRESA", *DAY), {"OCUPACION": "OCUPACION_TRAMO", "CORRIDAS": "CUENTACORRIDA"},
        _LOAD_FACTOR, _since(year_from, company))


def daily_occupancy_income(df: DataFrame, year_from: str = "2023") -> DataFrame:
    """Daily occupancy plus income per km."""
    return daily_projection(
        df, ("EMPRESA", *DAY), {"OCUPACION": "OCUPACION_TRAMO", "CORRIDAS": "CUENTACORRIDA"},
        {"FIK": ("INGRESOS", "KMS"), **_LOAD_FACTOR}, _since(year_from, None))


def daily_branch_sales(df: DataFrame, company=None, year_from: str = "2023") -> DataFrame:
    """Sales and tickets by day and operation type, over all or the named companies."""
    return daily_projection(
        df, ("ANIO", "FECHA", "TIPO_OPERACION"), {"VENTA": "VENTA", "BOLETOS": "BOLETOS"},
        where=_since(year_from, company) & F.col("TIPO_OPERACION").isin(TICKET_KINDS))


def daily_company_sales(df: DataFrame, company: str, year_from: str = "2023") -> DataFrame:
    """Sales and tickets of one company by day and operation type."""
    return daily_projection(
        df, ("EMPRESA", "ANIO", "FECHA", "TIPO_OPERACION"),
        {"VENTA": "VENTA", "BOLETOS": "BOLETOS"},
        where=_since(year_from, company) & F.col("TIPO_OPERACION").isin(TICKET_KINDS))


def daily_income(df: DataFrame, year_from: str = "2023") -> DataFrame:
    """Income, km and boarded passengers by company and day."""
    return daily_projection(
        df, ("EMPRESA", *DAY), {"INGRESO": "INGRESOS", "KMS": "KMS", "PAX": "PAX_SUBEN"},
        where=_since(year_from, None))


def accounting_income(df: DataFrame, company: str = "AME", year_from: str = "2023") -> DataFrame:
    """Income, km and passengers by accounting day under one fixed company name."""
    return daily_projection(
        df, DAY, {"INGRESO": "IMPORTE", "KMS": "KMS", "PAX": "CANTIDAD"},
        where=_since(year_from, None)).withColumn("EMPRESA", F.lit(company))


def accounting_channels(df: DataFrame, year_from: str = "2023") -> DataFrame:
    """Accounting day split into counter and on-board income.

    A channel without any known amount makes its split unknown.
    """
    counter = F.sum("BOLETOS_TAQUILLA") + F.sum("INTERCIA_EXT") + F.sum("INTERCIA_INT")
    on_board = F.sum("A_BORDO") + F.sum("MANUALES") + F.sum("PORTATIL")
    return daily_projection(
        df, ("EMPRESA", *DAY),
        {"ING_TAQ": counter, "ING_ABO": on_board, "INGRESO": "IMPORTE", "KMS": "KMS",
         "PAX": "CANTIDAD", "VIAJES": "VIAJES"},
        {"FIK": ("IMPORTE", "KMS")}, _since(year_from, None))


def budget_by_kind(df: DataFrame, company=None, km: str = "PRESUPUESTO_MENSUAL",
                   services: str = "PRESUPUESTO_MENSUAL") -> DataFrame:
    """Budget by day and operation type; the km and service sources are parameters."""
    names = [company] if isinstance(company, str) else company
    return daily_projection(
        df, ("FECHA", "TIPO_OPERACION"),
        {"PTTO": "VENTA", "PTTO_PAX": "BOLETOS", "PTTO_KM": km, "PTTO_SERVICIOS": services},
        where=None if names is None else F.col("EMPRESA").isin(list(names)))


def budget_by_company(df: DataFrame) -> DataFrame:
    """Budget by company, day and operation type."""
    return daily_projection(
        df, ("EMPRESA", "FECHA", "TIPO_OPERACION"),
        {"PTTO": "PRESUPUESTO", "PTTO_PAX": "PASAJEROS", "PTTO_KM": "KMS",
         "PTTO_SERVICIOS": "SERVICIOS"})
