"""The five data sets the models work on, all cut from one ticket frame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from farelens.functions.columns import deck_class, route_key, safe_div
from farelens.functions.fixed import HOLDOUT_DAYS, PLACEHOLDER_DOMAIN
from farelens.operators.joins import spread_join
from farelens.operators.prep import TICKET

FARE_COLUMNS = [
    "NOMBRE_PASAJERO", "BOLETOS_VEND", "FECHA_CORRIDA", "HORA_SALIDA_CORRIDA", "CLASE_SERVICIO",
    "IVA_TARIFA_BASE_TRAMO", "PAX_SUBEN", "TARIFA_BASE_TRAMO", "FECHA_OPERACION",
    "HORA_OPERACION", "VENTA", "DISPONIBILIDAD_TRAMO", "HORAS_ANTICIPACION", "ORIGEN", "DESTINO",
    "TIPO_CLIENTE", "NUM_ASIENTO", "CAPACIDAD_ASIENTOS_TRAMO", "TIPO_PASAJERO",
]
ELASTICITY_COLUMNS = [
    "PAX_SUBEN", "DISPONIBILIDAD_TRAMO", "TARIFA_BASE_TRAMO", "FECHA_CORRIDA",
    "HORA_SALIDA_CORRIDA", "INGRESO_TEORICO_TRAMO", "INGRESO_TRANSP", "OCUPACION_TRAMO",
    "ORIGEN", "DESTINO", "TIPO_PASAJERO", "CAPACIDAD_ASIENTOS_TRAMO", "CV_CORRIDA",
]
# "First" mail of a passenger: earliest sale, then ticket, then the address itself.
MAIL_ORDER = ("FECHA_OPERACION", *TICKET, "EMAIL")


def present(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The listed columns that exist, in list order."""
    return df.select(*[n for n in names if n in df.columns])


def sold(df: DataFrame, amount: str = "VENTA") -> DataFrame:
    """Tickets really sold: positive amount and positive net count."""
    return df.where((F.col(amount) > 0) & (F.col("BOLETOS_VEND") > 0))


def newest_sale(df: DataFrame, date: str = "FECHA_OPERACION") -> Column:
    return df.agg(F.max(date)).scalar()


def before_holdout(df: DataFrame, days: int = HOLDOUT_DAYS,
                   date: str = "FECHA_OPERACION") -> DataFrame:
    """Sales at least ``days`` days older than the newest one."""
    return df.where(F.col(date) <= F.date_sub(newest_sale(df, date), days))


def in_holdout(df: DataFrame, days: int = HOLDOUT_DAYS,
               date: str = "FECHA_OPERACION") -> DataFrame:
    """The newest ``days`` days of sales, disjoint from ``before_holdout``."""
    newest = newest_sale(df, date)
    return df.where((F.col(date) >= F.date_sub(newest, days - 1)) & (F.col(date) <= newest))


def _fare_set(df: DataFrame, extra: Sequence[str]) -> DataFrame:
    columns = FARE_COLUMNS + [c for c in extra if c not in FARE_COLUMNS]
    return sold(df.select(*columns)).drop("BOLETOS_VEND")


def relative_discount(df: DataFrame) -> DataFrame:
    """Discount against the base fare, NULL for a base fare of zero."""
    base = F.col("TARIFA_BASE_TRAMO")
    return df.withColumns({
        "TBT": base,
        "DIF_TBT_VENTA": safe_div(base - F.col("VENTA"), base),
        "TIPO_CLASE": deck_class(),
    })


def fare_train_set(df: DataFrame, days: int = HOLDOUT_DAYS,
                   keep: Sequence[str] = ()) -> DataFrame:
    """Full-fare adult tickets older than the hold-out window."""
    adults = _fare_set(df, keep).where(F.col("TIPO_PASAJERO") == "AD")
    return relative_discount(before_holdout(adults, days))


def fare_score_set(df: DataFrame, days: int = HOLDOUT_DAYS,
                   keep: Sequence[str] = ()) -> DataFrame:
    """Tickets of all passenger types in the hold-out window."""
    return relative_discount(in_holdout(_fare_set(df, keep), days))


def known_mails(df: DataFrame, order: Sequence[str] = MAIL_ORDER) -> DataFrame:
    """First known mail of every passenger name, unknown names counting as one name."""
    return (
        df.where(F.col("EMAIL").isNotNull())
        .groupBy("NOMBRE_PASAJERO")
        .agg(F.min_by("EMAIL", F.struct(*order)).alias("EMAIL_KNOWN"))
    )


def known_mail(df: DataFrame, order: Sequence[str] = MAIL_ORDER,
               sample: DataFrame | None = None) -> DataFrame:
    """Fill a missing mail with the first one known for the same passenger name.

    A name may own a large share of the tickets, so the join spreads hot names;
    ``sample`` is a cheaper frame to look for them in.
    """
    def keyed(frame: DataFrame) -> DataFrame:
        return frame.withColumns({
            "__named": F.col("NOMBRE_PASAJERO").isNotNull(),
            "__name": F.coalesce("NOMBRE_PASAJERO", F.lit("")),
        })

    keys = ["__named", "__name"]
    firsts = keyed(known_mails(df, order)).select(*keys, "EMAIL_KNOWN")
    joined = spread_join(keyed(df), firsts, keys, "left", TICKET,
                         sample=None if sample is None else keyed(sample))
    return joined.withColumn("EMAIL", F.coalesce("EMAIL", "EMAIL_KNOWN")).drop(
        "EMAIL_KNOWN", *keys)


def placeholder_mail(name: str = "NOMBRE_PASAJERO") -> Column:
    dotted = F.replace(F.lower(name), F.lit(" "), F.lit("."))
    return F.concat(dotted, F.lit(f"@{PLACEHOLDER_DOMAIN}"))


def impute_email(df: DataFrame, order: Sequence[str] = MAIL_ORDER,
                 sample: DataFrame | None = None) -> DataFrame:
    """Known mail of the passenger, else a placeholder built from the name."""
    return known_mail(df, order, sample).withColumn(
        "EMAIL", F.coalesce("EMAIL", placeholder_mail()))


def correct_discount(df: DataFrame) -> DataFrame:
    """Adults with a promotion are specials; specials without one are adults."""
    promo, label = F.col("PORCENT_PROMO"), F.col("DESC_DESCUENTO")
    return df.withColumn(
        "DESC_DESCUENTO",
        F.when((promo > 0) & (label == "ADULTO"), "PROMOCION ESPECIAL")
        .when((promo == 0) & (label == "PROMOCION ESPECIAL"), "ADULTO")
        .otherwise(label))


def absolute_lead(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "HORAS_ANTICIPACION": F.abs("HORAS_ANTICIPACION"),
        "DIAS_ANTICIPACION": F.abs("DIAS_ANTICIPACION"),
    })


def fill_promo(df: DataFrame) -> DataFrame:
    return df.fillna(0, subset=["PORCENT_PROMO"])


def _customer_set(windowed: DataFrame, order: Sequence[str],
                  sample: DataFrame | None) -> DataFrame:
    mailed = impute_email(fill_promo(windowed), order, sample)
    return correct_discount(mailed).withColumn("ORIGEN_DESTINO", route_key())


def customer_train_set(df: DataFrame, days: int = HOLDOUT_DAYS,
                       order: Sequence[str] = MAIL_ORDER,
                       sample: DataFrame | None = None) -> DataFrame:
    """Tickets for the customer clusters, every row with a mail address."""
    kept = before_holdout(absolute_lead(sold(df, "VENTA_TOTAL")), days)
    return _customer_set(kept, order, sample)


def customer_score_set(df: DataFrame, days: int = HOLDOUT_DAYS,
                       order: Sequence[str] = MAIL_ORDER,
                       sample: DataFrame | None = None) -> DataFrame:
    """The same for the hold-out window."""
    kept = in_holdout(absolute_lead(sold(df, "VENTA_TOTAL")), days)
    return _customer_set(kept, order, sample)


def prior_year(df: DataFrame, date: str = "FECHA_CORRIDA") -> DataFrame:
    """Rows of the year before the newest one."""
    newest = df.agg(F.max(F.year(date))).scalar()
    return df.where(F.year(date) == newest - 1)


def elasticity_set(df: DataFrame) -> DataFrame:
    """Occupancy columns of the last complete year."""
    return prior_year(df.select(*ELASTICITY_COLUMNS))
