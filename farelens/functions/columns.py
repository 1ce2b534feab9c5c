"""Scalar column expressions shared by all operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from farelens.functions.fixed import WEEKDAY_NAMES


def col(name: str | Column) -> Column:
    return F.col(name) if isinstance(name, str) else name


def safe_div(top: str | Column, bottom: str | Column) -> Column:
    """Quotient, NULL where the divisor is zero (never infinite, never NaN)."""
    return F.try_divide(col(top).cast("double"), col(bottom).cast("double"))


def to_number(name: str | Column) -> Column:
    """Number, NULL where the text is not one."""
    return col(name).try_cast("double")


def cents(amount: Column) -> Column:
    """Money rounded to cents with plain IEEE arithmetic."""
    return F.floor(amount * 100 + F.lit(0.5)) / F.lit(100)


def half_even(value: str | Column, digits: int) -> Column:
    """Round to nearest, ties to even, on the scaled binary value."""
    return F.rint(col(value) * float(10 ** digits)) / float(10 ** digits)


def parse_date(name: str | Column) -> Column:
    """Date, NULL where it cannot be read; free for a column that is a date already."""
    return col(name).try_cast("date")


def parse_day_first(name: str | Column) -> Column:
    return F.try_to_date(col(name).cast("string"), "d/M/yyyy")


def clock_hour(name: str | Column) -> Column:
    """Hour of an ``HH:MM:SS`` text; malformed text is an error, not a guess."""
    return F.hour(F.to_timestamp_ntz(col(name), F.lit("HH:mm:ss")))


def weekday_label(date: str | Column) -> Column:
    """``0_Lun`` .. ``6_Dom`` (Monday is 0); NULL stays NULL."""
    day = F.weekday(col(date))
    names = F.array(*[F.lit(n) for n in WEEKDAY_NAMES])
    return F.concat(day.cast("string"), F.lit("_"), F.get(names, day))


def route_key(origin: str | Column = "ORIGEN", destination: str | Column = "DESTINO") -> Column:
    """``origin-destination``; NULL when either end is NULL."""
    return F.concat(col(origin), F.lit("-"), col(destination))


def deck_class(service: str | Column = "CLASE_SERVICIO") -> Column:
    two_decks = F.upper(col(service)).contains("DOS PISOS")
    return F.when(F.coalesce(two_decks, F.lit(False)), F.lit("DOS")).otherwise(F.lit("UNO"))


def lookup(key: str | Column, table: dict) -> Column:
    """Value of a small fixed table held in the plan itself; unknown keys give NULL."""
    entries = reduce(lambda acc, kv: acc + [F.lit(kv[0]), F.lit(kv[1])], table.items(), [])
    return F.try_element_at(F.create_map(*entries), col(key))


def sample_skewness(x: str | Column) -> Column:
    """Bias-corrected skewness over the rows where ``x`` is known."""
    n = F.count(col(x)).cast("double")
    return F.skewness(col(x)) * F.try_divide(F.sqrt(n * (n - 1)), n - 2)


def correlation(x: str | Column, y: str | Column) -> Column:
    """Pearson correlation over the pairs known on both sides, NULL if either is constant."""
    a, b = col(x).cast("double"), col(y).cast("double")
    spread = F.stddev_pop(F.when(b.isNotNull(), a)) * F.stddev_pop(F.when(a.isNotNull(), b))
    return safe_div(F.covar_pop(a, b), spread)


def total(x: str | Column) -> Column:
    """Sum that is 0, not NULL, for a group without known values."""
    value = F.sum(col(x))
    return F.coalesce(value, F.lit(0))
