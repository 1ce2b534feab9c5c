"""Adjustment methods on days that hold no basis for them."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from farelens.functions.fixed import WEEKDAY_NAMES
from farelens.operators import elasticity as E


@pytest.fixture
def days(spark):
    """Daily sales of two years; on none of the days is the occupancy between 30 and 70."""
    start = dt.date(2024, 1, 1)
    rows = [(start + dt.timedelta(i), 2024 + i // 366, f"{i % 7}_{WEEKDAY_NAMES[i % 7]}",
             40 + i * 13 % 17, 90.0 + i * 7 % 23, 5.0 + i % 11, 90.0 + i % 5, 100.0)
            for i in range(500)]
    return spark.createDataFrame(
        rows, "FECHA_OPERACION date, ANIO int, NOMBRE_DIA_CORRIDA string, Tot_Boletos long, "
        "Costo_Prom_Boleto double, Dias_Anticip double, Prom_Ocupacion double, "
        "Tarif_Base_Tramo double")


def test_a_method_without_basis_gives_no_row(days, rows):
    def found(method, **how):
        return rows(E.price_elasticity(days, method, 2025, by_year=False, **how))

    with pytest.raises(Exception, match="no stable days|no deflator"):
        found("interno")
    assert found("interno", strict=False) == []
    assert found("tarifa_base", strict=False)[0]["elasticidad"] == pytest.approx(
        found("tarifa_base")[0]["elasticidad"])


def test_years_without_a_deflator_are_left_out(days, rows):
    some = days.withColumn("Prom_Ocupacion", F.when(F.col("ANIO") == 2025, 50.0).otherwise(90.0))
    got = rows(E.price_elasticity(some, "interno", 2025, by_year=False, strict=False))
    want = rows(E.price_elasticity(
        some.where("ANIO = 2025"), "interno", 2025, by_year=False))
    assert [r["n"] for r in got] == [134]
    assert got[0]["elasticidad"] == pytest.approx(want[0]["elasticidad"])
