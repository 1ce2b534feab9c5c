"""Indicators and demand classes on small frames."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from farelens.operators import classify, kpis

D = dt.date


def tickets(spark, rows):
    return spark.createDataFrame(
        [(i, i, i, *r) for i, r in enumerate(rows)],
        "OPERACION long, TRANSACCION long, TICKET int, DIAS_ANTICIPACION int, VENTA double, "
        "VENTA_TOTAL double, BOLETOS_VEND int, TARIFA_BASE_TRAMO double, FECHA_OPERACION date, "
        "PAX_SUBEN int, CAPACIDAD_ASIENTOS_TRAMO int, NUM_ASIENTO int, ANIO int, MES int")


def test_scope_drops_late_and_unsold(spark):
    df = tickets(spark, [
        (-1, 5.0, 5.0, 1, 9.0, D(2025, 1, 1), 1, 24, 1, 2025, 1),
        (0, 5.0, 5.0, 1, 9.0, D(2025, 1, 1), 1, 24, 1, 2025, 1),
        (3, 0.0, 5.0, 1, 9.0, D(2025, 1, 1), 1, 24, 1, 2025, 1),
        (3, 5.0, 5.0, 1, 9.0, D(2024, 1, 1), 1, 24, 1, 2024, 1)])
    assert {r["OPERACION"] for r in kpis.indicator_scope(df).collect()} == {1, 3}
    assert {r["OPERACION"] for r in kpis.indicator_scope(df, min_year=2025).collect()} == {1}


def test_median_of_repeated_fares_is_exact(spark):
    fares = [10.0] * 5 + [20.0] * 3 + [30.0] * 2
    df = tickets(spark, [(2, 5.0, 5.0, 1, f, D(2025, 1, 1), 1, 24, 1, 2025, 1) for f in fares])
    got = kpis.advance_curve(df).first()
    assert (got["TARIFA_BASE_TRAMO"], got["BOLETOS_VEND"], got["VENTA"]) == (15.0, 10, 50.0)


def test_fare_band_edges_and_empty_bands(spark, rows):
    amounts = [249.99, 250.0, 274.99, 275.0, 1799.99, 1800.0]
    df = tickets(spark, [(1, a, a, 1, a, D(2025, 6, i + 1), 2, 24, 1, 2025, 6)
                         for i, a in enumerate(amounts)])
    got = {r["RANGO_TARIFA"]: r for r in rows(kpis.fare_bands(df))}
    assert len(got) == 62
    assert got["250-275"]["VECES_OFERTADA"] == 2 and got["275-300"]["VECES_OFERTADA"] == 1
    assert got["1775-1800"]["VECES_OFERTADA"] == 1
    empty = got["500-525"]
    assert (empty["VENTA_TOTAL"], empty["DIAS_UNICOS"], empty["BOLETOS_PROM"]) == (0.0, 0, None)


def test_seat_shares_sum_to_one(spark):
    df = tickets(spark, [(1, 9.0, 9.0, 1, 9.0, D(2025, 6, 1 + i % 3), 1 + i % 5, 24 + 3 * (i % 2),
                          1 + i % 7, 2025, 6) for i in range(80)])
    seats = kpis.seat_demand(df)
    sums = seats.groupBy("CAPACIDAD_ASIENTOS_TRAMO").agg(
        F.sum("PROP_ASIENTO").alias("s"), F.max("PROP_ACUM").alias("m")).collect()
    assert all(r["s"] == pytest.approx(1) and r["m"] == pytest.approx(1) for r in sums)
    labels = classify.classify_seats(seats)
    assert labels.where("PROP_ACUM_PCT < 30 AND Clasif_asiento <> 'Alta'").count() == 0


def test_months_weigh_recent_years_and_settle_ties(spark, rows):
    data = [(2025, m, 100 - m) for m in range(1, 13)] + [(2024, 12, 1000)]
    df = spark.createDataFrame(data, "ANIO int, MES int, PAX_SUBEN long")
    got = {r["MES"]: r for r in rows(classify.month_classes(df))}
    # 2024 weighs half of 2025: December scores 2/3 * 88 + 1/3 * 1000.
    assert got[12]["score"] == pytest.approx(88 * 2 / 3 + 1000 / 3)
    assert {m for m, r in got.items() if r["Clasif_mes"] == "Alto"} == {12, 1, 2, 3}
    assert {m for m, r in got.items() if r["Clasif_mes"] == "Bajo"} == {8, 9, 10, 11}
    tied = spark.createDataFrame([(2025, m, 1) for m in range(1, 7)],
                                 "ANIO int, MES int, PAX_SUBEN long")
    assert {r["MES"] for r in classify.month_classes(tied).where(
        "Clasif_mes = 'Alto'").collect()} == {1, 2, 3, 4}


def test_day_hour_class_uses_cell_means(spark, rows):
    df = spark.createDataFrame([("0_Lun", 1, 0.9), ("0_Lun", 2, 0.1), ("1_Mar", 1, 0.2)],
                               "NOMBRE_DIA_CORRIDA string, HORA_DECIMAL int, FOP_PROM double")
    got = {(r["NOMBRE_DIA_CORRIDA"], r["HORA_DECIMAL"]): r for r in rows(
        classify.classify_day_hour(df))}
    assert got["0_Lun", 1]["Clasif_dia_venta"] == "Alto"
    assert got["0_Lun", 1]["Clasif_hora_venta"] == "Alto"
    assert got["0_Lun", 2]["Clasif_hora_venta"] == "Bajo"
    assert got["1_Mar", 1]["Clasif_dia_venta"] == "Bajo"


def test_attach_keeps_unmatched_tickets(spark):
    df = tickets(spark, [(1, 9.0, 9.0, 1, 9.0, D(2025, 6, 1), 1, 24, s, 2025, 6) for s in (1, 2)])
    dim = spark.createDataFrame([("1", "Alta")], "NUM_ASIENTO string, clase string")
    got = classify.attach(df, dim, ["NUM_ASIENTO"], ["clase"])
    assert {r["NUM_ASIENTO"]: r["clase"] for r in got.collect()} == {1: "Alta", 2: None}


def test_pivot_and_share(spark, rows):
    df = spark.createDataFrame([("L", 1, 2.0), ("L", 1, 3.0), ("M", 2, 5.0)],
                               "dia string, hora int, v double")
    got = {r["dia"]: r for r in rows(kpis.pivot_day_hour(df, "dia", "hora", "v"))}
    assert got["L"]["H01"] == 5.0 and got["L"]["H02"] is None and got["M"]["H02"] == 5.0
    assert {r["dia"]: r["PCT"] for r in rows(kpis.share(df, "dia", "v"))} == {"L": 50, "M": 50}


def test_logs_of_non_positive_values_are_null(spark, rows):
    df = spark.createDataFrame([(0, 1.0, 2.0), (1, 0.0, 3.0)], "x int, a double, b double")
    assert rows(kpis.log_series(df, "x", "a", "b", xlog=True))[0]["x"] is None
    assert [r["a"] for r in rows(kpis.log_series(df, "x", "a", "b", ylog=True))] == [0.0, None]
    both = rows(kpis.log_series(df, "x", "a", "b", xlog=True, ylog=True))
    assert {r["a"] for r in both} == {0.0, 1.0}
