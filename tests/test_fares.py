"""Fare features, the model and the scenario."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from farelens.functions.fixed import TRAINED_MEAN_DISCOUNT
from farelens.operators import fares as M, features as X
from farelens.plans import scenario as P

D = dt.date
ROUTES = ["A-B", "B-A"]


def tickets(spark, n=1500):
    return spark.range(n).select(
        F.col("id").alias("OPERACION"), F.col("id").alias("TRANSACCION"),
        (F.col("id") % 40).cast("int").alias("NUM_ASIENTO"),
        F.when(F.col("id") % 2 == 0, "A").otherwise("B").alias("ORIGEN"),
        F.when(F.col("id") % 2 == 0, "B").otherwise("A").alias("DESTINO"),
        F.date_add(F.lit("2025-01-01").cast("date"), (F.col("id") % 300).cast("int")).alias(
            "FECHA_CORRIDA"),
        F.concat(F.lpad((F.col("id") % 24).cast("string"), 2, "0"), F.lit(":00:00")).alias(
            "HORA_SALIDA_CORRIDA"),
        F.when(F.col("id") % 5 == 0, "Dos pisos").alias("CLASE_SERVICIO"),
        F.when(F.col("id") % 7 == 0, "INTERNET").otherwise("TAQUILLA").alias("TIPO_CLIENTE"),
        (F.col("id") % 100).cast("double").alias("HORAS_ANTICIPACION"),
        F.when(F.col("id") % 3 == 0, 36).otherwise(37).alias("CAPACIDAD_ASIENTOS_TRAMO"),
        ((F.col("id") % 10) / 20).alias("DIF_TBT_VENTA"),
        (F.lit(100.0) + F.when(F.col("id") % 2 == 0, 200).otherwise(0)
         + (F.col("id") % 10) * 5).alias("VENTA"))


def test_good_flags(spark):
    df = M.good_flags(tickets(spark))
    assert df.where("CAPACIDAD_ASIENTOS_TRAMO = 37 AND Buen_Asiento = 1").count() == 0
    assert df.where("CAPACIDAD_ASIENTOS_TRAMO = 36 AND NUM_ASIENTO = 3 AND Buen_Asiento = 0"
                    ).count() == 0
    assert {r[0] for r in df.where("Buen_Dia = 1").select(F.weekday("FECHA_CORRIDA")).distinct()
            .collect()} == {0, 4, 6}
    assert df.where("Buen_Mes = 1").select(F.month("FECHA_CORRIDA")).distinct().count() == 6


def test_inputs_of_nine_routes_are_twenty_seven():
    assert len(M.model_inputs([str(i) for i in range(9)])) == 27


def test_serving_has_the_training_columns(spark):
    train = M.fare_features(tickets(spark))
    serve = M.serving_features(tickets(spark).drop("DIF_TBT_VENTA"))
    assert serve.columns == train.columns
    assert serve.select("DIF_TBT_VENTA").distinct().first()[0] == TRAINED_MEAN_DISCOUNT
    assert serve.where("TIPO_CLIENTE_AGENCIA <> 0").count() == 0


def test_fare_model_beats_the_mean_and_survives_saving(spark, tmp_path):
    from pyspark.ml import PipelineModel

    from farelens.sources.readers import load_model, save_model

    frame = X.hash_split(M.fare_features(tickets(spark), keep=["OPERACION"]), ["OPERACION"])
    model = M.fit_fare_model(frame.where("en_train"), ROUTES, rounds=8, depth=4)
    held = M.quote(frame.where("NOT en_train"), model, ROUTES)
    mean = frame.where("en_train").agg(F.avg("VENTA")).first()[0]
    tree = X.errors(held, "VENTA", "TARIFA_DINAMICA").first()
    plain = X.errors(held.withColumn("m", F.lit(mean)), "VENTA", "m").first()
    assert tree["MAE"] < plain["MAE"] / 4 and tree["RMSE"] < plain["RMSE"] / 4
    save_model(model, str(tmp_path / "fare"))
    again = M.quote(frame.where("NOT en_train"), load_model(PipelineModel, str(tmp_path / "fare")),
                    ROUTES)
    same = held.join(again.select("OPERACION", F.col("TARIFA_DINAMICA").alias("t")), "OPERACION")
    assert same.where("TARIFA_DINAMICA <> t").count() == 0 and same.count() == held.count()


def priced(spark):
    df = spark.createDataFrame(
        [(1, "A-B", D(2026, 3, 1), "ES", 40.0, 1, 100.0, 5), (2, "A-B", D(2026, 3, 1), "AD", 90.0,
         1, 100.0, 0), (3, "A-B", D(2026, 3, 2), "??", 90.0, 1, 100.0, 0)],
        "OPERACION int, ORIGEN_DESTINO string, FECHA_CORRIDA date, TIPO_PASAJERO string, "
        "VENTA double, BOLETOS_VEND int, TARIFA_DINAMICA double, Aumento int")
    return P.final_fare(df)


def test_final_fare(spark, rows):
    got = {r["OPERACION"]: r for r in rows(priced(spark))}
    assert got[1]["VentaD_final"] == pytest.approx(52.5)
    assert got[1]["Delta_P"] == pytest.approx(12.5 / 52.5)
    assert got[2]["VentaD_final"] == 100.0 and got[3]["VentaD_final"] is None


def test_scenario_by_calendar_day(spark, rows):
    compared = P.route_day_compare(priced(spark))
    calendar = spark.createDataFrame([("A-B", D(2024, 3, 1), -0.5)],
                                     "ORIGEN_DESTINO string, FECHA_CORRIDA date, "
                                     "ELASTICIDADES double")
    dated = P.by_calendar_day(compared, calendar)
    got = {r["FECHA_CORRIDA"].day: r for r in rows(P.scenario(dated))}
    assert (got[1]["Elast"], got[1]["Boletos_Estimados"]) == (-0.5, 1.0)
    assert got[1]["Ingreso_Estimado"] == pytest.approx(152.5 / 2)
    assert got[1]["PCT_dQ_Estimado"] == pytest.approx(-1.0)
    assert got[2]["Elast"] is None and got[2]["Ingreso_Estimado"] is None
    other = {r["FECHA_CORRIDA"].day: r for r in rows(P.scenario(dated, "price"))}
    assert other[1]["Boletos_Estimados"] == pytest.approx(
        2 * (1 + got[1]["PCT_dP"] * -0.5))
    with pytest.raises(ValueError):
        P.scenario(dated, "none")


def test_results_align_by_identity(spark):
    left = spark.createDataFrame([(1, 5.0), (2, 6.0)], "OPERACION int, TARIFA_DINAMICA double")
    right = spark.createDataFrame([(2, 7), (3, 8)], "OPERACION int, Cluster int")
    got = P.align_results(left, right, ["OPERACION"]).collect()
    assert [tuple(r) for r in got] == [(2, 6.0, 7)]
